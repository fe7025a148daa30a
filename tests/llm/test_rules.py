import random
import re
from collections import Counter

from tempest.llm import op9_quality_rules as op9

from .conftest import odd_rows, words


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    rep = {i + j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep)


def test_counts_equal_brute_force(spark, odd):
    r = random.Random(2)
    texts = [x[1] for x in odd_rows()] + ["".join(r.choice("ab é\n\t#*<> ") for _ in range(r.randint(0, 200))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = op9.quality_rules(df).orderBy("doc_id").collect()
    for x, t in zip(got, texts):
        n, *rest = brute(t)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == (n, *rest), repr(t)[:200]
        assert x.base_failed == (n < 50 or 100 * rest[3] > 50 * n)
        assert not (x.base_failed and x.kept)


def test_host_rates_shrink_towards_the_corpus(spark):
    good = [(f"big{h}", words(h * 1000 + i, 80)) for h in range(6) for i in range(40)]
    rows = good + [("bad", "x " * 100)] * 60 + [("bad", words(77, 80))] + [("tiny", "x " * 100), ("tiny", words(78, 80)), (None, words(79, 80))]
    df = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    v = {x.host: x for x in op9.host_verdicts(op9.document_rules(df)).collect()}
    assert not v["bad"].host_kept and v["big0"].host_kept and v["tiny"].host_kept
    assert v["tiny"].f / v["tiny"].n == 0.5 > v["tiny"].rate
    kept = {x.doc_id: x.kept for x in op9.quality_rules(df).collect()}
    assert not kept[len(good) + 60]  # a clean text of the rejected host
    assert kept[len(rows) - 2] and kept[len(rows) - 1]  # clean texts of the tiny and of the null host


def test_odd_rows_and_empty_table(spark, odd, no_docs):
    got = op9.quality_rules(odd).collect()
    assert len(got) == len(odd_rows())
    assert all(x.kept is not None for x in got)
    assert op9.quality_rules(no_docs).collect() == []


def test_regular_strings_of_any_length_have_hashes_of_their_own():
    import numpy as np

    from tempest.llm.textops import prefix_hash, span_hash

    a, b = "a", "b"  # Thue-Morse strings and their complements: polynomial hashes mod 2^64 agree from 1,024 bytes on
    for _ in range(13):
        a, b = a + b, b + a
        buf = np.frombuffer((a + b + a.upper()).encode(), np.uint8)
        n = len(a)
        h = span_hash(prefix_hash(buf), np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n]), buf)
        assert h[0] != h[1] and h[0] == h[2], n


def test_unequal_regular_lines_are_no_duplicates():
    import pyarrow as pa

    from tempest.llm.textops import text_buffer

    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    assert op9.rule_counts(*text_buffer(pa.array([f"{a}\n{b}", f"{a}\n{a}"])))["n_dup_lines"].tolist() == [0, 1]
