import hashlib
import re

import pytest

from tempest.llm import op6_decontamination as op6

from .conftest import odd_rows, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ws(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    wins = [(i, tuple(w[a : a + 10])) for i, t in items for w in [ws(t)] if w for a in range(max(1, len(w) - 9))]
    out = []
    for d, t in docs:
        w = ws(t)
        hit, found = set(), set()
        for i, x in wins:
            for a in range(len(w) - len(x) + 1):
                if tuple(w[a : a + len(x)]) == x:
                    hit.update(range(a, a + len(x)))
                    found.add(i)
        s = ",".join(sorted(str(i) for i in found if i is not None))
        n = len([i for i in found if i is not None])
        out.append((d or 0, len(w), len(hit), n, hashlib.sha256(s.encode()).hexdigest(), bool(hit)))
    return sorted(out)


ITEMS = [(7, words(40, 25)), (8, "alpha beta gamma"), (9, None), (10, ""), (11, "Alpha, BETA gamma!"), (12, "?!"), (100, words(41, 10)),
         (13, "the the the the the the the the the the the the")]


def documents():
    r = [(i, t) for i, t, *_ in odd_rows() if not t or len(t) < 60_000]
    a, b = words(40, 25).split(), words(41, 10)
    r += [(20, words(50, 30) + " " + " ".join(a[3:20]) + " " + words(51, 9)), (21, b.upper().replace(" ", "--")), (22, " ".join(b.split()[:9])),
          (23, "alpha beta gamma alpha beta gamma"), (24, "alpha beta"), (25, "the " * 30), (26, b + " " + b), (26, b + " " + b),
          (27, "gamma"), (28, "alpha beta gamma")]
    return r


@pytest.fixture(scope="module")
def frames(spark):
    return (spark.createDataFrame(documents(), "doc_id long, text string"),
            spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, words string"))


@pytest.mark.parametrize("slice_words", [op6.SLICE_WORDS, 40])
def test_hits_equal_brute_force_in_one_and_several_slices(frames, slice_words):
    docs, items = frames
    got = op6.hit_counts(op6.find_windows(docs, items, slice_words=slice_words)).collect()
    assert sorted((x[0] or 0, *x[1:]) for x in got) == brute(documents(), ITEMS)


@pytest.mark.parametrize("slice_words", [op6.SLICE_WORDS, 40])
def test_filter_keeps_the_clean_rows_as_they_are(frames, slice_words):
    docs, items = frames
    clean = op6.without_windows(docs, items, slice_words=slice_words)
    bad = {x[0] for x in brute(documents(), ITEMS) if x[5]}
    assert sorted((r.doc_id or 0, r.text or "") for r in clean.collect()) == sorted((i or 0, t or "") for i, t in documents() if (i or 0) not in bad)


def test_empty_benchmark_and_documents(spark, odd, no_docs, frames):
    none = frames[1].where("false")
    got = op6.hit_counts(op6.find_windows(odd, none)).collect()
    assert len(got) == len(odd_rows()) and not any(x.contaminated for x in got)
    assert op6.find_windows(no_docs, frames[1]).collect() == []
    assert op6.without_windows(odd, none).columns == odd.columns
