import re
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tempest.llm import op12_collocations as op12

from .conftest import odd_rows


def brute(rows, min_count=10, max_words=3, absorb=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    out = []
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    drop = set()
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * a >= absorb * f[lang, w[i : i + k]]:
                    drop.add((lang, w[i : i + k]))
    for (lang, w), a in cand.items():
        if (lang, w) not in drop:
            cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.append((lang, score, a, " ".join(w), f[lang, w[:k]], f[lang, w[k:]]))
    out.sort(key=lambda x: (x[0], -x[1], -x[2], x[3].encode()))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, l, r in out:
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase, a, l, r, n[lang], score))
    return ranked


def rows_of(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=30), max_size=8), st.integers(1, 9))
def test_every_frequent_key_survives(batches, threshold):
    mass = sum(map(len, batches))
    s = op12.MisraGries(mass // threshold + 1)
    for b in batches:
        s.merge(np.array(b, np.uint32), np.ones(len(b), np.int64))
        assert len(s.keys) <= s.capacity
    true = Counter(x for b in batches for x in b)
    left = set(s.survivors(threshold).tolist())
    assert {k for k, n in true.items() if n >= threshold} <= left
    assert s.taken * (s.capacity + 1) <= mass
    for k, c in zip(s.keys.tolist(), s.counts.tolist()):
        assert c <= true[k] <= c + s.taken


def test_small_tables_equal_brute_force_and_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    want = sorted(brute(rows))
    assert want
    assert rows_of(op12.mine_collocations(docs.repartition(3), block_bytes=30_000, shard_keys=20_000)) == want  # many blocks and shards
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    assert sorted(con.sql(op12.ORACLE_SQL).fetchall()) == want
    assert rows_of(op12.mine_collocations(docs, min_count=4, max_words=4, absorb=70, top=7)) == sorted(brute(rows, 4, 4, 70, 7))


def test_odd_rows(spark, odd):
    got = rows_of(op12.mine_collocations(odd, min_count=2, max_words=3))
    assert got == sorted(brute([(r[2], r[1]) for r in odd_rows()], min_count=2))


def test_ties_signs_and_long_texts(spark):
    texts = [("en", "A b. a B\tc  a b! a\x0bb\x0c" * 4), (None, "É é É é, é É" * 5), ("und", "É é x"), ("fr", "z" * 5000 + " y. " + "q r s t " * 400),
             ("en", "w v " * 3 + "u. " * 500)]
    df = spark.createDataFrame(texts, "lang string, text string")
    assert rows_of(op12.mine_collocations(df, min_count=3, block_bytes=1000)) == sorted(brute(texts, 3))


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 999_999_999_999_989, 999_999_999_999_999, 1_000_000_000_000_003
    df = spark.createDataFrame([(a, l, r), (10, 10, 10), (3, 7, 11)], "a long, l long, r long")
    assert [x[0] for x in df.select(op12.cut_score("a", "l", "r")).collect()] == [1_000_000 * a * a // (l * r), 1_000_000, 9_000_000 // 77]


def test_empty_tables(spark, no_docs):
    assert rows_of(op12.mine_collocations(no_docs)) == []
    assert rows_of(op12.mine_collocations(spark.createDataFrame([(None, None), ("en", "")], "lang string, text string"))) == []
