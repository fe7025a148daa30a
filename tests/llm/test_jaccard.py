import itertools
import random
import re
from pathlib import Path

import numpy as np
import pytest

from tempest.llm import op4_ngram_jaccard as op4
from tempest.llm.graph import components
from tempest.session import checkpoint_dir

from .conftest import odd_rows


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(ws) < 5:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    return sorted((i, len(s), root(i)) for i, s in sets)


def family(r, base, n, rate):
    vocab = [f"w{k}" for k in range(4000)]
    out = []
    for _ in range(n):
        ws = list(base)
        for _ in range(r.randint(0, max(1, int(rate * len(ws))))):
            op, at = r.random(), r.randrange(len(ws))
            if op < 0.5:
                ws[at] = r.choice(vocab)
            elif op < 0.8 and len(ws) > 6:
                del ws[at]
            else:
                ws.insert(at, r.choice(vocab))
        out.append(" ".join(ws))
    return out


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(4000)]
    texts = []
    for size in (5, 6, 7, 9, 12, 17, 24, 40, 70, 130, 300):
        base = [r.choice(vocab) for _ in range(size)]
        texts += family(r, base, 8, 0.06)
    passage = [r.choice(vocab) for _ in range(60)]  # shared, but only a part of each text
    texts += [" ".join(passage + [r.choice(vocab) for _ in range(r.randint(5, 80))]) for _ in range(30)]
    texts += ["a b c", "A  b c", "a b", "", "   "]
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(tuple(x) for x in op4.ngram_components(df).collect())
    assert got == brute(docs)


def test_similar_sets_share_a_signature():
    r = np.random.default_rng(5)
    for _ in range(600):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        out = int(r.integers(0, max(1, int(0.29 * n)) + 1))
        extra = int(r.integers(0, max(1, int(0.33 * n)) + 1))
        b = np.unique(np.concatenate([a[out:], r.integers(0, 1 << 63, extra).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not both or 100 * both < 75 * (len(a) + len(b) - both):
            continue
        shared = np.intersect1d(a, b)  # the least that the reduction leaves of either
        for x, y in ((a, b), (shared, shared), (a, shared)):
            sa, sb = op4.signatures(len(a), x, 75), op4.signatures(len(b), y, 75)
            assert len(np.intersect1d(sa, sb)), (len(a), len(b), both)


def test_odd_rows_and_empty_table(spark, odd, no_docs):
    got = op4.ngram_components(odd).collect()
    assert len(got) == len(odd_rows())
    by = {}
    for x in got:
        by.setdefault(x.doc_id, set()).add((x.n_shingles, x.component_id))
    assert {c for _, c in by[1] | by[2]} == {1}
    assert by[3] == {(0, 3)} and by[4] == {(0, 4)} and by[5] == {(0, 5)}
    assert {c for _, c in by[None]} == {None}
    assert by[9] == {(1, 9)} and by[10] == {(1, 9)}
    assert {c for _, c in by[11] | by[12]} == {11}
    assert op4.ngram_components(no_docs).collect() == []


def test_connected_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 60)] + [(200, 200)]
    got = {x.node: x.comp for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in range(5, 60)}}


def test_chunks_give_the_links_of_different_components():
    import pyarrow as pa

    r = np.random.default_rng(2)
    base = r.integers(0, 1 << 63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([r.choice(base, int(r.integers(40, 60)), replace=False), r.integers(0, 1 << 63, 3).astype(np.uint64)])) for _ in range(40)]

    def chunk(ids):
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array([len(sets[i]) for i in ids]), pa.array([i % 5 for i in ids]),
                                           pa.array([sets[i].tobytes() for i in ids], pa.binary())], ["node", "n", "comp", "feats"])

    want = {(i, j) for i in range(40) for j in range(i + 1, 40) if i % 5 != j % 5
            and 100 * (k := len(np.intersect1d(sets[i], sets[j]))) >= 75 * (len(sets[i]) + len(sets[j]) - k)}
    a, b = chunk(list(range(0, 40, 2))), chunk(list(range(1, 40, 2)))
    old, op4.SLICE = op4.SLICE, 7
    try:
        got = [tuple(x.values()) for p, q in ((a, a), (a, b), (b, b)) for x in op4._chunk_links(p, q, 75).to_pylist()]
    finally:
        op4.SLICE = old
    assert want and set(got) == want


def test_rows_of_many_kb_go_to_python_in_small_batches(spark, monkeypatch):
    """Texts, sets, blocks and pairs of chunks are some KB to MB a row: ten thousand of them in an Arrow batch fill an
    executor outside its heap. Parquet is read without the direct buffers that every reading thread keeps."""
    from tempest import session
    from tempest.llm import blocks, op4_ngram_jaccard

    plain, seen = session.materialize, []

    def spied(df, name, batch_rows=None):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        if "InArrow" in plan:
            seen.append((name, batch_rows))
        return plain(df, name, batch_rows)

    monkeypatch.setattr(blocks, "materialize", spied)
    monkeypatch.setattr(op4_ngram_jaccard, "materialize", spied)
    text = [" ".join(f"w{(i // 4) * 100 + j + (i % 4) * (j == 50)}" for j in range(60)) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in op4_ngram_jaccard.ngram_components(docs).collect()}
    assert got == {i: i // 4 * 4 for i in range(40)}
    assert len(seen) > 5 and all(n and n <= 1000 for _, n in seen)
    assert all(n <= 8 for name, n in seen if name in ("sets-once", "reps", "signatures"))
    assert spark.conf.get("parquet.hadoop.vectored.io.enabled") == "false"


def test_materialize_bounds_batches_and_leaves_the_settings(spark):
    import pyarrow as pa

    from tempest.session import materialize

    def sizes(batches):
        for rb in batches:
            yield pa.RecordBatch.from_arrays([pa.array([rb.num_rows], pa.int64())], ["n"])

    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf, "10000")
    d = spark.range(100, numPartitions=1).mapInArrow(sizes, "n long")
    assert max(r.n for r in materialize(d, "bounded", 7).collect()) == 7
    assert spark.conf.get(conf, "10000") == before
    assert [r.n for r in materialize(d, "plain").collect()] == [100]


def test_links_share_as_many_signatures_as_needed():
    r = np.random.default_rng(11)
    linked = most = 0
    for _ in range(1500):
        n = int(r.integers(1, 600))
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        out = int(r.integers(0, max(1, int(0.27 * n)) + 1))
        extra = int(r.integers(0, max(1, int(0.33 * n)) + 1)) if r.random() < 0.5 else 0
        b = np.unique(np.concatenate([a[out:], r.integers(0, 1 << 63, extra).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not both or 100 * both < 75 * (len(a) + len(b) - both):
            continue
        linked += 1
        shared = np.intersect1d(a, b)
        for x, y in ((a, b), (shared, shared), (a, shared), (shared, b)):
            got = [{band: (s, need) for s, band, need in op4.banded_signatures(len(f), g, 75)} for f, g in ((a, x), (b, y))]
            band = max(len(a).bit_length(), len(b).bit_length()) - 1  # the instance of the larger
            (sa, na), (sb, nb) = got[0][band], got[1][band]
            assert len(np.intersect1d(sa, sb)) >= max(na, nb), (len(a), len(b), both)
            most = max(most, na, nb)
    assert linked > 300 and most > 50


def test_near_misses_of_many_groups_are_not_all_compared(spark, monkeypatch):
    """Sixty groups of near misses that have single words and a passage in common: chunks are compared within a group and
    not each with each, so their number grows with the table. What is done with is removed on the way."""
    from tempest.llm import op4_ngram_jaccard

    r = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(9))
    texts = []
    for g in range(60):
        base = [f"g{g}w{k}" for k in range(300)]
        for _ in range(6):  # two of them differ in more shingles than a link may
            ws = list(base)
            for at in r.sample(range(0, 300, 5), 12):
                ws[at] = f"x{r.randrange(8)}"
            texts.append(passage + " " + " ".join(ws))
    docs = list(enumerate(texts))
    seen, plain = [], op4_ngram_jaccard._chunk_pairs

    def spied(placed):
        seen.extend([placed.select("chunk").distinct().count(), plain(placed).count()])
        return plain(placed)

    monkeypatch.setattr(op4_ngram_jaccard, "_chunk_pairs", spied)
    monkeypatch.setattr(op4_ngram_jaccard, "CHUNK", 6)
    folder = Path(checkpoint_dir(spark).removeprefix("file://"))
    before = set(folder.iterdir())
    got = op4_ngram_jaccard.ngram_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert sorted(tuple(x) for x in got.collect()) == brute(docs)
    assert not left & {"blocks", "sets-once", "set-blocks", "rep-blocks", "reps", "signatures", "chunks"}
    assert seen[0] >= 30 and seen[1] <= 3 * seen[0]
