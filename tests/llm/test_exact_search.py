import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tempest.llm import op13_exact_search as op13


def brute(rows, k, every=20, scale=64):
    """[(vec_id, vector or None)] → (query_id, rank, vec_id, score), with Python's whole numbers."""
    import math

    ok = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) or not math.isfinite(scale * x) for x in v):
            continue
        ok.append((i, [math.floor(scale * x) for x in v]))
    out = []
    for i, q in dict((i, q) for i, q in reversed(ok)).items():
        if i % every == 0:
            score = [(-min(max(sum(a * b for a, b in zip(q, v)), -2**63), 2**63 - 1), j) for j, v in ok if j != i and len(v) == len(q)]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(sorted(score)[:k], 1)]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in df.collect())


def as32(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(0, 5), st.integers(1, 9), st.integers(1, 8), st.sampled_from([3, 100, 2**40]), st.integers(0, 99))
def test_traversal_is_exact(n, dim, k, leaf, size, seed):
    r = np.random.default_rng(seed)
    points = r.integers(-size, size + 1, (n, dim)).astype(np.float64 if size > 2**30 else np.int32)
    points[r.random(n) < 0.3] = points[0]  # copies
    ids = r.permutation(2 * n)[:n].astype(np.int64)
    tree = op13.Tree.unpack(op13.Tree(points, ids, leaf).pack())
    q = r.integers(-size, size + 1, (7, dim)).astype(np.float64)
    own = np.append(ids[:3], r.integers(0, 9, 4))[:7] if n >= 3 else r.integers(0, 9, 7)
    exact = [[sum(int(a) * int(b) for a, b in zip(p, x)) for p in points] for x in q]
    want = [sorted((-s, int(i)) for s, i in zip(exact[j], ids) if i != own[j])[:k] for j in range(7)]
    none = np.zeros(7, np.int64)
    who, got, score = tree.search(q, own, k, none, none, np.zeros(7, bool))
    assert [[(-int(s), int(i)) for w, i, s in zip(who, got, score) if w == j] for j in range(7)] == want
    # with a bound, what comes before it is all there
    bound = [w[len(w) // 2] if w else (0, 0) for w in want]
    who, got, score = tree.search(q, own, k, np.array([-b[0] for b in bound]), np.array([b[1] for b in bound]), np.array([bool(w) for w in want]))
    for j in range(7):
        found = {(-int(s), int(i)) for w, i, s in zip(who, got, score) if w == j}
        assert {x for x in want[j] if x < bound[j]} <= found


def test_tree_boxes_are_tight_and_halves_even():
    r = np.random.default_rng(1)
    points, ids = r.integers(-50, 50, (1000, 8)).astype(np.int32), np.arange(1000)
    t = op13.Tree(points, ids, 16)
    for i in range(len(t.left)):
        p = t.points[t.start[i] : t.end[i]]
        assert (t.lo[i] == p.min(axis=0)).all() and (t.hi[i] == p.max(axis=0)).all() and t.least[i] == t.ids[t.start[i] : t.end[i]].min()
        if t.left[i] >= 0:
            a, b = (t.end[t.left[i] + j] - t.start[t.left[i] + j] for j in (0, 1))
            assert abs(a - b) <= 1
        else:
            assert len(p) <= 16


def test_few_nodes_are_opened_where_boxes_tell_apart():
    r = np.random.default_rng(2)
    points = (np.repeat(r.integers(-500, 500, (50, 4)), 200, axis=0) + r.integers(-3, 4, (10_000, 4))).astype(np.int32)
    t = op13.Tree(points, np.arange(10_000), 32)
    seen = []
    t.start = type("Seen", (), {"__getitem__": lambda s, i, a=t.start: (seen.append(1), a[i])[1]})()
    t.search(points[:1].astype(float), np.array([0]), 5, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, bool))
    assert len(seen) < 0.2 * 10_000 / 32


@pytest.mark.parametrize("shard_rows", [1 << 18, 40])
def test_small_table_equals_sql_and_brute_force(spark, shard_rows):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    want = brute(rows, 20)
    assert rows_of(op13.exact_search(e, "vec_id % 20 = 0", 20, shard_rows=shard_rows, leaf=16)) == want
    con = duckdb.connect()
    con.sql("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    assert sorted(con.sql(op13.ORACLE_SQL).fetchall()) == want


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0], "a"), (20, None, "b"), (40, [1.0, None], "c"), (60, [nan, 1.0], "d"), (80, [inf, 0.0], "e"), (None, [1.0, 1.0], "f"),
            (1, [1.0, 2.0], "g"), (2, [1.0, 2.0], "h"), (2, [1.0, 2.0], "h"), (3, [0.01, -0.01], "i"), (100, [], "j"), (101, [], "k"),
            (120, [5.0, 1.0, 1.0], "l"), (140, [1e9, -3e12], "m"), (141, [1e300, 1.0], "n"), (-20, [-1.0, 0.5], "o"), (142, [1.7e308, 0.0], "p")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string").selectExpr("*", "v cls", "v shard", "v home", "v payload")
    for shard_rows in (100, 2):
        assert rows_of(op13.exact_search(df, "vec_id % 20 = 0", 3, shard_rows=shard_rows)) == brute([r[:2] for r in rows], 3)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert rows_of(op13.exact_search(df, "vec_id % 20 = 0", 3)) == []
