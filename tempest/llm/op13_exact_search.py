"""Exact top-k search by inner product: a KD-tree per shard, best-first traversal with box bounds.

Vectors become whole numbers (``floor(scale * x)``) and are dealt to shards by a hash, so copies of a vector spread over
the shards. Each shard is a written KD-tree: median splits of the widest side down to small leaves, each node with its
tight bounding box and smallest id. The inner product of a query and any vector of a box is at most the sum over the
components of max(q lo, q hi); a node is left out when that bound is below the query's kth best score, or equal to it
while the node has only larger ids than the kth best has. Nodes are opened in the order of their bounds, once k
vectors are known twice as many at a time in each wave, many queries side by side: a leaf is one matrix product with all queries that opened it.

The kth best is propagated: first every query searches the shard in which it lives itself, then all other shards,
starting with the kth best score and id of the first search. A shard's tree is read once in each of these two rounds
and queries stream past it; Spark ranks what the shards return.

Products are exact: single precision where no sum can reach 2^24, double up to 2^53, Python's whole numbers beyond (vectors
with a component of 2^20 or more are in shards of their own, so they do not slow down the others).

Edge cases: vectors that are null, hold null or non-finite components (also after scaling) or have no id take no part.
Vectors of different lengths are not compared; rows with the query's own id are not its candidates; repeated rows of a
candidate count each, repeated rows of a query give one list. Scores beyond a long are clipped. An empty table gives an
empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempest.session import materialize

SHARD_ROWS = 1 << 18
LEAF = 64
#: Queries that traverse a tree side by side.
BATCH = 512
#: A wave opens at most this many nodes of a query.
WIDEST = 256
BIG = 1 << 20


def whole_numbers(col: pa.ListArray, scale: int) -> list[np.ndarray | None]:
    """floor(scale * x) of each vector as doubles, None for those that take no part."""
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(scale * col.values.to_numpy(zero_copy_only=False).astype(np.float64))  # nulls become NaN
    off = col.offsets.to_numpy()
    vectors = [values[a:b] for a, b in zip(off[:-1], off[1:])]
    return [v if np.isfinite(v).all() else None for v in vectors]


def numbered_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, cls, v): ``cls`` is twice the length, plus one for vectors with a component of ``BIG`` or more; ``v``
    the components as int32 (doubles in odd classes)."""
    d = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            vs = whole_numbers(rb.column("v"), scale)
            keep = [i for i, v in enumerate(vs) if v is not None]
            big = [bool(len(vs[i]) and np.abs(vs[i]).max() >= BIG) for i in keep]
            yield pa.RecordBatch.from_arrays(
                [rb.column("vec_id").take(pa.array(keep, pa.int64())), pa.array([2 * len(vs[i]) + b for i, b in zip(keep, big)], pa.int32()),
                 pa.array([(vs[i] if b else vs[i].astype(np.int32)).tobytes() for i, b in zip(keep, big)], pa.binary())], ["vec_id", "cls", "v"])

    return d.where("vec_id is not null and v is not null").mapInArrow(run, "vec_id long, cls int, v binary")


def matrix(cells: list[bytes], cls: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells), np.float64 if cls % 2 else np.int32).reshape(len(cells), cls // 2)


class Tree:
    """Points in leaf order; node i has points start[i] to end[i], children left[i] and left[i] + 1 (-1: a leaf)."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        span, left, lo, hi, least = [(0, len(ids))], [-1], [], [], []
        i = 0
        while i < len(span):
            a, b = span[i]
            p = points[order[a:b]]
            lo.append(p.min(axis=0))
            hi.append(p.max(axis=0))
            least.append(ids[order[a:b]].min())
            if b - a > leaf:
                m, side = (b - a) // 2, hi[i] - lo[i]
                if side.size and side.max() > 0:  # else all are one point, and the halves differ in their ids
                    half = np.argpartition(p[:, int(np.argmax(side))], m)
                    order[a:b] = order[a:b][half]
                left[i] = len(span)
                span += [(a, a + m), (a + m, b)]
                left += [-1, -1]
            i += 1
        self.points, self.ids = points[order], ids[order]
        self.start, self.end = np.array(span).T.astype(np.int64)
        self.left, self.lo, self.hi, self.least = np.array(left), np.array(lo), np.array(hi), np.array(least)

    FIELDS = ("points", "ids", "start", "end", "left", "lo", "hi", "least")

    def pack(self) -> bytes:
        import io

        out = io.BytesIO()
        small = {f: getattr(self, f) for f in self.FIELDS}
        if self.points.dtype != np.float64 and self.points.size and np.abs(self.points).max() < 128:
            small |= {f: small[f].astype(np.int8) for f in ("points", "lo", "hi")}
        np.savez(out, **small)
        return out.getvalue()

    @classmethod
    def unpack(cls, payload: bytes) -> "Tree":
        import io

        t = cls.__new__(cls)
        with np.load(io.BytesIO(payload), allow_pickle=False) as z:
            for f in cls.FIELDS:
                setattr(t, f, z[f])
        return t

    def search(self, q: np.ndarray, own: np.ndarray, k: int, kth: np.ndarray, kth_id: np.ndarray, known: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of the up to ``k`` best of each query, at least of those that come before (kth, kth_id)
        where such a bound is known: higher score, or equal and smaller id."""
        largest = max(1.0, float(np.abs(q).max(initial=0))) * max(1.0, float(np.abs(self.points).max(initial=0))) * max(1, q.shape[1])
        kind = np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else object
        exact = (lambda x: np.array([[int(c) for c in r] for r in x.tolist()], object).reshape(x.shape)) if kind is object else (lambda x: x.astype(kind))
        q, points, lo, hi = exact(q), exact(self.points), exact(self.lo), exact(self.hi)
        zero = q.dtype.type(0) if kind is not object else 0
        up, down = np.maximum(q, zero), np.minimum(q, zero)
        kth, kth_id, known = kth.astype(object if kind is object else np.float64), kth_id.copy(), known.copy()
        kth[~known] = -np.inf

        def bounds(who: np.ndarray, node: np.ndarray) -> np.ndarray:
            out = [(up[who[a : a + 65536]] * hi[node[a : a + 65536]] + down[who[a : a + 65536]] * lo[node[a : a + 65536]]).sum(axis=1)
                   for a in range(0, len(who), 65536)]
            return np.concatenate([np.zeros(0, kind), *out])

        def worth(who: np.ndarray, node: np.ndarray, bound: np.ndarray) -> np.ndarray:
            return ((bound > kth[who]) | ((bound == kth[who]) & (self.least[node] < kth_id[who]))).astype(bool)

        n = len(q)
        who, node = np.arange(n), np.zeros(n, np.int64)
        bound = bounds(who, node)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind))
        width = 2
        while True:
            alive = worth(who, node, bound)
            who, node, bound = who[alive], node[alive], bound[alive]
            if not len(who):
                return best
            order = np.lexsort((self.least[node], falling(bound), who))
            who, node, bound = who[order], node[order], bound[order]
            new = np.concatenate(([True], who[1:] != who[:-1]))
            opened = np.arange(len(who)) - np.maximum.accumulate(np.where(new, np.arange(len(who)), 0)) < width
            w, x = who[opened], node[opened]
            who, node, bound = who[~opened], node[~opened], bound[~opened]
            inner = self.left[x] >= 0
            child = np.concatenate((self.left[x[inner]], self.left[x[inner]] + 1))
            parent = np.concatenate((w[inner], w[inner]))
            who, node = np.concatenate((who, parent)), np.concatenate((node, child))
            bound = np.concatenate((bound, bounds(parent, child)))
            found = [best]
            w, x = w[~inner], x[~inner]
            order = np.argsort(x, kind="stable")
            w, x = w[order], x[order]
            cut = np.flatnonzero(np.concatenate(([len(x) > 0], x[1:] != x[:-1]))) if len(x) else []
            for a, b in zip(cut, np.append(cut[1:], len(x))):
                mine, s = w[a:b], slice(self.start[x[a]], self.end[x[a]])
                score = points[s] @ q[mine].T
                at, of = np.nonzero((score >= kth[mine]).astype(bool) & (self.ids[s][:, None] != own[mine]))
                found.append((mine[of], self.ids[s][at], score[at, of]))
            best = first_k(*(np.concatenate(c) for c in zip(*found)), k)
            ends = np.flatnonzero(np.concatenate((best[0][1:] != best[0][:-1], [True]))) if len(best[0]) else np.zeros(0, np.int64)
            ends = ends[np.bincount(best[0], minlength=n)[best[0][ends]] == k]
            who_k, score_k, id_k = best[0][ends], best[2][ends], best[1][ends]
            better = ((score_k > kth[who_k]) | ((score_k == kth[who_k]) & (id_k < kth_id[who_k]))).astype(bool)
            kth[who_k[better]], kth_id[who_k[better]] = score_k[better], id_k[better]
            known[who_k] = True
            if known[who].all():  # before a query has a kth best, its best node goes first
                width = min(2 * width, WIDEST)


def falling(x: np.ndarray) -> np.ndarray:
    """Sort keys for a descending order."""
    return -np.unique(x, return_inverse=True)[1] if x.dtype == object else -x


def first_k(who: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` of each query by score descending, id ascending."""
    order = np.lexsort((ids, falling(score), who))
    who, ids, score = who[order], ids[order], score[order]
    new = np.concatenate(([True], who[1:] != who[:-1])) if len(who) else np.zeros(0, bool)
    keep = np.arange(len(who)) - np.maximum.accumulate(np.where(new, np.arange(len(who)), 0)) < k
    return who[keep], ids[keep], score[keep]


FOUND = "query_id long, own int, home int, v binary, kth long, kth_id long, ids array<long>, scores array<long>"


def search_shards(trees: DataFrame, queries: DataFrame, shards: int, k: int) -> DataFrame:
    """``queries`` (query_id, cls, shard, own, home, v, kth, kth_id) against the tree of their (cls, shard); ``own`` and
    ``home`` are the class and shard in which the query lives. kth may be missing."""
    none = {"payload": "binary", "query_id": "long", "own": "int", "home": "int", "v": "binary", "kth": "long", "kth_id": "long"}
    columns = ["cls", "shard", *none]
    as_rows = [d.select("cls", "shard", *(F.col(c) if c in d.columns else F.lit(None).cast(t).alias(c) for c, t in none.items())) for d in (trees, queries)]
    # the tree comes first (payload is null for queries), then its queries stream past
    rows = as_rows[0].unionByName(as_rows[1]).repartition(max(shards, 1), "cls", "shard")
    rows = rows.sortWithinPartitions("cls", "shard", F.expr("payload is null"), "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, at = None, None
        for rb in batches:
            place = list(zip(*(rb.column(c).to_pylist() for c in ("cls", "shard", "own"))))
            is_tree = rb.column("payload").is_valid().to_pylist()
            a = 0
            while a < rb.num_rows:
                if is_tree[a]:
                    tree, at = Tree.unpack(rb.column("payload")[a].as_py()), place[a][:2]
                    a += 1
                    continue
                b = a
                while b < rb.num_rows and b - a < BATCH and not is_tree[b] and place[b] == place[a]:
                    b += 1
                part = rb.slice(a, b - a).select(["query_id", "own", "home", "v", "kth", "kth_id"])
                if at == place[a][:2]:
                    yield _searched(tree, part, k)
                a = b

    return rows.select(*columns).mapInArrow(run, FOUND)


def _searched(tree: Tree, part: pa.RecordBatch, k: int) -> pa.RecordBatch:
    q = matrix(part.column("v").to_pylist(), part.column("own")[0].as_py()).astype(np.float64)
    known = part.column("kth").is_valid().to_numpy(zero_copy_only=False)
    kth, kth_id = (part.column(c).fill_null(0).to_numpy() for c in ("kth", "kth_id"))
    who, ids, score = tree.search(q, part.column("query_id").to_numpy(), k, kth, kth_id, known)
    n = np.bincount(who, minlength=len(q))
    off = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
    full, last = n == k, np.maximum(off[1:] - 1, 0)
    if score.dtype == object:
        limit = np.iinfo(np.int64)
        clipped = np.array([min(max(s, limit.min), limit.max) for s in score], np.int64)
        full &= np.array([n[i] == k and clipped[j] == score[j] for i, j in enumerate(last)], bool)  # a clipped score bounds nothing
        score = clipped
    score = score.astype(np.int64)
    kth, kth_id = (pa.array(x[last] if len(x) else np.zeros(len(q), np.int64), mask=~full) for x in (score, ids))
    lists = [pa.ListArray.from_arrays(pa.array(off), pa.array(x)) for x in (ids, score)]
    return pa.RecordBatch.from_arrays([*(part.column(c) for c in ("query_id", "own", "home", "v")), kth, kth_id, *lists],
                                      ["query_id", "own", "home", "v", "kth", "kth_id", "ids", "scores"])


def exact_search(vectors: DataFrame, is_query: str, k: int, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding",
                 shard_rows: int = SHARD_ROWS, leaf: int = LEAF) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all other vectors for each vector whose id fulfils the SQL
    condition ``is_query`` on ``vec_id``."""
    spark = vectors.sparkSession
    n = max(1, vectors.count())
    shards = max(-(-n // shard_rows), min(2 * spark.sparkContext.defaultParallelism, -(-n // 1024)))
    numbered = numbered_vectors(vectors, id_col, vec_col, scale)
    # the hash takes the components too: equal ids or equal vectors alone do not pile up
    dealt = materialize(numbered.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")), "vectors")

    def build(g: pa.Table) -> pa.Table:
        cls = g["cls"][0].as_py()
        tree = Tree(matrix(g["v"].to_pylist(), cls), g["vec_id"].to_numpy(), leaf)
        return pa.table({"cls": g["cls"].slice(0, 1), "shard": g["shard"].slice(0, 1), "payload": pa.array([tree.pack()], pa.binary())})

    trees = materialize(dealt.groupBy("cls", "shard").applyInArrow(build, "cls int, shard int, payload binary"), "trees")
    queries = dealt.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("cls", "v", "shard")).alias("x"))
    queries = queries.select("query_id", "x.cls", "x.shard", F.col("x.cls").alias("own"), F.col("x.shard").alias("home"), "x.v")
    first = materialize(search_shards(trees, queries, shards, k), "home-search")
    # the stated query set against all rows, shard by shard: every query meets the other shards of vectors of its length
    classes = trees.select("cls", F.expr("cls div 2").alias("dim")).distinct()  # at most two of a length
    asked = first.withColumn("dim", F.expr("own div 2")).join(classes, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    rest = search_shards(trees, asked.where("not (cls = own and shard = home)"), shards, k)
    hits = first.select("query_id", "ids", "scores").unionByName(rest.select("query_id", "ids", "scores"))
    hits = hits.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("query_id", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 20 = 0", 20)


ORACLE_SQL = """
WITH e AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM p QUALIFY rank <= 20
"""
