"""N-gram Jaccard self-join by PartEnum signatures, and the components of its links.

A document's set is its distinct 5-word shingles (64-bit hashes). Two documents link at a Jaccard similarity of
``PERCENT`` per cent or more. Every step below keeps all links between different sets; nothing is capped.

1. *Sets.* One pass gives size and a 128-bit digest of each set. Equal sets are one node, named by the smallest
   id of its documents (a partial minimum before the shuffle, so a group of copies costs a row per task).
2. *Reduction.* A shingle that is in one document only cannot be in an intersection. Documents are written in
   blocks and their shingles screened (``screen``: 4 bytes a shingle to shards, one bit back). A document with
   less than ``PERCENT`` per cent of its shingles shared has no link at all and is done. The same again over the
   distinct sets that are left, where copies no longer vouch for each other. A shared passage does not bring a
   document further, unless it is most of it.
3. *PartEnum.* For the others: two sets of sizes r, s differ in at most k = (1-J)/(1+J)·(r+s) shingles. Sizes
   fall into bands of factor two; a set takes part in the instance of its band and, where it can reach it, of the
   next. An instance cuts the shingle domain (by hash) into n1 parts of n2 = 3 cells; with n1·2 > k some part
   differs in at most one cell, so the sets agree on one of its 2-of-3 cell subsets. Each such subset is a
   signature. Parts are numerous enough that an agreeing subset is not empty; a set for which that cannot be
   shown also sends its empty subsets. In the smallest bands every shingle is a cell of its own.
4. *Rounds of leaders.* Signatures are screened as well (12 bytes to a shard, one bit back): only buckets with several
   components become rows. First one signature in ``FIRST_LOOK`` is used, which finds most links and leaves few
   components; then all of them. In each signature bucket the smallest component's smallest node is the leader. Every
   other node is compared (exactly) with the leader it shares most buckets with; links merge components, and
   buckets inside one component are finished. Rounds go on while links are found, so a group of n near copies
   costs about n comparisons a round, not n².
5. *Rest.* What is left in buckets with several components are mostly near misses. Two sets that link do not share one
   signature but many: so few differing shingles cannot spoil more cells. A set with fewer signatures in open buckets than
   that is done, and of the others all but that many (the most frequent are left out) lead every link to a common bucket.
   Sets that such buckets connect are a group; groups, one after the other, are cut into chunks of ``CHUNK`` sets. Within
   chunks, and between those that a group goes through, the sets of a group are compared as a whole by a product of 0/1
   matrices (exact counts), and only links come out: no pair of sets is ever a row.

Tables of a step are removed when all that reads them is written.

Edge cases: null or empty texts have empty sets (size 0, linked with nothing, their own component); 1-4 words
are one shingle; a row with a null id links nothing and its component is null; repeated rows and ids share
a component if their texts link; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempest.llm.blocks import pack_blocks, pack_table, unpack_table, write_blocks
from tempest.llm.graph import components
from tempest.llm.screen import screened
from tempest.llm.textops import MULT, SPACE_WORD, mix, prefix_hash, span_hash, spans, text_steps, window_hash
from tempest.session import discard, materialize

WORDS = 5
PERCENT = 75
#: Bands up to this size use single shingles as cells.
SMALL = 16
#: Parts of an instance as a share of its largest size.
PARTS = 0.18
#: Rows of an Arrow batch: of documents or sets (some KB each), of blocks (up to 4 MB each), of pairs of chunks (some MB each).
ROWS, BLOCK_ROWS, CHUNK_ROWS = 1000, 8, 2


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingles of each document, one after the other; offsets)."""
    n = len(off) - 1
    s, e, doc = spans(buf, off, SPACE_WORD)
    h = span_hash(prefix_hash(buf), s, e, buf)
    at, w = window_hash(h, doc, k)
    owner = doc[at]
    count = np.bincount(doc, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    for size in range(1, k):  # short documents: all words as one
        some = np.flatnonzero(count == size)
        acc = np.full(len(some), size, np.uint64)
        for j in range(size):
            acc = acc * np.uint64(MULT) + h[first[some] + j]
        owner, w = np.concatenate([owner, some]), np.concatenate([w, mix(acc + np.uint64(size))])
    order = np.lexsort((w, owner))
    owner, w = owner[order], w[order]
    new = np.ones(len(w), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (w[1:] != w[:-1])
    owner, w = owner[new], w[new]
    return w, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))).astype(np.int64)


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum (mod 2^64) of each slice."""
    c = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=c[1:])
    return c[at[1:]] - c[at[:-1]]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def document_sets(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) → doc_id, n_shingles, k1, k2 (digest of the set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, buf, off in text_steps(batches, "text"):
            w, at = shingle_sets(buf, off)
            yield pa.RecordBatch.from_arrays(
                [rb.column("doc_id"), pa.array(np.diff(at)), _signed(_sums(w, at)), _signed(_sums(mix(w ^ np.uint64(MULT)), at))],
                ["doc_id", "n_shingles", "k1", "k2"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long")


def _kept_sets(rb: pa.RecordBatch, ids: str, n: np.ndarray, w: np.ndarray, at: np.ndarray, more: np.ndarray, percent: int) -> pa.RecordBatch:
    """(doc_id, n, feats) of the rows of which enough shingles occur elsewhere; feats: only those."""
    ours = _sums(more.astype(np.uint64), at).astype(np.int64)
    ok = (n > 0) & (100 * ours >= percent * n) & np.asarray(rb.column(ids).is_valid())
    rows = np.flatnonzero(ok)
    feats = [w[at[i] : at[i + 1]][more[at[i] : at[i + 1]]].tobytes() for i in rows]
    return pa.RecordBatch.from_arrays([rb.column(ids).take(pa.array(rows)), pa.array(n[rows]), pa.array(feats, pa.binary())], ["doc_id", "n", "feats"])


_SETS = "doc_id long, n long, feats binary"


def shared_sets(blocks: DataFrame, total: int, percent: int) -> DataFrame:
    """blocks of documents (doc_id, text) → doc_id, n (size of its set), feats (its shared shingles) of the documents of
    which at least ``percent`` per cent of the shingles are shared with another document."""

    def items(rb: pa.RecordBatch) -> tuple[np.ndarray, None, np.ndarray]:
        parts, ats = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for _, buf, off in text_steps([rb], "text"):
            w, at = shingle_sets(buf, off)
            parts.append(w)
            ats.append(at[1:] + ats[-1][-1])
        return np.concatenate(parts), None, np.concatenate(ats)

    def apply(rb: pa.RecordBatch, w: np.ndarray, at: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
        return _kept_sets(rb, "doc_id", np.diff(at), w, at, more, percent)

    return screened(blocks, items, apply, _SETS, total)


def _feats(rb: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(f.as_buffer(), np.uint64) for f in rb.column("feats")]


def distinct_shared(blocks: DataFrame, total: int, percent: int) -> DataFrame:
    """blocks of sets (doc_id, n, feats), one row per distinct set → the same of those that share enough shingles with
    *another set* (before, copies of a set vouched for each other)."""

    def items(rb: pa.RecordBatch) -> tuple[np.ndarray, None, np.ndarray]:
        feats = _feats(rb)
        at = np.concatenate(([0], np.cumsum([len(f) for f in feats]))).astype(np.int64)
        return np.concatenate([np.zeros(0, np.uint64), *feats]), None, at

    def apply(rb: pa.RecordBatch, w: np.ndarray, at: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
        return _kept_sets(rb, "doc_id", rb.column("n").to_numpy(), w, at, more, percent)

    return screened(blocks, items, apply, _SETS, total)


def banded_signatures(n: int, feats: np.ndarray, percent: int) -> list[tuple[np.ndarray, int, int]]:
    """PartEnum signatures of one set (its size n, its shared shingles): (signatures, band, need) of each instance that it
    takes part in. A set that it links with there has at least ``need`` of these signatures too.

    Where the empty subsets are not sent, a part with two or more cells in use has three signatures. A differing shingle
    costs two of them, a second one in another cell the third; the least that ``spare`` shingles leave is ``need``."""
    out = []
    band = int(n).bit_length() - 1
    for b in (band, band + 1):
        low, top = 1 << b, (1 << (b + 1)) - 1
        if b > band and 100 * n < percent * low:
            break  # too small for a partner in the next band
        tag = np.uint64((b + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        if top <= SMALL:
            out.append((np.unique(mix(feats + tag)), b, -(-percent * n // 100)))  # the common shingles themselves
            continue
        partner = min(top, 100 * n // percent)
        spare = ((100 - percent) * (n + partner)) // (100 + percent) - (n - len(feats))
        if spare < 0:
            continue
        n1 = max(2, int(np.ceil(PARTS * top)))
        h = mix(feats ^ tag)
        cell = ((h >> np.uint64(32)) * np.uint64(3 * n1) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(3 * n1, np.uint64)
        np.add.at(sums, cell, mix(h))
        some = (np.bincount(cell, minlength=3 * n1) > 0).reshape(n1, 3)
        sums = sums.reshape(n1, 3)
        full = int((some.sum(1) >= 2).sum())
        certain = full > spare // 2
        sigs = []
        for x, y in ((0, 1), (0, 2), (1, 2)):
            place = mix((np.arange(n1, dtype=np.uint64) * np.uint64(4) + np.uint64(x + y)) ^ tag)
            sig = mix(sums[:, x] + np.uint64(MULT) * sums[:, y] + place)
            sigs.append(sig[some[:, x] | some[:, y]] if certain else sig)
        need = 3 * full - min(spare, full) - spare if certain else 1
        out.append((np.unique(np.concatenate(sigs)), b, max(1, need)))
    return out


def signatures(n: int, feats: np.ndarray, percent: int) -> np.ndarray:
    """All PartEnum signatures of one set."""
    out = [s for s, _, _ in banded_signatures(n, feats, percent)]
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


#: One in so many signatures (by hash) is used to find most links early; all are used afterwards.
FIRST_LOOK = 8


def _block_signatures(rb: pa.RecordBatch, percent: int, every: int) -> tuple[np.ndarray, np.ndarray]:
    """(signatures of all sets of a block; for each its row and its instance: need · 64 + band)."""
    sigs, rows, insts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, (n, f) in enumerate(zip(rb.column("n").to_pylist(), _feats(rb))):
        for s, band, need in banded_signatures(n, f, percent):
            s = s if every == 1 else s[mix(s) % np.uint64(every) == 0]
            sigs.append(s)
            rows.append(np.full(len(s), i))
            insts.append(np.full(len(s), need << 6 | band))
    return np.concatenate(sigs), np.stack([np.concatenate(rows), np.concatenate(insts)])


def _open_buckets(reps: DataFrame, comp: DataFrame, percent: int, every: int) -> DataFrame:
    """(sig, node, n, comp, inst): the rows of signature buckets that hold several components (a superset)."""
    total = reps.agg(F.sum("n")).first()[0] or 0
    blocks = pack_blocks(reps.join(comp, "node"), "feats", name="rep-blocks", batch_rows=ROWS)

    def items(rb: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        s, place = _block_signatures(rb, percent, every)
        return s, rb.column("comp").to_numpy()[place[0]], place

    def apply(rb: pa.RecordBatch, s: np.ndarray, place: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
        row = pa.array(place[0][more])
        return pa.RecordBatch.from_arrays([_signed(s[more]), *[rb.column(c).take(row) for c in ("node", "n", "comp")], pa.array(place[1][more])],
                                          ["sig", "node", "n", "comp", "inst"])

    found = screened(blocks, items, apply, "sig long, node long, n long, comp long, inst long", max(1, total // every), tagged=True)
    out = materialize(found, "signatures", BLOCK_ROWS)
    discard(blocks)
    return out


def _verified(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by the exact intersection of their sets."""
    left = reps.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("feats").alias("fa"))
    right = reps.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("feats").alias("fb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ok = []
            for na, nb, fa, fb in zip(rb.column("na").to_pylist(), rb.column("nb").to_pylist(), rb.column("fa"), rb.column("fb")):
                both = len(np.intersect1d(np.frombuffer(fa.as_buffer(), np.uint64), np.frombuffer(fb.as_buffer(), np.uint64), True))
                ok.append(100 * both >= percent * (na + nb - both))
            yield rb.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    fits = "100 * least(na, nb) >= {0} * greatest(na, nb)".format(percent)
    return pairs.join(left, "a").join(right, "b").where(fits).select("a", "b", "na", "nb", "fa", "fb").mapInArrow(run, "a long, b long")


def _merge(comp: DataFrame, links: DataFrame) -> DataFrame:
    """comp (node, comp) after the links between nodes."""
    to = comp.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    on = comp.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    edges = links.join(to, "a").join(on, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    moved = components(edges).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    out = comp.join(moved, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    out = materialize(out, "components")
    discard(comp, links)
    return out


def _several(rows: DataFrame) -> DataFrame:
    """The rows of buckets with more than one component, with the size of their bucket."""
    mixed = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return rows.join(mixed.where("lo != hi").select("sig", "size"), "sig")


def _still_open(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """``rows`` with the components of now, of the buckets with more than one."""
    out = materialize(_several(rows.drop("comp", "size").join(comp, "node")), "signatures")
    discard(rows)
    return out


def node_components(reps: DataFrame, percent: int) -> DataFrame:
    """reps (node, n, feats; written) → node, comp."""
    comp = reps.select("node", F.col("node").alias("comp"))
    fits = "100 * least(n, ln) >= {0} * greatest(n, ln)".format(percent)
    rows = None
    for every in (FIRST_LOOK, 1):
        if rows is not None:
            discard(rows)
        rows = _open_buckets(reps, comp, percent, every)
        while True:
            lead = rows.groupBy("sig").agg(F.min(F.struct("comp", "node", "n")).alias("l")).select(
                "sig", F.col("l.comp").alias("lc"), F.col("l.node").alias("leader"), F.col("l.n").alias("ln"))
            cand = rows.join(lead, "sig").where("comp != lc").where(fits).groupBy("node", "leader").agg(F.count(F.lit(1)).alias("c"))
            best = cand.groupBy("node").agg(F.max_by("leader", F.struct("c", "leader")).alias("b")).select(F.col("node").alias("a"), "b")
            links = materialize(_verified(best, reps, percent), "links", ROWS)
            if links.isEmpty():
                break
            comp = _merge(comp, links)
            rows = _still_open(rows, comp)
    links = _rest_links(rows, reps, percent)
    discard(rows)
    return comp if links.isEmpty() else _merge(comp, links)


#: Sets that are compared with each other in one step of the rest.
CHUNK = 1024
#: Columns of the 0/1 matrices in that step.
SLICE = 4096


def _hopeful(rows: DataFrame) -> DataFrame:
    """(sig, node, n, comp, size, first) of ``rows`` (those of open buckets) by which all links between components can still
    be found: sets that link share at least ``need`` signatures of an instance, all in open buckets. So a set with fewer there
    links with nothing; of the others' signatures, ordered from the rarest, the first that two such sets share is not among
    the last need - 1. size, first: sets of the bucket that is left, and their smallest node."""
    own = Window.partitionBy("node", "n", "inst")
    ranked = rows.withColumn("m", F.count(F.lit(1)).over(own)).withColumn("rank", F.row_number().over(own.orderBy("size", "sig")))
    some = materialize(ranked.where("rank <= m - shiftright(inst, 6) + 1").select("sig", "node", "n", "comp"), "prefixes")
    buckets = some.groupBy("sig").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("first"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    out = materialize(some.join(buckets.where("lo != hi").drop("lo", "hi"), "sig"), "signatures")
    discard(some)
    return out


def _chunk_pairs(placed: DataFrame) -> DataFrame:
    """(chunk, with): the pairs of chunks that have sets of one group (most groups lie in one chunk, with itself)."""
    at = placed.select("grp", "chunk").distinct()
    return at.join(at.select("grp", F.col("chunk").alias("with")), "grp").where("chunk <= with").select("chunk", "with").distinct()


def _rest_links(rows: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The links between sets of different components that share an open bucket, compared group by group.

    Only the buckets of ``_hopeful`` count. Sets that they connect stand together (within a group by their largest bucket)
    and are cut into chunks. Two chunks are compared if a group has members in both, group by group: a product of 0/1
    matrices gives all intersections. Pairs of chunks travel, not pairs of sets, and only links come out."""
    near = _hopeful(rows if "size" in rows.columns else _several(rows))
    group = components(near.select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()).select("node", F.col("comp").alias("grp"))
    key = materialize(near.groupBy("node", "n", "comp").agg(F.max(F.struct("size", "sig")).alias("k")).join(group, "node"), "keys")
    parts = max(1, -(-key.count() // (64 * CHUNK)))
    order = ["grp", "k", "n", "node"]
    placed = materialize(key.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "node", "n", "comp", "grp", F.floor(F.monotonically_increasing_id() / CHUNK).alias("chunk")), "rest")
    sets = placed.join(reps.select("node", "feats"), "node")

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("grp", "ascending"), ("node", "ascending")]).combine_chunks()
        return pa.table({"chunk": t["chunk"].slice(0, 1), "payload": pa.array([pack_table(t.to_batches()[0])], pa.binary())})

    chunks = materialize(sets.groupBy("chunk").applyInArrow(pack, "chunk long, payload binary"), "chunks", ROWS)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for x, y in zip(rb.column("x"), rb.column("y")):
                yield from _group_links(unpack_table(x.as_py()), unpack_table(y.as_py()), percent)

    both = _chunk_pairs(placed).join(chunks.withColumnRenamed("payload", "x"), "chunk").join(
        chunks.select(F.col("chunk").alias("with"), F.col("payload").alias("y")), "with")
    links = materialize(both.select("x", "y").mapInArrow(compare, "a long, b long"), "links", CHUNK_ROWS)
    discard(near, key, placed, chunks)
    return links


def _group_links(x: pa.RecordBatch, y: pa.RecordBatch, percent: int) -> Iterator[pa.RecordBatch]:
    """``_chunk_links`` of the sets of each group (grp, by which both are ordered) that is in both chunks."""

    def groups(rb: pa.RecordBatch) -> dict[int, pa.RecordBatch]:
        g = rb.column("grp").to_numpy()
        cut = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1], [True])))
        return {int(g[a]): rb.slice(a, b - a) for a, b in zip(cut[:-1], cut[1:])}

    gx, gy = groups(x), groups(y)
    for g in gx.keys() & gy.keys():
        found = _chunk_links(gx[g], gy[g], percent)
        if found.num_rows:
            yield found


def _chunk_links(x: pa.RecordBatch, y: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    """Links (a < b, different components) between the sets of two chunks (node, n, comp, feats)."""
    fx, fy = _feats(x), _feats(y)
    common = np.intersect1d(np.concatenate(fx), np.concatenate(fy))

    def places(feats: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        f, row = np.concatenate(feats), np.repeat(np.arange(len(feats)), [len(v) for v in feats])
        at = np.minimum(np.searchsorted(common, f), max(len(common) - 1, 0))
        ok = common[at] == f if len(common) else np.zeros(len(f), bool)
        order = np.argsort(at[ok], kind="stable")
        return at[ok][order], row[ok][order]

    (cx, rx), (cy, ry) = places(fx), places(fy)
    both = np.zeros((len(fx), len(fy)))  # sums of exact small products
    for a in range(0, len(common), SLICE):
        mats = []
        for c, r, n in ((cx, rx, len(fx)), (cy, ry, len(fy))):
            lo, hi = np.searchsorted(c, [a, a + SLICE])
            m = np.zeros((n, min(SLICE, len(common) - a)), np.float32)
            m[r[lo:hi], c[lo:hi] - a] = 1
            mats.append(m)
        both += mats[0] @ mats[1].T
    size = x.column("n").to_numpy()[:, None] + y.column("n").to_numpy()[None, :]
    nx, ny = x.column("node").to_numpy(), y.column("node").to_numpy()
    ok = (100 * both >= percent * (size - both)) & (x.column("comp").to_numpy()[:, None] != y.column("comp").to_numpy()[None, :])
    i, j = np.nonzero(ok & (nx[:, None] != ny[None, :]))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(nx[i], ny[j])), pa.array(np.maximum(nx[i], ny[j]))], ["a", "b"])


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document row."""
    d = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    sets = materialize(document_sets(d), "sets", ROWS)
    full = sets.where("n_shingles > 0 and doc_id is not null")
    nodes = full.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("node"))
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    blocks = write_blocks(d, batch_rows=ROWS)
    shared = shared_sets(blocks, total, percent)
    # one row for each node: documents that stand for their set (repeated ids may give several; any will do)
    stand = nodes.select("k1", "k2", "node").join(full.select("k1", "k2", F.col("doc_id").alias("node")).distinct(), ["k1", "k2", "node"])
    one = shared.join(stand.select(F.col("node").alias("doc_id"), "k1", "k2"), "doc_id")
    sets_once = materialize(one.select("doc_id", "n", "feats"), "sets-once", BLOCK_ROWS)
    discard(blocks)
    shingles = sets_once.agg(F.sum(F.length("feats")) / 8).first()[0] or 0
    blocks = pack_blocks(sets_once, "feats", name="set-blocks", batch_rows=ROWS)
    discard(sets_once)
    reps = materialize(distinct_shared(blocks, int(shingles), percent).withColumnRenamed("doc_id", "node"), "reps", BLOCK_ROWS)
    discard(blocks)
    comp = materialize(node_components(reps, percent).select("node", "comp"), "components")
    discard(reps)
    named = nodes.join(comp, "node", "left").select("k1", "k2", "n_shingles", F.coalesce("comp", "node").alias("comp"))
    out = sets.join(named, ["k1", "k2", "n_shingles"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("comp")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' '))) END AS s FROM w),
f AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM g),
c AS (SELECT a.doc_id AS p, b.doc_id AS q, any_value(a.n) AS np, any_value(b.n) AS nq, count(*) AS k
      FROM f a JOIN f b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT p, q FROM c WHERE 100 * k >= 75 * (np + nq - k)),
sym AS (SELECT p, q FROM e UNION ALL SELECT q, p FROM e),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM g UNION SELECT r.doc_id, sym.q FROM r JOIN sym ON sym.p = r.other)
SELECT g.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, m.component_id
FROM g JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) m ON m.doc_id = g.doc_id
"""
