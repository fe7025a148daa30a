"""Best-fit packing of token pieces into sequences by hierarchical residual packing.

1. Every document is tokenised, closed with an end id and cut (only if longer) into pieces of ``capacity``
   tokens. Pieces of full length are sequences of their own.
2. Each partition packs its other pieces best-fit, longest first, in groups of at most ``GROUP_ITEMS``.
   Bins with a residual of at most ``slack`` tokens are closed: they are sequences.
3. All underfull bins travel as items up a tree: about ``FAN_IN`` nodes meet in one task, which packs
   their bins best-fit again, closes the nearly full ones and sends the rest up, until one node is left. Bins are dealt to
   tasks of about ``GROUP_ITEMS``, whatever their number.
4. Where the bins that are left are too many for one node and more levels would not make them fewer, they meet as
   counts: there are less than ``capacity`` different fills, and best-fit of counted items is runs of bins. Each bin finds
   its run by its rank among the bins of its fill.
5. Pieces find their sequence by one join per level on the bin id (an id occurs once on the right side).

Pieces and levels are written below the checkpoint folder, so ids stay the same if an executor is lost.

Edge cases: a null or empty text is one piece with the end id alone; null and repeated document ids and
repeated rows are packed row by row; an empty table gives an empty result; other columns are not read. A sequence is named by
a number of its own (negative where counts have met).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempest.llm.op3_token_counts import CHUNK_CHARS, OVERLAP_CHARS, huge_documents
from tempest.llm.pieces import PieceEncoder, encode_long, load_tokenizer
from tempest.llm.textops import text_steps
from tempest.session import materialize

CAPACITY = 2048
END_ID = 0
SLACK = 8
GROUP_ITEMS = 100_000
FAN_IN = 8


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin of each item, place in it, fill of each bin). Items of 1..capacity.

    Open bins are kept by residual; one big integer has a bit for each residual that has a bin, so the
    tightest bin that still takes an item is the lowest set bit at or above its size."""
    order = np.argsort(-sizes, kind="stable")
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    bin_of, place, fill = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    for i, s in zip(order.tolist(), sizes[order].tolist()):
        fit = mask >> s
        if fit:
            r = s + (fit & -fit).bit_length() - 1
            b = stacks[r].pop()
            if not stacks[r]:
                mask &= ~(1 << r)
            place[i] = capacity - r
            fill[b] += s
            r -= s
        else:
            b, r = len(fill), capacity - s
            fill.append(s)
        bin_of[i] = b
        if r:
            stacks[r].append(b)
            mask |= 1 << r
    return bin_of, place, np.asarray(fill, np.int64)


def best_fit_counted(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing of ``counts[size]`` items of each size, as ``best_fit`` packs them, in runs: rows (size, rank,
    bins, per, bin, place). Of the items of ``size``, ``per`` each go to the bins ``bin``, ``bin`` + 1, ... (``bins`` of
    them) from ``place`` on, those from the ``rank``-th on."""
    runs: list[tuple[int, int, int, int, int, int]] = []
    stacks: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by residual: (first bin, bins)
    mask = made = 0
    for s in sorted(counts, reverse=True):
        rank, left = 0, counts[s]
        while left:
            fit = mask >> s
            r = s + (fit & -fit).bit_length() - 1 if fit else capacity
            per = min(r // s, left)  # a bin that has taken one is the tightest for the next
            if fit:
                b, m = stacks[r].pop()
                k = min(m, left // per)
                if k < m:
                    stacks[r].append((b + k, m - k))
                if not stacks[r]:
                    mask &= ~(1 << r)
            else:
                b, k = made, left // per
                made += k
            runs.append((s, rank, k, per, b, capacity - r))
            rank, left = rank + k * per, left - k * per
            if rest := r - per * s:
                stacks[rest].append((b, k))
                mask |= 1 << rest
    return np.asarray(runs, np.int64).reshape(-1, 6)


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, uid) of every document."""
    d = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tok = PieceEncoder.on_worker(tokenizer_path), load_tokenizer(tokenizer_path)
        uid = TaskContext.get().partitionId() << 36
        end = np.array([END_ID], "<u4")
        for rb, buf, off in text_steps(batches, "text"):
            small, at, huge = huge_documents(buf, off, CHUNK_CHARS)
            ids, to = enc.ids(small, at)
            rows, starts, sizes, crcs = [], [], [], []
            for i in range(rb.num_rows):
                if i in huge:
                    x = np.concatenate([*encode_long(tok, huge[i], CHUNK_CHARS, OVERLAP_CHARS), end])
                else:
                    x = np.concatenate([ids[to[i] : to[i + 1]], end])
                x = x.astype("<u4", copy=False)
                for a in range(0, len(x), capacity):
                    part = x[a : a + capacity]
                    rows.append(i)
                    starts.append(a)
                    sizes.append(len(part))
                    crcs.append(zlib.crc32(part.tobytes()))
            start = np.asarray(starts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [rb.column("doc_id").take(pa.array(rows, pa.int64())), pa.array((start // capacity).astype(np.int32)),
                 pa.array(start), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()),
                 pa.array(np.arange(uid, uid + len(rows), dtype=np.int64))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "uid"])
            uid += len(rows)

    return d.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, uid long")


_LEVEL = "uid long, bin long, place long, node long, fill long, up boolean"


def _pack(uid: np.ndarray, size: np.ndarray, node: int, capacity: int, slack: int, root: bool) -> pa.RecordBatch:
    """One node: each item with its bin (named by its first item), and for that item alone the bin's fill
    and whether the bin goes up."""
    b, place, fill = best_fit(size, capacity)
    head = np.flatnonzero(place == 0)
    name = np.zeros(len(fill), np.int64)
    name[b[head]] = uid[head]
    up = np.zeros(len(fill), bool) if root else fill < capacity - slack
    is_head = place == 0
    return pa.RecordBatch.from_arrays(
        [pa.array(uid), pa.array(name[b]), pa.array(place), pa.array(np.full(len(uid), node, np.int64)),
         pa.array(np.where(is_head, fill[b], 0)), pa.array(is_head & up[b])],
        ["uid", "bin", "place", "node", "fill", "up"])


def _placed_by_counts(rest: DataFrame, capacity: int) -> DataFrame:
    """The root for any number of items: rows of ``_LEVEL``, the bins named by negative numbers. rest (uid, length, node;
    written, a bounded number of rows a node)."""
    counts = rest.groupBy("node", "length").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.partitionBy("length").orderBy("node").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select("node", "length", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("node", "length").orderBy("uid")) - 1
    ranked = rest.withColumn("own", own).join(before, ["node", "length"]).select("uid", "length", (F.col("own") + F.col("before")).alias("rank"))
    total = {r.length: r.c for r in counts.groupBy("length").agg(F.sum("c").alias("c")).collect()}  # less than capacity rows
    return ranked.mapInArrow(_in_runs(best_fit_counted(total, capacity)), _LEVEL)


def _in_runs(runs: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    by_size = runs[np.lexsort((runs[:, 1], runs[:, 0]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            size, rank = rb.column("length").to_numpy(), rb.column("rank").to_numpy()
            span = int(by_size[:, 1].max()) + 1 if len(by_size) else 1  # one key of size and first rank
            at = np.searchsorted(by_size[:, 0] * span + by_size[:, 1], size * span + np.minimum(rank, span - 1), side="right") - 1
            _, first, _, per, b, place = by_size[at].T
            i, j = np.divmod(rank - first, per)
            n = rb.num_rows
            yield pa.RecordBatch.from_arrays(
                [rb.column("uid"), pa.array(-1 - (b + i)), pa.array(place + j * size), pa.array(np.zeros(n, np.int64)),
                 pa.array(np.zeros(n, np.int64)), pa.array(np.zeros(n, bool))], ["uid", "bin", "place", "node", "fill", "up"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, group_items: int = GROUP_ITEMS,
         fan_in: int = FAN_IN) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (needs a unique ``uid`` and a ``length`` of
    1..capacity; must be a written table or otherwise stable)."""
    items = pieces.where(F.col("length") < capacity).select("uid", F.col("length").cast("long"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held, n = TaskContext.get().partitionId(), 0, [], 0
        for rb in batches:
            for a in range(0, rb.num_rows, group_items):
                held.append(rb.slice(a, group_items))
                n += held[-1].num_rows
                if n >= group_items:
                    t, held, n = pa.Table.from_batches(held), [], 0
                    yield _pack(t["uid"].to_numpy(), t["length"].to_numpy(), (part << 20) + k, capacity, slack, False)
                    k += 1
        if held:
            t = pa.Table.from_batches(held)
            yield _pack(t["uid"].to_numpy(), t["length"].to_numpy(), (part << 20) + k, capacity, slack, False)

    level = materialize(items.mapInArrow(local, _LEVEL), "pack-level")
    # at each level the bins are dealt evenly to a FAN_IN-th as many parents, or to more if these would get too many
    placed = pieces.withColumn("sequence_id", F.col("uid")).withColumn("offset", F.lit(0).cast("long"))
    while True:
        step = level.select(F.col("uid").alias("sequence_id"), "bin", "place")
        placed = placed.join(step, "sequence_id", "left").select(
            *[c for c in placed.columns if c not in ("sequence_id", "offset")],
            F.coalesce("bin", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("place", F.lit(0))).alias("offset"))
        rest = level.where("up").select(F.col("bin").alias("uid"), F.col("fill").alias("length"), "node")
        nodes, left = rest.agg(F.countDistinct("node"), F.count(F.lit(1))).first()
        if nodes == 0:
            return placed
        parents = max(-(-nodes // fan_in), -(-left // group_items))
        if parents >= nodes and left > group_items:
            level = materialize(_placed_by_counts(rest, capacity), "pack-level")
            continue
        meet = F.pmod(F.xxhash64("uid"), F.lit(parents)) if parents > 1 else F.lit(0).cast("long")
        root = parents == 1

        def merge(t: pa.Table) -> pa.Table:
            t = t.sort_by("uid")
            return pa.Table.from_batches([_pack(t["uid"].to_numpy(), t["length"].to_numpy(), t["node"][0].as_py() << 20,
                                                capacity, slack, root)])

        level = materialize(rest.withColumn("node", meet).groupBy("node").applyInArrow(merge, _LEVEL), "pack-level")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialize(tokenised_pieces(docs, tokenizer_path, id_col, text_col, capacity), "pieces")
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
