"""Word count: text → lines → words split on a space → count per word (batch) and running counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tempest.functions.java import java_split
from tempest.operators.scan import DEFAULT_BLOCK, Running, join_null_safe
from tempest.session import materialize


#: Bytes of occurrences in a block, about, whatever the length of the words.
BLOCK_BYTES = 64 << 20


def _strip_cr(line: Column) -> Column:
    """Drop one trailing carriage return (a CRLF line ending)."""
    return F.when(line.endswith("\r"), F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def text_lines(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Lines of each text, as a text-file reader yields them: split on ``\\n``, a trailing ``\\r``
    removed, and no extra empty line after a final line break. Whole texts, every line."""
    t = F.col(text_col)
    body = F.when(t.endswith("\n"), F.expr(f"substring({text_col}, 1, char_length({text_col}) - 1)")).otherwise(t)
    return (
        docs.where(t.isNotNull() & (t != ""))
        .select(*keep, F.posexplode(F.split(body, "\n", -1)).alias("line_no", "line"))
        .withColumn("line", _strip_cr(F.col("line")))
    )


def tokenize(lines: DataFrame, line_col: str = "line", sep: str = " ", keep: tuple[str, ...] = ()) -> DataFrame:
    """``flatMap(line -> for w in line.split(" "): (w, 1))`` with JDK split rules."""
    return lines.select(*keep, F.explode(java_split(line_col, sep)).alias("word"))


def word_count(lines: DataFrame, line_col: str = "line", sep: str = " ") -> DataFrame:
    """``groupBy(0).sum(1)``: (word, cnt). Partial aggregation makes a very common word cheap."""
    return tokenize(lines, line_col, sep).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def word_occurrences(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", sep: str = " ") -> DataFrame:
    """Every word occurrence of every text, in reading order, as ``(id, pos, word)``: ``pos`` is the word's
    position in its text (lines as in :func:`text_lines`)."""
    t = F.col(text_col)
    body = F.when(t.endswith("\n"), F.expr(f"substring({text_col}, 1, char_length({text_col}) - 1)")).otherwise(t)
    lines = F.transform(F.split(body, "\n", -1), _strip_cr)
    words = F.flatten(F.transform(lines, lambda line: java_split(line, sep)))
    return docs.where(t.isNotNull() & (t != "")).select(id_col, F.posexplode(words).alias("pos", "word"))


def word_spec(id_col: str = "doc_id", seq: str = "seq") -> Running:
    return Running(("word",), {"cnt": ("count", F.lit(1))}, lambda d: d.select(id_col, "pos", "word", "cnt"), seq=seq)


def word_blocks(words: DataFrame, id_col: str = "doc_id", block: int = DEFAULT_BLOCK) -> DataFrame:
    """``words`` in the order of (id, pos), as (block long, payload binary): a row for up to ``block`` occurrences (and about ``BLOCK_BYTES``), an
    Arrow table with the words as a dictionary, compressed. Rows are range-partitioned and sorted, the only time that
    they are shuffled one by one, and the blocks are written once so that every use sees the same ones."""
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = words.select(id_col, "pos", "word").repartitionByRange(n, id_col, "pos").sortWithinPartitions(id_col, "pos")

    def packed(block_no: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        t = t.set_column(2, "word", t["word"].dictionary_encode("encode")).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(t)
        return pa.RecordBatch.from_arrays([pa.array([block_no], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block_no, held, size, room = TaskContext.get().partitionId() << 32, [], 0, BLOCK_BYTES
        for rb in batches:
            while rb.num_rows:
                held.append(rb.slice(0, block - size))
                rb = rb.slice(held[-1].num_rows)
                size += held[-1].num_rows
                room -= held[-1].nbytes
                if size == block or room <= 0:
                    yield packed(block_no, held)
                    block_no, held, size, room = block_no + 1, [], 0, BLOCK_BYTES
        if held:
            yield packed(block_no, held)

    return materialize(d.mapInArrow(run, "block long, payload binary"), "word-blocks")


def _block_words(payload: pa.Scalar) -> tuple[pa.Table, np.ndarray, pa.Array]:
    """(the block's rows, the place of each row's word among its distinct words, these words)."""
    t = pa.ipc.open_stream(payload.as_buffer()).read_all()
    word = t["word"].combine_chunks()
    return t, word.indices.to_numpy(), word.dictionary


def word_totals(blocks: DataFrame) -> DataFrame:
    """(block, i, word, n): how often each word is in each block; i: its place among the block's distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for block, payload in zip(rb.column("block").to_pylist(), rb.column("payload")):
                _, at, distinct = _block_words(payload)
                n = len(distinct)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), distinct.cast(pa.string()),
                                                  pa.array(np.bincount(at, minlength=n))], ["block", "i", "word", "n"])

    return blocks.mapInArrow(run, "block long, i int, word string, n long")


def running_counts(words: DataFrame, id_col: str = "doc_id", block: int = DEFAULT_BLOCK, base: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(``(id, pos, word, cnt)`` per occurrence, ``(word, cnt, _rows)`` per word of ``words``): :func:`word_spec` on words.

    Occurrences travel in blocks (:func:`word_blocks`). A block sends one row for each of its distinct words, so the window
    over a word has a row per block; its prefix comes back, as the word's place, to those blocks where it is not 0, and a
    block counts on from there. ``base``: the totals before the first occurrence."""
    blocks = word_blocks(words, id_col, block)
    totals = word_totals(blocks)
    rows = totals if base is None else totals.unionByName(base.select(F.lit(-1).cast("long").alias("block"), F.lit(0).alias("i"), "word", F.col("cnt").alias("n")))
    earlier = Window.partitionBy("word").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.withColumn("before", F.sum("n").over(earlier)).where("before > 0 and block >= 0").select("block", "i", "before")
    out = StructType([*words.select(id_col, "pos", "word").schema, StructField("cnt", LongType())])

    def counted(given: pa.Table, answers: pa.Table) -> pa.Table:
        t, at, distinct = _block_words(given["payload"][0])
        before = np.zeros(len(distinct), np.int64)
        before[answers["i"].to_numpy()] = answers["before"].to_numpy()
        order = np.argsort(at, kind="stable")
        size = np.bincount(at, minlength=len(distinct))
        cnt = np.empty(len(at), np.int64)
        cnt[order] = np.arange(1, len(at) + 1) - np.repeat(np.cumsum(size) - size, size)
        return t.set_column(2, "word", distinct.cast(pa.string()).take(pa.array(at))).append_column("cnt", pa.array(cnt + before[at]))

    counts = blocks.groupBy("block").cogroup(carry.groupBy("block")).applyInArrow(counted, out)
    now = totals.groupBy("word").agg(F.sum("n").alias("cnt"), F.sum("n").alias("_rows"))
    if base is not None:
        old = base.select("word", F.col("cnt").alias("_cnt"))
        now = join_null_safe(now, old, ["word"], "left").select("word", *[(F.col(c) + F.coalesce("_cnt", F.lit(0))).alias(c) for c in ("cnt", "_rows")])
    return counts, now


def running_word_count(words: DataFrame, id_col: str = "doc_id", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Streaming ``keyBy(0).sum(1)`` emitted per word occurrence: the running count of the word at each
    occurrence, in (id, pos) order."""
    return running_counts(words, id_col, block)[0]
