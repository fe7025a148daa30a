"""Benchmark decontamination: prefix-filtered set join of item windows against all documents.

An item's windows are its runs of ``window`` consecutive words (all its words, if fewer). A window is
contained in a document only if every one of its words is, so with the words ordered by rarity in the
documents the *first* one is a sufficient prefix: (rarest word, its place in the window) is joined with the
document's words. Positional and length bounds (the window must fit between the start and the end of the
document around that place) go before the exact comparison of all words.

1. One pass counts, over all documents, the words that occur in items (partial sums per slice; the result has
   a row per item word and counts grow with the corpus, not in number).
2. The windows, their words ordered by these counts, are the build side. They are cut into slices of at most
   ``SLICE_WORDS`` window words (a fixed number of bytes); each slice is broadcast and joined in one pass over
   the documents, so the memory does not grow with the benchmark: a benchmark beyond one slice takes more passes.
3. Each pass gives (document, hit places as runs, item ids); with several slices they are merged per document.

A word is compared by its 64-bit hash, a window by those of all its words in order.

Edge cases: null or empty texts have no words and no hits; an item without words has no windows; equal items
are found together; repeated document rows are counted apart (rows are numbered); an empty benchmark leaves
every document clean; empty documents give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.llm.textops import ALNUM_WORD, per_doc, prefix_hash, span_hash, spans, text_steps
from tempest.session import materialize

WINDOW = 10
#: Window words that one broadcast slice holds: about 10 MB of arrays.
SLICE_WORDS = 1_000_000


def doc_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    s, e, doc = spans(buf, off, ALNUM_WORD)
    return s, e, doc, span_hash(prefix_hash(buf), s, e, buf)


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item string, size, words array<long>): distinct windows of each item."""
    b = benchmark.select(benchmark[item_col].cast("string").alias("item"), benchmark[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, buf, off in text_steps(batches, "text"):
            _, _, doc, h = doc_words(buf, off)
            h = h.view(np.int64)
            cut = np.searchsorted(doc, np.arange(rb.num_rows + 1))
            items = rb.column("item").to_pylist()
            out = {(items[i], tuple(h[a : min(a + window, cut[i + 1])].tolist()))
                   for i in range(rb.num_rows) for a in range(cut[i], max(cut[i] + (cut[i + 1] > cut[i]), cut[i + 1] - window + 1))}
            out = sorted(out, key=lambda x: (x[0] or "", x[1]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([list(x[1]) for x in out], pa.list_(pa.int64()))],
                                             ["item", "words"])

    return b.mapInArrow(run, "item string, words array<bigint>").distinct()


class WindowIndex:
    """Windows of one slice, keyed by their rarest word. Plain numpy arrays, so that it is cheap to ship."""

    def __init__(self, rows: list, counts: dict[int, int], state: dict | None = None):
        if state is not None:  # as shipped to the tasks
            self.__dict__.update(state)
            return
        self.items = sorted({r["item"] for r in rows if r["item"] is not None})
        of = {x: i for i, x in enumerate(self.items)}
        groups: dict[tuple, list[int]] = {}
        for r in rows:
            groups.setdefault(tuple(r["words"]), []).append(of.get(r["item"], -1))
        keys, place, size, words, owners = [], [], [], [], []
        for w, own in groups.items():
            j = min(range(len(w)), key=lambda i: (counts.get(w[i], 0), w[i], i))  # rarest; ties by hash
            keys.append(w[j]), place.append(j), size.append(len(w)), words.append(w), owners.append(own)
        order = np.argsort(np.asarray(keys, np.int64), kind="stable")
        width = max(map(len, words), default=1)
        self.key = np.asarray(keys, np.int64)[order]
        self.place = np.asarray(place, np.int64)[order]
        self.size = np.asarray(size, np.int64)[order]
        self.words = np.zeros((len(keys), width), np.int64)
        for k, i in enumerate(order):
            self.words[k, : len(words[i])] = words[i]
        self.owners = [owners[i] for i in order]

    def occurrences(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word index, window) of every occurrence in the words of a slice of documents."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.key) or not len(h):
            return none
        h = h.view(np.int64)
        lo = np.searchsorted(self.key, h)
        found = np.flatnonzero(self.key[np.minimum(lo, len(self.key) - 1)] == h)
        lo = lo[found]
        n = np.searchsorted(self.key, h[found], side="right") - lo
        out_at, out_w = [], []
        for k in range(int(n.max()) if len(n) else 0):  # windows that share their rarest word
            more = n > k
            at, w = found[more], lo[more] + k
            a = at - self.place[w]
            z = a + self.size[w] - 1
            ok = (a >= 0) & (z < len(h))
            at, w, a, z = at[ok], w[ok], a[ok], z[ok]
            ok = (doc[a] == doc[at]) & (doc[z] == doc[at])  # positional and length bounds
            w, a = w[ok], a[ok]
            for j in range(self.words.shape[1]):
                ok = (j >= self.size[w]) | (h[np.minimum(a + j, len(h) - 1)] == self.words[w, j])
                w, a = w[ok], a[ok]
            out_at.append(a), out_w.append(w)
        return (np.concatenate(out_at), np.concatenate(out_w)) if out_at else none


def word_counts(docs: DataFrame, text_col: str, words: np.ndarray) -> dict[int, int]:
    """Occurrences of each of ``words`` (sorted hashes of item words: a bounded slice) in all documents."""
    d = docs.select(docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words), np.int64)
        for _, buf, off in text_steps(batches, "text"):
            h = doc_words(buf, off)[3].view(np.int64)
            at = np.minimum(np.searchsorted(words, h), len(words) - 1)
            total += np.bincount(at[words[at] == h], minlength=len(words))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(words[some]), pa.array(total[some])], ["w", "n"])

    return {r.w: r.n for r in d.mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()}


def _slices(windows: DataFrame, n: int) -> Iterator[list]:
    """The windows in ``n`` bounded lists."""
    for k in range(n):
        yield (windows.where(F.pmod(F.xxhash64("words"), F.lit(n)) == k) if n > 1 else windows).collect()


def _indexes(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, window: int,
             slice_words: int) -> tuple[int, Iterator]:
    """(number of slices, their broadcast indexes one after the other)."""
    windows = materialize(item_windows(benchmark, item_col, item_text_col, window), "windows")
    n = max(1, -(-(windows.agg(F.sum(F.size("words"))).first()[0] or 0) // slice_words))

    def indexes() -> Iterator:
        for rows in _slices(windows, n):
            counts = word_counts(docs, text_col, np.unique(np.asarray([x for r in rows for x in r["words"]], np.int64))) if rows else {}
            yield docs.sparkSession.sparkContext.broadcast(vars(WindowIndex(rows, counts)))

    return n, indexes()


def without_windows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", window: int = WINDOW, slice_words: int = SLICE_WORDS) -> DataFrame:
    """The rows of ``docs`` (all columns as they are) in which no item window occurs."""
    at = docs.columns.index(text_col)
    clean = docs
    for index in _indexes(docs, benchmark, text_col, item_col, item_text_col, window, slice_words)[1]:

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            ix = WindowIndex([], {}, index.value)
            for rb, buf, off in text_steps(batches, at):
                _, _, doc, h = doc_words(buf, off)
                keep = np.ones(rb.num_rows, bool)
                keep[doc[ix.occurrences(h, doc)[0]]] = False
                yield rb.filter(pa.array(keep))

        clean = clean.mapInArrow(run, docs.schema)
    return clean


def find_windows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                 slice_words: int = SLICE_WORDS) -> DataFrame:
    """Per document row: doc_id, n_words, ``runs`` (hit words as [first, end) runs), ``items`` (ids, sorted)."""
    d = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    schema = f"uid long, doc_id {kind}, n_words long, runs array<struct<first:long,end:long>>, items array<string>"
    run_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    parts = []
    n_slices, indexes = _indexes(docs, benchmark, text_col, item_col, item_text_col, window, slice_words)
    if n_slices > 1:  # rows keep a number of their own, so that the slices' results meet row by row
        d = materialize(d.withColumn("uid", F.monotonically_increasing_id()), "documents")
    else:
        d = d.withColumn("uid", F.lit(0).cast("long"))
    for index in indexes:

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            ix = WindowIndex([], {}, index.value)
            for rb, buf, off in text_steps(batches, "text"):
                _, _, doc, h = doc_words(buf, off)
                n = per_doc(doc, rb.num_rows)
                base = np.concatenate(([0], np.cumsum(n)))
                a, w = ix.occurrences(h, doc)
                step = np.zeros(len(h) + 1, np.int64)
                np.add.at(step, a, 1)
                np.add.at(step, a + ix.size[w], -1)
                hit = np.cumsum(step[:-1]) > 0
                edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
                first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                runs = [[] for _ in range(rb.num_rows)]
                for f, e in zip(first.tolist(), end.tolist()):
                    while f < e:  # a run may cross from one document into the next
                        i = int(doc[f])
                        stop = min(e, int(base[i + 1]))
                        runs[i].append({"first": f - int(base[i]), "end": stop - int(base[i])})
                        f = stop
                items = [set() for _ in range(rb.num_rows)]
                for i, x in zip(doc[a].tolist(), w.tolist()):
                    items[i].update(ix.items[o] for o in ix.owners[x] if o >= 0)
                yield pa.RecordBatch.from_arrays(
                    [rb.column("uid"), rb.column("doc_id"), pa.array(n), pa.array(runs, run_type),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string()))], ["uid", "doc_id", "n_words", "runs", "items"])

        parts.append(d.select("uid", "doc_id", "text").mapInArrow(run, schema))
    return (parts[0] if len(parts) == 1 else _merged(parts)).drop("uid")


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Union of the slices' hits per document row."""
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    flat = F.array_sort(F.flatten(F.collect_list("runs")))
    joined = F.aggregate(flat, F.expr("cast(array() as array<struct<first:bigint,end:bigint>>)"), lambda acc, r: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= r["first"]),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
            F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["end"], r["end"]).alias("end")))),
    ).otherwise(F.concat(acc, F.array(r))))
    return allp.groupBy("uid", "doc_id", "n_words").agg(
        joined.alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def hit_counts(found: DataFrame) -> DataFrame:
    """The digest columns of the contract from ``find_windows``."""
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["first"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return hit_counts(find_windows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
v AS (SELECT DISTINCT item, unnest(list_transform(range(1, greatest(2, len(ws) - 8)), lambda i: list_slice(ws, i, i + 9))) AS w FROM b WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT len(w) AS k FROM v),
p AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, sizes WHERE len(ws) >= k),
o AS (SELECT p.doc_id, p.i, p.k, v.item FROM p JOIN v ON v.w = list_slice(p.ws, p.i, p.i + p.k - 1)),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM o)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON hits.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""
