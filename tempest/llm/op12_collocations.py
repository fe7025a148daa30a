"""Phrase collocation mining: Misra-Gries summaries per hash partition, then exact counts of what survives.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words ``[^\\x20\\x09]+``. A
phrase is 1 to ``max_words`` consecutive words of a piece; everything is counted per language (null: ``und``).

First pass: blocks of documents count their own phrases exactly and send each hash partition the 32-bit values of its
phrases with their counts (at most ``min_count``: more proves nothing more). A partition merges these summaries into one
Misra-Gries summary: when it has more counters than its capacity, the largest counter that exceeds the capacity is taken
off all. The capacity is larger than the partition's mass divided by ``min_count``, so less than ``min_count`` is ever
taken off in all and every phrase that occurs ``min_count`` times survives; a phrase whose counter plus all that was
taken off is below ``min_count`` is proven rare and goes too. The block gets one bit a phrase, in the order sent.

Second pass: the blocks count the surviving phrases by their texts, and Spark adds these counts up; only totals of at
least ``min_count`` stay. Parts of a frequent phrase are frequent, so their counts are among them.

Scores are integer divisions of decimals: exact up to counts of 10^15.

Edge cases: null or empty texts have no words; null ids do not matter (ids are not read); equal rows count each; an empty
table gives an empty result; other columns, whatever their names, are not read. A text longer than a block is cut at
a piece separator (phrases never span one), so one step's memory is bounded unless a single piece is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempest.llm.blocks import unpack_table, write_blocks
from tempest.llm.sums import SHARD_KEYS, by_block, dealt, number_of_shards
from tempest.llm.textops import MULT, lut, mix, spans, text_buffer
from tempest.session import materialize

BLOCK_BYTES = 4 << 20
#: Salts of the first round of the top list.
TOP_SALTS = 64

_PIECE_END = lut((0x0A, 0x0D)) | np.isin(np.arange(256), [ord(c) for c in ".,;:!?"])
_WORD = ~(_PIECE_END | lut((0x20, 0x20), (0x09, 0x09)))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class MisraGries:
    """Counters of at most ``capacity`` keys. ``taken``: what has been taken off every counter in all, which is at
    most the mass divided by (capacity + 1); a key's true count is between its counter and counter + taken."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds another summary (or plain counts, keys may repeat)."""
        self.keys, at = np.unique(np.concatenate((self.keys, keys)), return_inverse=True)
        self.counts = np.bincount(at, weights=np.concatenate((self.counts, counts)), minlength=len(self.keys)).astype(np.int64)
        if len(self.keys) > self.capacity:
            off = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            self.counts -= off
            self.taken += off
            keep = self.counts > 0
            self.keys, self.counts = self.keys[keep], self.counts[keep]

    def survivors(self, min_count: int) -> np.ndarray:
        return self.keys[self.counts + self.taken >= min_count]


class PhraseCounts:
    """The distinct phrases of a block: for each length, the (language, words) and the count of each; ``hashes``
    are of languages and words, so a phrase has the same one in every block."""

    def __init__(self, rows: pa.RecordBatch, max_words: int):
        buf, off = text_buffer(rows.column("text"))
        buf = _LOWER[buf]
        s, e, doc = spans(buf, off, _WORD)
        ends = np.concatenate(([0], np.cumsum(_PIECE_END[buf])))
        joined = (doc[1:] == doc[:-1]) & (ends[s[1:]] == ends[s[:-1]]) if len(s) else np.zeros(0, bool)
        bounds = np.concatenate(([0], np.cumsum(e - s))).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(bounds), pa.py_buffer(buf[_WORD[buf]])]).dictionary_encode()
        self.words, w = coded.dictionary, coded.indices.to_numpy()
        langs = rows.column("lang").dictionary_encode()
        self.langs, lang = langs.dictionary, langs.indices.to_numpy()[doc]
        del buf, s, e, doc, ends, bounds, coded
        size = max(1, len(self.words))
        word_hash = np.array([xxhash.xxh3_64_intdigest(x) for x in self.words.to_pylist()], np.uint64)
        lang_hash = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in self.langs.to_pylist()], np.uint64)
        self.lang_words = np.bincount(lang, minlength=len(self.langs))
        at, before, before_hash = np.arange(len(w)), lang, lang_hash
        self.lang, self.codes, self.counts, self.hashes = [], [], [], []
        for k in range(max_words):
            if k:
                at = at[at + k < len(w)]
                at = at[joined[at + k - 1]]
            key = before[at].astype(np.int64) * size + w[at + k]
            key, first, before_at, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            prefix, last = key // size, key % size
            before_hash = mix(before_hash[prefix] * np.uint64(MULT) + word_hash[last]) if len(key) else np.zeros(0, np.uint64)
            self.lang.append(lang[at[first]])
            self.codes.append([w[at[first] + j] for j in range(k + 1)])
            self.counts.append(n)
            self.hashes.append(before_hash)
            before = np.zeros(len(w), np.int32)
            before[at] = before_at  # the positions that go on are among these

    def all_hashes(self) -> np.ndarray:
        return np.concatenate(self.hashes)

    def rows(self, keep: np.ndarray) -> Iterator[pa.RecordBatch]:
        """(lang, words, phrase, n) of the phrases kept, and each language's number of words as words = 0."""
        n = len(self.langs)
        yield self._batch(pa.array(np.arange(n)), 0, pa.array([""] * n, pa.string()), self.lang_words)
        for k, (lang, codes, counts) in enumerate(zip(self.lang, self.codes, self.counts)):
            mine, keep = np.flatnonzero(keep[: len(counts)]), keep[len(counts) :]
            parts = [self.words.take(pa.array(c[mine])) for c in codes]
            phrase = parts[0] if k == 0 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
            yield self._batch(pa.array(lang[mine]), k + 1, phrase.cast(pa.large_string()).cast(pa.string()), counts[mine])

    def _batch(self, lang: pa.Array, k: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([self.langs.take(lang), pa.array(np.full(len(n), k, np.int32)), phrase, pa.array(n.astype(np.int64))],
                                          ["lang", "words", "phrase", "n"])


def _segments(docs: DataFrame, limit: int) -> DataFrame:
    """(lang, text) with texts of over ``limit`` bytes cut at piece separators."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            size = pc.binary_length(rb.column("text")).to_numpy(zero_copy_only=False)
            long = np.flatnonzero(size > limit)
            yield rb.filter(pa.array(~(size > limit)))
            for i in long:
                lang, raw = rb.column("lang")[int(i)].as_py(), rb.column("text")[int(i)].as_py().encode("utf-8")
                cuts = np.flatnonzero(_PIECE_END[np.frombuffer(raw, np.uint8)])
                a = 0
                while a < len(raw):
                    k = int(np.searchsorted(cuts, a + limit, side="right")) - 1
                    if k < 0 or cuts[k] < a:
                        k += 1  # no separator within the limit: the next one
                    b = int(cuts[k]) + 1 if k < len(cuts) and a + limit < len(raw) else len(raw)
                    yield pa.RecordBatch.from_pylist([{"lang": lang, "text": raw[a:b].decode("utf-8")}], schema=rb.schema)
                    a = b

    return docs.mapInArrow(run, "lang string, text string")


def phrase_counts(docs: DataFrame, min_count: int, max_words: int, text_col: str = "text", lang_col: str = "lang",
                  block_bytes: int = BLOCK_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(lang, words, phrase, n): exact counts of all phrases of up to ``max_words`` words that occur ``min_count``
    times in their language; words = 0 has the language's number of words."""
    d = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].cast("string").alias("text"))
    d = d.where("text is not null")
    # words of about eight bytes; only the number of partitions comes from it, their capacities from what they get
    shards = number_of_shards((d.agg(F.sum(F.octet_length("text"))).first()[0] or 0) * max_words // 8, shard_keys)
    blocks = write_blocks(_segments(d, block_bytes), block_bytes=block_bytes)
    byte = np.uint8 if min_count < 256 else np.uint32

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, payload in zip(b.column("block").to_pylist(), b.column("payload")):
                phrases = PhraseCounts(unpack_table(payload.as_py()), max_words)
                h = phrases.all_hashes()
                order, present, cut, ends = dealt(h, shards)
                v = (mix(h) & np.uint64(0xFFFFFFFF)).astype(np.uint32)[order]
                n = np.minimum(np.concatenate(phrases.counts), min_count).astype(byte)[order]
                if len(present):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(present), pa.array(np.full(len(present), block, np.int64)),
                         pa.array([v[x:y].tobytes() for x, y in zip(cut, ends)], pa.binary()),
                         pa.array([n[x:y].tobytes() for x, y in zip(cut, ends)], pa.binary())], ["shard", "block", "v", "n"])
                del phrases, h, order, v, n
                pa.default_memory_pool().release_unused()

    def answer(g: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, np.uint32) for x in g["v"].to_pylist()]
        counts = [np.frombuffer(x, byte) for x in g["n"].to_pylist()]
        summary = MisraGries(sum(int(n.sum(dtype=np.int64)) for n in counts) // min_count + 1)
        a, held = 0, 0
        for b, k in enumerate(keys, 1):  # a batch of summaries about as large as the capacity at a time
            held += len(k)
            if held > summary.capacity or b == len(keys):
                summary.merge(np.concatenate(keys[a:b]), np.concatenate(counts[a:b]))
                a, held = b, 0
        left = summary.survivors(min_count)
        bits = []
        for k in keys:
            at = np.minimum(np.searchsorted(left, k), max(len(left) - 1, 0))
            bits.append(np.packbits(left[at] == k if len(left) else np.zeros(len(k), bool)).tobytes())
        return pa.table({"block": g["block"], "shard": g["shard"], "totals": pa.array(bits, pa.binary())})

    asked = blocks.mapInArrow(ask, "shard long, block long, v binary, n binary")
    bits = by_block(asked.groupBy("shard").applyInArrow(answer, "block long, shard long, totals binary"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for payload, answers in zip(b.column("payload"), b.column("answers")):
                phrases = PhraseCounts(unpack_table(payload.as_py()), max_words)
                h = phrases.all_hashes()
                keep = np.zeros(len(h), bool)
                if len(h):
                    order, _, cut, ends = dealt(h, shards)
                    got = [np.unpackbits(np.frombuffer(x["totals"], np.uint8))[:n] for x, n in zip(answers.as_py(), ends - cut)]
                    keep[order] = np.concatenate(got).astype(bool)
                yield from phrases.rows(keep)
                del phrases, h
                pa.default_memory_pool().release_unused()

    exact = blocks.join(bits, "block", "left").select("payload", "answers").mapInArrow(count, "lang string, words int, phrase string, n long")
    return exact.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where(f"words = 0 or n >= {min_count}")


def cut_score(a: str, l: str, r: str) -> Column:
    """floor(10^6 a a / (l r)) of whole numbers."""
    wide = "cast({} as decimal(16,0))".format
    return F.expr(f"(cast({wide(a)} * {wide(a)} as decimal(31,0)) * cast(1000000 as decimal(7,0))) div cast({wide(l)} * {wide(r)} as decimal(38,0))")


def collocations(counts: DataFrame, min_count: int, absorb: int, top: int) -> DataFrame:
    """The ranked phrases of written ``counts``."""
    found = counts.where("words >= 2")
    parts = counts.where("words >= 1").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    word = F.split("phrase", " ", -1)
    cuts = found.select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"), word.alias("w"))
    left, right = F.array_join(F.slice("w", F.lit(1), F.col("cut")), " "), F.array_join(F.slice("w", F.col("cut") + 1, F.col("words") - F.col("cut")), " ")
    sides = cuts.select("lang", "phrase", "words", "a", "cut", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), left.alias("part")), F.struct(F.lit(1).alias("side"), right.alias("part")))).alias("x"))
    sides = sides.select("lang", "phrase", "words", "a", "cut", "x.side", "x.part").join(parts, ["lang", "part"])
    scored = sides.groupBy("lang", "phrase", "words", "a", "cut").agg(
        F.max(F.expr("case when side = 0 then f end")).alias("l"), F.max(F.expr("case when side = 1 then f end")).alias("r"))
    scored = scored.withColumn("score", cut_score("a", "l", "r"))
    worst = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s"))
    longer = found.where("words > 2").select("lang", "words", "n", word.alias("w"))
    size = F.explode(F.sequence(F.lit(2), F.col("words") - 1))
    longer = longer.select("lang", "words", "n", "w", size.alias("k"))
    longer = longer.select("lang", "n", "w", "k", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("k") + 1)).alias("i"))
    inside = longer.select("lang", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("phrase"), "n")
    inside = inside.groupBy("lang", "phrase").agg(F.max("n").alias("m"))
    kept = worst.join(inside, ["lang", "phrase"], "left").where(f"m is null or 100 * m < {absorb} * a")
    kept = kept.select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = kept.withColumn("salt", F.pmod(F.hash("phrase"), F.lit(TOP_SALTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(f"rank <= {top}")
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(f"rank <= {top}")
    n = counts.where("words = 0").select("lang", "n")
    return some.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine_collocations(docs: DataFrame, min_count: int = 10, max_words: int = 3, absorb: int = 50, top: int = 2000,
                      text_col: str = "text", lang_col: str = "lang", block_bytes: int = BLOCK_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words of each language, by the score of their weakest cut; a phrase
    is left out where a longer frequent one that holds it has ``absorb`` percent of its occurrences."""
    counts = materialize(phrase_counts(docs, min_count, max_words, text_col, lang_col, block_bytes, shard_keys), "phrases")
    return collocations(counts, min_count, absorb, top)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents WHERE text IS NOT NULL),
p AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?
-
]')) AS piece FROM d)),
g AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM p
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM p
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM p),
f AS (SELECT lang, words, phrase, count(*) AS n FROM g GROUP BY ALL),
tot AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE words >= 2 AND n >= 10),
cuts AS (SELECT *, unnest(range(1, words)) AS cut FROM c),
sides AS (
  SELECT cuts.*, x.n AS l, y.n AS r
  FROM cuts
  JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.w[1:cut], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.w[cut + 1:], ' ')),
scored AS (SELECT *, (1000000 * a::HUGEINT * a::HUGEINT) // (l::HUGEINT * r::HUGEINT) AS score FROM sides),
worst AS (
  SELECT lang, words, phrase, a, l, r, score
  FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS m FROM (
    SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM c WHERE words = 3
    UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM c WHERE words = 3) GROUP BY ALL),
kept AS (
  SELECT worst.* FROM worst LEFT JOIN inside USING (lang, phrase)
  WHERE m IS NULL OR 100 * m < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, tot.n AS n, score::BIGINT AS score
FROM ranked JOIN tot USING (lang) WHERE rank <= 2000
"""
