"""Quality classifier: interpolated modified Kneser-Ney over byte n-grams, trained on trusted text.

Texts are byte sequences after three start bytes (0); a gram is five bytes in one integer. The model is trained
on all trusted documents (label quality 1) with crc32(id) mod 5 != 0:

0. Blocks send the ids of their rows, which are joined with the trusted ids; each block gets the places of its trusted
   rows back (``_flags``). Only ids are shuffled, and neither side has to fit into a task or the driver.
1. Each block of documents sends the distinct grams of its trusted texts with counts; Spark sums them (sharded by gram).
2. Lower orders hold continuation counts (in how many longer grams a gram ends), by one aggregation each. Each
   order has its three discounts D1, D2, D3+ from its counts of counts, and per context the total and the
   numbers of grams with count 1, 2 and more, which give the back-off weight.
3. Probabilities are interpolated from order 1 (over 256 bytes) upwards by joins on the shorter gram; all of this
   is on distinct grams, sharded by key, never on positions.
4. Every block of *all* documents asks for its distinct grams. Distinct over all blocks they are joined with the
   counts (order 5, else the back-off chain), the answers return to the blocks without the grams (``answers``), and each
   block sums the log-probabilities over its texts. Blocks are of bounded size, in a written table bucketed by block
   (``blocks``), so that the texts are not shuffled.

A document's perplexity is exp(-(sum + SHRINK·mean) / (bytes + SHRINK)): short texts are pulled to the corpus
mean of trusted text, so that a few bytes decide nothing. The threshold of a language is the ``QUANTILE`` of the
perplexities of its *held-out* trusted documents (remainder 0) times ``MARGIN``; languages with fewer than
``MIN_HELD`` of them use all languages' together (times ``FEW_MARGIN`` if these are fewer as well). Documents over the threshold are rejected. A language with fewer
than ``MIN_FIT`` training documents is one that the model has not learnt: it has no threshold and keeps its documents.

Edge cases: null and empty texts have the mean perplexity and are kept; a null language is a language
of its own; a null id or null label is never trusted; without trusted text everything is kept with perplexity
null; repeated rows get equal results; an empty table gives an empty result; other columns are not read. Columns
named as in ``OWN`` are replaced by the operator's; ``without_low_quality`` returns a caller's columns whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StructField, StructType

from tempest.llm.answers import answer, ask, distinct_keys, in_order
from tempest.llm.blocks import bucketed_blocks, unpack_table
from tempest.llm.textops import text_steps
from tempest.session import materialize

ORDER = 5
#: Bytes of text in a block: the larger, the fewer distinct grams are asked for in all.
BLOCK = 16 << 20
#: Blocks to a shard of requests: 16 MB of ordinary text have up to a million distinct grams.
SHARD_BLOCKS = 4
#: Columns that the results have beside those of the documents.
OWN = ("_trusted", "_fit", "_lp", "_bytes", "_perplexity", "_threshold", "_kept")
#: The shard under which a block's flags come with its answers.
FLAGS = -1
SHRINK = 200.0
QUANTILE = 0.99
MARGIN = 1.1
#: The margin where all languages together have fewer than ``MIN_HELD`` held-out documents: the quantile of a few is
#: only their maximum, which unseen clean documents pass more often.
FEW_MARGIN = 1.3
MIN_HELD = 50
#: Training documents of a language from which on its perplexities say something about quality.
MIN_FIT = 30
_MASK = [(1 << 8 * k) - 1 for k in range(ORDER + 1)]


def grams(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The gram that ends at each byte, over document starts padded with zeros."""
    n = len(buf)
    at = np.arange(n) - np.repeat(off[:-1], np.diff(off))  # place in the document
    g = buf.astype(np.int64)
    for j in range(1, ORDER):
        prev = np.zeros(n, np.int64)
        prev[j:] = buf[:-j]
        prev[at < j] = 0
        g |= prev << (8 * j)
    return g


def _block_grams(rb: pa.RecordBatch, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of a block (of its ``rows`` only) with counts."""
    us, cs = [], []
    for part, buf, off in text_steps([rb if rows is None else rb.filter(pa.array(rows))], "text"):
        if len(buf):
            u, c = np.unique(grams(buf, off), return_counts=True)
            us.append(u)
            cs.append(c)
    if not us:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, back = np.unique(np.concatenate(us), return_inverse=True)
    return u, np.bincount(back, weights=np.concatenate(cs), minlength=len(u)).astype(np.int64)


def _flags(blocks: DataFrame, trusted: DataFrame, id_col: str, kind: DataType) -> DataFrame:
    """(block, shard = FLAGS, values), written: 2 · place (+ 1 for a training text) of each trusted row of a block, packed
    as int64. Blocks without trusted rows have none."""
    schema = StructType([StructField("block", LongType()), StructField("at", LongType()), StructField("id", kind)])

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, payload in zip(b.column("block").to_pylist(), b.column("payload")):
                rb = unpack_table(payload.as_py())
                n = rb.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block, np.int64)), pa.array(np.arange(n)), rb.column(id_col)], ["block", "at", "id"])

    def packed(t: pa.Table) -> pa.Table:
        return pa.table({"block": t["block"].slice(0, 1), "shard": pa.array([FLAGS], pa.int32()),
                         "values": pa.array([np.sort(t["v"].to_numpy()).tobytes()], pa.binary())})

    d = blocks.mapInArrow(ids, schema)
    d = d.join(trusted, d["id"] == trusted["_id"])
    fit = F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0
    d = d.select("block", (F.col("at") * 2 + fit.cast("long")).alias("v"))
    return materialize(d.groupBy("block").applyInArrow(packed, "block long, shard int, values binary"), "flags")


def _flagged(values: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(trusted, training) of a block's ``n`` rows."""
    v = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x, np.int64) for x in values]])
    trusted, fit = np.zeros(n, bool), np.zeros(n, bool)
    trusted[v >> 1] = True
    fit[v[v & 1 == 1] >> 1] = True
    return trusted, fit


def _fit_counts(blocks: DataFrame, flags: DataFrame) -> DataFrame:
    """(g, c): the grams of the trusted training texts of each block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        us, cs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for payload in left["payload"] if right.num_rows else []:  # one
            rb = unpack_table(payload.as_py())
            u, c = _block_grams(rb, _flagged(right["values"].to_pylist(), rb.num_rows)[1])
            us.append(u)
            cs.append(c)
        pa.default_memory_pool().release_unused()  # a worker lives on after the group
        return pa.table({"g": np.concatenate(us), "c": np.concatenate(cs)})

    grams_of = blocks.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(run, "g long, c long")
    return grams_of.groupBy("g").agg(F.sum("c").alias("c"))


def _discounts(types: DataFrame) -> list[float]:
    """D1, D2, D3+ from the counts of counts (four numbers)."""
    n = {r.c: r.n for r in types.where("c <= 4").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n2, n3, n4 = (float(n.get(i, 0)) for i in (1, 2, 3, 4))
    if not (n1 and n2):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)]


def _with_discount(types: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, ctx, kept = c - D(c)), (ctx, total, gamma) of one order."""
    d1, d2, d3 = _discounts(types)
    cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
    t = types.select("g", "c", F.shiftright("g", 8).alias("ctx"), cut.alias("cut"))
    ctx = t.groupBy("ctx").agg(F.sum("c").alias("total"), F.sum("cut").alias("cuts")).select(
        "ctx", "total", (F.col("cuts") / F.col("total")).alias("gamma"))
    return t.select("g", "ctx", (F.col("c") - F.col("cut")).alias("kept")), ctx


def train(counts: DataFrame) -> list[tuple[DataFrame, DataFrame | None]]:
    """counts (g, c > 0) of the highest order → per order, highest first: ((g, p), (ctx, gamma)). Grams of order k hold k bytes."""
    types = [materialize(counts, f"grams-{ORDER}")]
    for k in range(ORDER - 1, 0, -1):
        low = types[-1].groupBy(F.col("g").bitwiseAND(F.lit(_MASK[k]).cast("long")).alias("g")).agg(F.count(F.lit(1)).alias("c"))
        types.append(materialize(low, f"grams-{k}"))
    kept, ctx = _with_discount(types[-1])
    p = kept.join(ctx, "ctx").select("g", (F.col("kept") / F.col("total") + F.col("gamma") / 256).alias("p"))
    out: list[tuple[DataFrame, DataFrame]] = [(materialize(p, "p-1"), materialize(ctx, "gamma-1"))]
    for k in range(2, ORDER + 1):
        kept, ctx = _with_discount(types[ORDER - k])
        ctx = materialize(ctx, f"gamma-{k}")
        low = out[-1][0].select(F.col("g").alias("h"), F.col("p").alias("q"))
        p = (kept.join(ctx, "ctx").withColumn("h", F.col("g").bitwiseAND(F.lit(_MASK[k - 1]).cast("long"))).join(low, "h", "left")
             .select("g", (F.col("kept") / F.col("total") + F.col("gamma") * F.coalesce("q", F.lit(1 / 256))).alias("p")))
        out.append((materialize(p, f"p-{k}"), ctx))
    return out[::-1]


def gram_log_probs(distinct: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """distinct (g, others) and ``lp``: the back-off chain as one left join per order on sharded counts."""
    d, p, weight = distinct, None, F.lit(1.0)
    for i, (probs, ctx) in enumerate(model):
        k = ORDER - i
        key = F.col("g") if k == ORDER else F.col("g").bitwiseAND(F.lit(_MASK[k]).cast("long"))
        d = d.withColumn("_k", key).join(probs.select(F.col("g").alias("_k"), F.col("p").alias(f"p{k}")), "_k", "left")
        c = ctx.select(F.col("ctx").alias("_c"), F.col("gamma").alias(f"w{k}"))
        d = d.withColumn("_c", F.shiftright("_k", 8)).join(c, "_c", "left").drop("_k", "_c")
    p = F.lit(1 / 256) * F.coalesce(F.col("w1"), F.lit(1.0))
    for k in range(1, ORDER + 1):
        p = F.coalesce(F.col(f"p{k}"), F.coalesce(F.col(f"w{k}"), F.lit(1.0)) * p) if k > 1 else F.coalesce(F.col("p1"), p)
    return d.select(*distinct.columns, F.log(p).alias("lp"))


def perplexities(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", keep_text: bool = False) -> DataFrame:
    """All columns of ``docs`` (the text, in ``text``, on demand) and ``_lp`` (sum of log-probabilities), ``_bytes``,
    ``_trusted``, ``_fit``. trusted: (_id), distinct. The result is a written table."""
    docs = docs.drop(*OWN)
    names = [c for c in docs.columns if keep_text or c != "text"]
    flag = F.lit(True).alias("_trusted"), F.lit(True).alias("_fit")
    schema = docs.select(*[F.col(f"`{c}`") for c in names], *flag, F.lit(0.0).alias("_lp"), F.lit(0).cast("long").alias("_bytes")).schema

    with bucketed_blocks(docs, "text", BLOCK) as blocks:
        shards = max(4, blocks.count() // SHARD_BLOCKS)
        flags = _flags(blocks, trusted, id_col, docs.schema[id_col].dataType)
        model = train(_fit_counts(blocks, flags))
        asked = ask(blocks, lambda rb: _block_grams(rb)[0], shards)
        answers = answer(asked, gram_log_probs(distinct_keys(asked, "g"), model), "g", "lp").unionByName(flags)
        score = _scorer(names, shards)
        scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)
        return materialize(scored, "scored")


def _scorer(names: list[str], shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for payload in left["payload"]:  # one
            rb = unpack_table(payload.as_py())
            g = _block_grams(rb)[0]
            mine = pa.compute.equal(right["shard"], FLAGS)
            lp = in_order(g, right.filter(pa.compute.invert(mine)), shards)
            trusted, fit = _flagged(right.filter(mine)["values"].to_pylist(), rb.num_rows)
            lps, sizes = [], []
            for part, buf, off in text_steps([rb], "text"):
                x = np.concatenate(([0.0], np.cumsum(lp[np.searchsorted(g, grams(buf, off))]))) if len(buf) else np.zeros(1)
                lps.append(x[off[1:]] - x[off[:-1]])
                sizes.append(np.diff(off))
            t = pa.Table.from_batches([rb]).select(names).append_column("_trusted", pa.array(trusted)).append_column("_fit", pa.array(fit))
            t = t.append_column("_lp", pa.array(np.concatenate(lps)))
            out.append(t.append_column("_bytes", pa.array(np.concatenate(sizes).astype(np.int64))))
        pa.default_memory_pool().release_unused()  # a worker lives on after the group
        return pa.concat_tables(out)

    return score


def verdicts(scored: DataFrame, lang_col: str = "lang", quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """``scored`` and ``_perplexity``, ``_threshold``, ``_kept``."""
    held = scored.where("_trusted and not _fit")
    mean = scored.where("_fit").agg((F.sum("_lp") / F.sum("_bytes")).alias("m")).first().m
    if mean is None:
        none = F.lit(None).cast("double")
        return scored.withColumns({"_perplexity": none, "_threshold": none, "_kept": F.lit(True)})
    ppl = F.exp(-(F.col("_lp") + SHRINK * mean) / (F.col("_bytes") + SHRINK))
    c = held.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(ppl, quantile, 10_000).alias("q")).first()
    common = None if c.q is None else c.q * (margin if c.n >= MIN_HELD else max(margin, FEW_MARGIN))
    by = scored.where("_trusted").groupBy(F.col(lang_col).alias("_lang")).agg(
        F.sum(F.col("_fit").cast("int")).alias("fit"), F.count(F.when(~F.col("_fit"), 1)).alias("n"),
        F.percentile_approx(F.when(~F.col("_fit"), ppl), quantile, 10_000).alias("q"))
    key = next(k for k in map("_lang{}".format, range(len(scored.columns) + 1)) if k not in scored.columns)
    by = by.where(F.col("fit") >= MIN_FIT).select(
        F.col("_lang").alias(key), F.when(F.col("n") >= MIN_HELD, F.col("q") * margin).otherwise(F.lit(common).cast("double")).alias("_threshold"))
    out = scored.withColumn("_perplexity", ppl).join(F.broadcast(by), F.col(lang_col).eqNullSafe(F.col(key)), "left")  # a row per language with MIN_FIT
    return out.withColumn("_kept", F.coalesce(F.col("_perplexity") <= F.col("_threshold"), F.lit(True))).drop(key)


def without_low_quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept; its columns may have any names."""
    ours = {id_col: "doc_id", lang_col: "lang", text_col: "text"}
    plain = docs.toDF(*[ours.get(c, f"c{i}") for i, c in enumerate(docs.columns)])
    scored = perplexities(plain, trusted, keep_text=True)
    return verdicts(scored).where("_kept").select(*plain.columns).toDF(*docs.columns)


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Ids of all trusted documents: label 1."""
    return labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    scored = perplexities(docs, trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    v = verdicts(scored.drop("text"))
    return v.select("doc_id", F.col("_bytes").alias("n_bytes"), F.col("_lp").alias("log_prob"), F.col("_perplexity").alias("perplexity"),
                    F.col("_threshold").alias("threshold"), F.col("_trusted").alias("trusted"), F.col("_kept").alias("kept"))
