"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A text is its lower-cased alphanumeric words. A word's 64-bit hash picks one of ``2^HASH_BITS`` buckets; a
bucket has an embedding if its words were in at least ``MIN_DF`` training texts, else the zero vector.
Filters of widths 1, 2 and 3 run over the embeddings, each takes its maximum over the whole text (so one insult
in 20,000 words counts), and a logistic layer gives the score. Embeddings start at the smoothed log-odds of
their bucket (first component) and small random values; everything is then trained by Adagrad.

Labelled rows: training takes at most ``MAX_TRAIN`` of them (the smallest ids by hash; a documented bound that
keeps the training arrays under 100 MB), never those with crc32(id) mod 5 = 0. Of these, remainder 1 is kept back
to calibrate: a logistic map of the raw score, and one threshold a language (best F1; languages with few
labelled toxic texts use 0.5). Labels, language, source and id are never inputs of a score.

Scoring is one Arrow pass over whole texts with the model broadcast (4 MB of bucket rows and at most
``MAX_ROWS`` vectors: a fixed bound).

Edge cases: null and empty texts are scored as the zero text (the same score for all); a null id is never held
out nor learned; null labels are skipped; without labels of both classes every score is 0; repeated rows get
equal scores; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.llm.textops import ALNUM_WORD, prefix_hash, span_hash, spans, text_steps

HASH_BITS = 20
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 4
PAD = 3
MAX_TRAIN = 12_000
MAX_ROWS = 400_000
MIN_DF = 3
EPOCHS = 8
BATCH = 64


def remainder(id_col: Column, n: int = 5) -> Column:
    """crc32 of the id as text, mod n."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def buckets(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each word, offsets of the documents' words)."""
    s, e, doc = spans(buf, off, ALNUM_WORD)
    h = span_hash(prefix_hash(buf), s, e, buf)
    at = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(off) - 1)))).astype(np.int64)
    return (h >> np.uint64(64 - HASH_BITS)).astype(np.int32), at


def padded(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document followed by ``PAD`` zero rows: (rows, start of each, words + 1 of each)."""
    n = np.diff(at)
    start = at[:-1] + PAD * np.arange(len(n))
    out = np.zeros(len(rows) + PAD * len(n), rows.dtype)
    if len(rows):
        out[np.arange(len(rows)) + PAD * np.repeat(np.arange(len(n)), n)] = rows
    return out, start, n + 1


@dataclass
class ToxicityModel:
    row_of: np.ndarray  # bucket → row of vectors, 0: none
    vec: np.ndarray
    conv: list = field(default_factory=list)  # per width (w, DIM, FILTERS)
    bias: list = field(default_factory=list)
    out: np.ndarray | None = None
    out_bias: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict = field(default_factory=dict)
    blank: bool = False  # nothing to learn from

    def maps(self, rows: np.ndarray) -> list[np.ndarray]:
        """Filter responses at every place of padded rows, per width."""
        v = self.vec[rows]
        maps = []
        for w, c, b in zip(WIDTHS, self.conv, self.bias):
            z = v @ c[0]
            for j in range(1, w):
                z[:-j] += v[j:] @ c[j]
            maps.append(z + b)
        return maps

    def raw(self, bucket: np.ndarray, at: np.ndarray) -> np.ndarray:
        rows, start, size = padded(self.row_of[bucket], at)
        if not len(start):
            return np.zeros(0)
        ends = np.minimum(start + size, len(rows) - 1)
        cut = np.stack([start, ends], 1).ravel()
        top = [np.maximum.reduceat(z, cut, axis=0)[::2] for z in self.maps(rows)]
        return (np.maximum(np.concatenate(top, 1), 0) @ self.out).astype(np.float64) + self.out_bias

    def score(self, bucket: np.ndarray, at: np.ndarray) -> np.ndarray:
        if self.blank:
            return np.zeros(len(at) - 1)
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.raw(bucket, at) + b, -30, 30)))

    def threshold(self, lang: str | None) -> float:
        return self.thresholds.get(lang, 0.5)


def _fit(bucket: list[np.ndarray], y: np.ndarray, seed: int = 7) -> ToxicityModel:
    rng = np.random.default_rng(seed)
    uniq = [np.unique(b) for b in bucket]
    df = np.bincount(np.concatenate(uniq), minlength=1 << HASH_BITS)
    df1 = np.bincount(np.concatenate([u for u, t in zip(uniq, y) if t]), minlength=1 << HASH_BITS)
    known = np.flatnonzero(df >= MIN_DF)
    if len(known) > MAX_ROWS:
        known = np.sort(known[np.argsort(-df[known], kind="stable")[:MAX_ROWS]])
    n1, n0 = y.sum(), len(y) - y.sum()
    odds = np.log((df1[known] + 0.5) / (n1 + 1)) - np.log((df[known] - df1[known] + 0.5) / (n0 + 1))
    row_of = np.zeros(1 << HASH_BITS, np.int32)
    row_of[known] = np.arange(1, len(known) + 1)
    vec = rng.normal(0, 0.05, (len(known) + 1, DIM)).astype(np.float32)
    vec[1:, 0] = np.clip(odds, -4, 4)
    vec[0] = 0
    m = ToxicityModel(row_of, vec)
    for w in WIDTHS:
        c = rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32)
        c[:, 0, :] += 1.0 / w
        m.conv.append(c)
        m.bias.append(np.full(FILTERS, -1.0, np.float32))
    m.out = rng.uniform(0.1, 0.4, len(WIDTHS) * FILTERS).astype(np.float32)
    m.out_bias = -2.0
    rows = [row_of[b] for b in bucket]
    params = [m.vec, *m.conv, *m.bias, m.out]
    seen = [np.full(p.shape, 1e-6, np.float32) for p in params]
    seen_b = 1e-6
    weight = np.where(y == 1, min(4.0, max(1.0, n0 / max(n1, 1))), 1.0)
    for epoch in range(EPOCHS):
        lr = 0.05 / (1 + 0.3 * epoch)
        order = rng.permutation(len(y))
        for a in range(0, len(y), BATCH):
            ix = order[a : a + BATCH]
            at = np.concatenate(([0], np.cumsum([len(rows[i]) for i in ix])))
            r, start, size = padded(np.concatenate([rows[i] for i in ix]), at)
            maps = m.maps(r)
            pos = [np.stack([s + z[s : s + n].argmax(0) for s, n in zip(start, size)]) for z in maps]
            top = np.concatenate([np.take_along_axis(z, p, 0) for z, p in zip(maps, pos)], 1)
            act = np.maximum(top, 0)
            p = 1 / (1 + np.exp(-np.clip(act @ m.out + m.out_bias, -30, 30)))
            g = ((p - y[ix]) * weight[ix] / len(ix)).astype(np.float32)
            d_act = g[:, None] * m.out * (top > 0)
            grads = [None, *[np.zeros_like(c) for c in m.conv], *[None] * len(WIDTHS), act.T @ g]
            touched, change = [], []
            for k, w in enumerate(WIDTHS):
                dz = d_act[:, k * FILTERS : (k + 1) * FILTERS]
                for j in range(w):
                    rj = r[np.minimum(pos[k] + j, len(r) - 1)]
                    grads[1 + k][j] = np.einsum("bfd,bf->df", m.vec[rj], dz)
                    touched.append(rj.ravel())
                    change.append((dz[:, :, None] * m.conv[k][j].T[None]).reshape(-1, DIM))
                grads[1 + len(WIDTHS) + k] = dz.sum(0)
            t, back = np.unique(np.concatenate(touched), return_inverse=True)
            gv = np.zeros((len(t), DIM), np.float32)
            np.add.at(gv, back, np.concatenate(change))
            seen[0][t] += gv * gv
            m.vec[t] -= lr * gv / np.sqrt(seen[0][t])
            m.vec[0] = 0
            for q in range(1, len(params)):
                seen[q] += grads[q] ** 2
                params[q] -= lr * grads[q] / np.sqrt(seen[q])
            gb = float(g.sum())
            seen_b += gb * gb
            m.out_bias -= lr * gb / seen_b**0.5
    return m


def _calibrate(m: ToxicityModel, bucket: list[np.ndarray], y: np.ndarray, lang: list) -> None:
    """A logistic map of the raw score, then a threshold a language, on texts that were not trained on."""
    at = np.concatenate(([0], np.cumsum([len(b) for b in bucket])))
    z = m.raw(np.concatenate(bucket), at)
    a, b = 1.0, 0.0
    for _ in range(300):  # plain Newton steps with a small ridge around (1, 0)
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g = np.array([((p - y) * z).sum() + 0.1 * (a - 1), (p - y).sum() + 0.1 * b])
        s = p * (1 - p) + 1e-6
        hess = np.array([[(s * z * z).sum() + 0.1, (s * z).sum()], [(s * z).sum(), s.sum() + 0.1]])
        step = np.linalg.solve(hess, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    m.scale = (float(max(a, 0.05)), float(b))
    p = 1 / (1 + np.exp(-np.clip(m.scale[0] * z + m.scale[1], -30, 30)))
    for one in sorted({x for x in lang if x is not None}):
        mine = np.array([x == one for x in lang])
        if y[mine].sum() < 20:
            continue
        cuts = np.linspace(0.05, 0.95, 91)
        f1 = []
        for c in cuts:
            hit = p[mine] >= c
            tp = (hit & (y[mine] == 1)).sum()
            f1.append(2 * tp / max(1, hit.sum() + y[mine].sum()))
        best = np.flatnonzero(np.array(f1) >= max(f1) - 1e-12)
        m.thresholds[one] = float(cuts[best[np.argmin(np.abs(cuts[best] - 0.5))]])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          label_col: str = "toxic", max_train: int = MAX_TRAIN) -> ToxicityModel:
    """Fit on the labelled documents with crc32(id) mod 5 != 0, at most ``max_train`` of them."""
    ids = (labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("y"))
           .where(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("_id")) != 0)))
    ids = ids.orderBy(F.xxhash64("_id"), "_id").limit(max_train).groupBy("_id").agg(F.max("y").alias("y"))
    d = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("text"),
                    docs[lang_col].cast("string").alias("lang"))
    d = d.join(F.broadcast(ids), "_id").withColumn("fold", remainder(F.col("_id")).cast("int"))  # ids: max_train rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, buf, off in text_steps(batches, "text"):
            b, at = buckets(buf, off)
            yield pa.RecordBatch.from_arrays(
                [rb.column("_id").cast(pa.string()), rb.column("y"), rb.column("fold"), rb.column("lang"),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(b))], ["id", "y", "fold", "lang", "b"])

    t = (d.select("_id", "y", "fold", "lang", "text")
         .mapInArrow(run, "id string, y int, fold int, lang string, b array<int>").toArrow().sort_by("id"))
    y = t["y"].to_numpy().astype(np.int64)
    fold = t["fold"].to_numpy()
    lang = t["lang"].to_pylist()
    col = t["b"].combine_chunks()
    flat, at = col.flatten().to_numpy(), col.offsets.to_numpy() - (col.offsets[0].as_py() if len(col.offsets) else 0)
    words = [flat[at[i] : at[i + 1]] for i in range(len(y))]
    fit = np.flatnonzero(fold != 1)
    cal = np.flatnonzero(fold == 1)
    if len(fit) == 0 or len(set(y[fit])) < 2:
        return ToxicityModel(np.zeros(1, np.int32), np.zeros((1, DIM), np.float32), blank=True)
    m = _fit([words[i] for i in fit], y[fit])
    if len(cal) and len(set(y[cal])) == 2:
        _calibrate(m, [words[i] for i in cal], y[cal], [lang[i] for i in cal])
    return m


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.5), toxic (score >= the threshold of the language)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # numpy arrays: needs no import to unpickle
    d = docs.select(docs[id_col].alias("doc_id"), docs[lang_col].cast("string").alias("lang"),
                    docs[text_col].cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ToxicityModel(**shared.value)
        for rb, buf, off in text_steps(batches, "text"):
            p = m.score(*buckets(buf, off))
            limit = np.array([m.threshold(x) for x in rb.column("lang").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [rb.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(p >= limit)],
                ["doc_id", "score", "predicted", "toxic"])

    out = d.mapInArrow(run, f"doc_id {kind}, score double, predicted int, toxic boolean")
    held = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted", "toxic")


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` (all columns as they are) whose score is under the threshold of their language."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # numpy arrays: needs no import to unpickle
    text_at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ToxicityModel(**shared.value)
        for rb, buf, off in text_steps(batches, text_at):
            p = m.score(*buckets(buf, off))
            limit = np.array([m.threshold(x) for x in rb.column(lang_at).to_pylist()])
            yield rb.filter(pa.array(p < limit))

    return docs.mapInArrow(run, docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
