"""Host-level quality rules: rule failures aggregated by host, rates shrunk with an empirical beta prior.

Per document (one Arrow pass, whole texts): the counts below and two rules,

* ``base_failed``: fewer than ``min_words`` words, or more than half of the words repeat in 3-word windows;
* ``rule_failed``: ``base_failed``, or symbols outnumber a fifth of the words, or more than half of the
  lines with a word are repeats.

Per host: documents n and failures f (partial sums before the shuffle, so a host with a third of all rows is
a few rows). A beta prior is fitted to the host rates by moments; the shrunk rate of a host is
(f + a) / (n + a + b). A host is rejected if its shrunk rate is over ``host_limit``; a small host with a bad
run of documents is pulled towards the corpus and stays. The verdicts are joined back on the host.

Edge cases: null text has no words (and fails the base rules); a null host is a host of its own; equal rows
count as often as they occur; no documents give no rows; with one host, or equal rates in all, the prior is
``STRONG_PRIOR`` documents at the corpus rate; the input's other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.llm.textops import SPACE_WORD, lut, per_doc, prefix_hash, span_hash, spans, text_steps, window_hash
from tempest.session import materialize

MIN_WORDS = 50
HOST_LIMIT = 0.5
STRONG_PRIOR = 1000.0
#: Fixed value: the signs that count as symbols.
SYMBOLS = "#*$%&|<>"
_NOT_NEWLINE = ~lut((10, 10))


def _repeats(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items (document, hash) in text order: (is it found twice or more, has it an equal earlier one)."""
    order = np.lexsort((h, doc))  # stable: equal items stay in text order
    d, k = doc[order], h[order]
    same = np.zeros(len(d), bool)
    same[1:] = (d[1:] == d[:-1]) & (k[1:] == k[:-1])
    twice = same.copy()
    twice[:-1] |= same[1:]
    a, b = np.zeros(len(d), bool), np.zeros(len(d), bool)
    a[order], b[order] = twice, same
    return a, b


def rule_counts(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words per document of a slice."""
    n = len(off) - 1
    s, e, doc = spans(buf, off, SPACE_WORD)
    inside = SPACE_WORD[buf]
    points = np.concatenate(([0], np.cumsum(inside & ((buf & 0xC0) != 0x80))))
    symbols = np.concatenate(([0], np.cumsum(lut(*[(ord(c), ord(c)) for c in SYMBOLS])[buf])))
    words = np.concatenate(([0], np.cumsum(inside)))
    c = prefix_hash(buf, fold=False)
    ls, le, ld = spans(buf, off, _NOT_NEWLINE)
    full = words[le] > words[ls]  # lines with a word
    ls, le, ld = ls[full], le[full], ld[full]
    line = span_hash(c, ls, le, buf, fold=False) + (le - ls).astype(np.uint64)
    _, dup = _repeats(ld, line)
    at, h = window_hash(span_hash(c, s, e, buf, fold=False), doc, 3)
    twice, _ = _repeats(doc[at], h)
    hit = np.zeros(len(s), bool)
    for j in range(3):
        hit[at[twice] + j] = True
    return {
        "n_words": per_doc(doc, n),
        "word_chars": points[off[1:]] - points[off[:-1]],
        "n_symbols": symbols[off[1:]] - symbols[off[:-1]],
        "n_lines": per_doc(ld, n),
        "n_dup_lines": per_doc(ld[dup], n),
        "n_repeat_words": per_doc(doc[hit], n),
    }


COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def document_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | str = "source",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, host, the counts, ``base_failed`` and ``rule_failed`` of every document."""
    h = F.col(host) if isinstance(host, str) else host
    d = docs.select(docs[id_col].alias("doc_id"), h.cast("string").alias("host"),
                    docs[text_col].cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, buf, off in text_steps(batches, "text"):
            x = rule_counts(buf, off)
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), rb.column("host"), *[pa.array(x[c].astype(np.int64)) for c in COUNTS]],
                                             ["doc_id", "host", *COUNTS])

    out = d.mapInArrow(run, f"doc_id {kind}, host string, " + ", ".join(f"{c} long" for c in COUNTS))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", base).withColumn(
        "rule_failed", base | (5 * F.col("n_symbols") > F.col("n_words")) | (2 * F.col("n_dup_lines") > F.col("n_lines")))


def host_verdicts(rules: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """host, n, f, shrunk ``rate`` and ``host_kept``. The prior is two numbers."""
    hosts = rules.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("rule_failed").cast("long")).alias("f"))
    # moments of the rates over hosts, each weighted by its documents; the binomial part of the variance goes
    r = F.col("f") / F.col("n")
    m = hosts.agg(F.sum("n").alias("N"), F.sum("f").alias("f_all"), F.count(F.lit(1)).alias("hosts"),
                  F.sum(F.col("n") * r * r).alias("rr"))
    p = F.col("f_all") / F.col("N")
    raw = F.col("rr") / F.col("N") - p * p
    between = raw - p * (1 - p) * F.col("hosts") / F.col("N")
    weight = F.when((between > 0) & (p > 0) & (p < 1), F.greatest(p * (1 - p) / between - 1, F.lit(1.0)))
    prior = m.select(p.alias("p"), F.least(F.coalesce(weight, F.lit(STRONG_PRIOR)), F.lit(STRONG_PRIOR)).alias("w")).first()  # one row
    rate = (F.col("f") + F.lit(prior.p) * F.lit(prior.w)) / (F.col("n") + F.lit(prior.w))
    return hosts.select("host", "n", "f", rate.alias("rate"), (rate <= host_limit).alias("host_kept"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | str = "source",
                  min_words: int = MIN_WORDS, host_limit: float = HOST_LIMIT) -> DataFrame:
    """Document rules with the verdict of their host: ``kept`` = not base_failed and the host is kept."""
    rules = materialize(document_rules(docs, id_col, text_col, host, min_words), "rules")  # texts are read once
    v = host_verdicts(rules, host_limit).select(F.col("host").alias("_host"), "rate", "host_kept")
    out = rules.join(v, rules["host"].eqNullSafe(v["_host"]), "left").drop("_host")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, host, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM (
        SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, unnest(list_transform(range(1, len(ws) - 1),
               lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS k FROM w WHERE len(ws) >= 3)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
          SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE c >= 2) GROUP BY doc_id),
c AS (SELECT w.doc_id, host, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
r AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
f AS (SELECT *, base_failed OR 5 * n_symbols > n_words OR 2 * n_dup_lines > n_lines AS rule_failed FROM r),
h AS (SELECT host, count(*) AS n, sum(CAST(rule_failed AS INT)) AS f FROM f GROUP BY host),
m AS (SELECT sum(n) AS n_all, sum(f) / sum(n) AS p, count(*) AS hosts, sum(n * (f / n) * (f / n)) / sum(n) AS rr FROM h),
b AS (SELECT p, rr - p * p - p * (1 - p) * hosts / n_all AS v FROM m),
q AS (SELECT p, least(1000.0, CASE WHEN v > 0 AND p > 0 AND p < 1 THEN greatest(p * (1 - p) / v - 1, 1.0) ELSE 1000.0 END) AS w FROM b),
v AS (SELECT host, (f + p * w) / (n + w) <= 0.5 AS host_kept FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
FROM f JOIN v ON f.host IS NOT DISTINCT FROM v.host
"""
