"""Token counts of whole texts; huge documents by overlap resynchronisation.

Ordinary documents go through the piece cache (``pieces.PieceEncoder``). A document of more than
``chunk`` characters is encoded in overlapping chunks with offsets and spliced at proven stable common
boundaries (``pieces.encode_long``); overlaps widen where alignment fails. Nothing is truncated.

Edge cases: null text counts as empty (0 bytes, 0 tokens); a null id stays null; equal rows give equal
rows; an empty table gives an empty result; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tempest.llm.pieces import PieceEncoder, encode_long, load_tokenizer
from tempest.llm.textops import text_steps

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
LIMIT = 2048


def huge_documents(buf: np.ndarray, off: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray, dict[int, str]]:
    """Take the documents of over ``chunk`` characters out of a slice: (bytes, offsets, {index: text})."""
    size = np.diff(off)
    huge = {}
    for i in np.flatnonzero(size > chunk):
        text = buf[off[i] : off[i + 1]].tobytes().decode("utf-8")
        if len(text) > chunk:
            huge[int(i)] = text
    if huge:
        keep = np.ones(len(buf), bool)
        for i in huge:
            keep[off[i] : off[i + 1]] = False
            size[i] = 0
        buf, off = buf[keep], np.concatenate(([0], np.cumsum(size)))
    return buf, off, huge


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (n_tokens > limit)."""
    d = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = PieceEncoder.on_worker(tokenizer_path)
        tok = load_tokenizer(tokenizer_path)
        for rb, buf, off in text_steps(batches, "text"):
            n_bytes = np.diff(off)
            small, at, huge = huge_documents(buf, off, chunk)
            n = enc.counts(small, at)
            for i, text in huge.items():
                n[i] = sum(len(x) for x in encode_long(tok, text, chunk, overlap))
            yield pa.RecordBatch.from_arrays(
                [rb.column("doc_id"), pa.array(n_bytes), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return d.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
