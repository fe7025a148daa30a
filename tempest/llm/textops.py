"""Vectorised scanning of Arrow text batches: word boundaries and 64-bit span hashes in numpy.

A batch is looked at as one byte buffer plus document offsets. All separators used here are ASCII, and
no byte of a multi-byte UTF-8 character is ASCII, so working on bytes is exact for every text.
The hash of a span of up to ``SHORT`` bytes is polynomial (mod 2^64, odd multiplier, random byte values), so it comes from
one running sum. Modulo a power of two such sums cancel for long regular strings (two Thue-Morse strings of 1,024 bytes
have equal ones), so longer spans are hashed from their bytes by xxh3.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

MULT = 0x9E3779B97F4A7C13
MULT_INV = pow(MULT, -1, 1 << 64)
#: Bytes of text that one numpy step looks at; a longer single document is one step of its own.
STEP_BYTES = 1 << 20
#: Spans up to this many bytes have polynomial hashes.
SHORT = 32


def worker_state() -> dict:
    """A dict that lives as long as the Python process (function globals do not: they are unpickled
    anew for each task). Used for caches only; losing it costs time, never results."""
    m = sys.modules.get("_tempest_llm_worker")
    if m is None:
        m = sys.modules["_tempest_llm_worker"] = types.ModuleType("_tempest_llm_worker")
    return m.__dict__


def byte_values(fold: bool) -> np.ndarray:
    """64 random bits for each byte; with ``fold``, A-Z have the values of a-z."""
    v = np.random.default_rng(20240607).integers(0, 1 << 64, 256, dtype=np.uint64)
    if fold:
        v[65:91] = v[97:123]
    return v


def lut(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry truth table, True inside the given inclusive byte ranges."""
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


#: ``[^\x20\x09-\x0D]+``
SPACE_WORD = ~lut((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
ALNUM_WORD = lut((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    st = worker_state()
    have = st.get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, STEP_BYTES + 1)
        out = []
        for m in (MULT, MULT_INV):
            p = np.full(size, m, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            out.append(p)
        have = tuple(out)
        if size <= 16 * STEP_BYTES:
            st["powers"] = have
    return have


def prefix_hash(buf: np.ndarray, fold: bool = True) -> np.ndarray:
    """Running sums from which ``span_hash`` takes the hash of any span."""
    v = byte_values(fold)[buf]
    v *= _powers(len(buf) + 1)[0][: len(buf)]
    c = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(v, out=c[1:])
    return c


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hash(c: np.ndarray, starts: np.ndarray, ends: np.ndarray, buf: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hashes of the spans of ``buf``; ``c``: its ``prefix_hash`` with the same ``fold``."""
    out = mix((c[ends] - c[starts]) * _powers(len(c))[1][starts])
    long = np.flatnonzero(ends - starts > SHORT)
    if len(long):
        raw = (_LOWER[buf] if fold else buf).tobytes()
        out[long] = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
    return out


def spans(buf: np.ndarray, off: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of each maximal run of word bytes; runs end at document ends."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    w = word[buf]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    starts = w.copy()
    starts[1:] &= ~w[:-1] | edge[1:n]
    last = w.copy()
    last[:-1] &= ~w[1:] | edge[1:n]
    s, e = np.flatnonzero(starts), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(off, s, side="right") - 1


def window_hash(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word index, hash) of every window of ``k`` consecutive words inside one document."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(MULT) + h[j : j + n]
    return at, mix(acc[at])


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, document offsets from 0) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def text_steps(batches: Iterable[pa.RecordBatch], text: str, step: int = STEP_BYTES
               ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into slices of about ``step`` bytes of text (one document at least), so that the
    numpy working memory has a bound whatever the batch size. Yields (slice, bytes, offsets)."""
    for rb in batches:
        if rb.num_rows == 0:
            continue
        buf, off = text_buffer(rb.column(text))
        a = 0
        while a < rb.num_rows:
            b = int(np.searchsorted(off, off[a] + step, side="right")) - 1
            b = min(max(b, a + 1), rb.num_rows)
            yield rb.slice(a, b - a), buf[off[a] : off[b]], off[a : b + 1] - off[a]
            a = b


def per_doc(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Count (or sum of integer weights) per document index, as int64."""
    return np.bincount(doc, weights=weights, minlength=n).astype(np.int64)
