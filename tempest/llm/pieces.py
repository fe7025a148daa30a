"""Token ids of whole texts by the ``tokenizers`` library, each distinct piece encoded once per worker.

The vocabularies in use split a text at white space before anything else, and (``word_bpe``) a run of
letters, one digit or a run of other signs is always a token sequence of its own. A document is therefore
cut at these proven boundaries, each *distinct* piece of a slice is looked up in the worker's cache, and
only pieces not seen before go through the library. Words with anything unusual (an apostrophe, ``<``,
control characters, or letters outside ASCII and Latin-1) are not cut: the whole word goes through the
library, special tokens in it included. Very long documents take another way: see ``encode_long``.
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Callable, Iterator

import numpy as np

from tempest.llm.textops import lut, mix, prefix_hash, span_hash, spans, worker_state

_SPACE = lut((9, 13), (32, 32))
_DIGIT = lut((48, 57))
_LETTER = lut((65, 90), (97, 122), (128, 255))
_ODD = lut((0, 8), (14, 31), (39, 39), (60, 60), (127, 127))
#: Pieces that one worker keeps; beyond it the cache starts anew (memory bound, no effect on results).
CACHE_PIECES = 2_000_000


def load_tokenizer(path: str):
    st = worker_state()
    if ("tok", path) not in st:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        st[("tok", path)] = t
    return st[("tok", path)]


def _cut(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document, hash) of the pieces of a slice."""
    ws, we, wd = spans(buf, off, ~_SPACE)
    if not len(ws):
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64)
    n = len(buf)
    high = buf >= 128
    lead = np.zeros(n, bool)  # first byte of a Latin-1 letter
    lead[:-1] = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
    tail = np.zeros(n, bool)
    tail[1:] = lead[:-1]
    odd = _ODD[buf] | (high & ~lead & ~tail)
    whole = np.add.reduceat(odd.view(np.uint8), ws, dtype=np.int64) > 0  # white space between words is never odd
    low = buf.copy()
    low[(buf >= 65) & (buf <= 90)] += 32
    up = tail & (buf <= 0x9E)
    low[up] += 32
    kind = np.full(n, 3, np.uint8)
    kind[_SPACE[buf]] = 0
    kind[_LETTER[buf]] = 1
    kind[_DIGIT[buf]] = 2
    if whole.any():
        size = (we - ws)[whole]
        at = np.repeat(ws[whole] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        kind[at] = 9
        low[at] = buf[at]  # special tokens are matched before lower-casing
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first = kind != 0
    first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2) | edge[1:n]
    last = kind != 0
    last[:-1] &= (kind[1:] != kind[:-1]) | (kind[:-1] == 2) | edge[1:n]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    h = span_hash(prefix_hash(low, fold=False), s, e, low, fold=False)
    return s, e, np.searchsorted(off, s, side="right") - 1, mix(h + (e - s).astype(np.uint64))


class PieceEncoder:
    """ids of many texts, with a cache of pieces (sorted 64-bit keys → slices of one id array)."""

    def __init__(self, path: str):
        self.tok = load_tokenizer(path)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.off = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    @staticmethod
    def on_worker(path: str) -> PieceEncoder:
        st = worker_state()
        if ("enc", path) not in st:
            st[("enc", path)] = PieceEncoder(path)
        return st[("enc", path)]

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        if len(self.keys) + len(keys) > CACHE_PIECES:
            self._clear()
        ids = []
        for i in range(0, len(texts), 4096):
            ids += [e.ids for e in self.tok.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        new = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(size.sum()))
        slot = np.arange(len(ids)) + len(self.off) - 1
        self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(size)])
        self.flat = np.concatenate([self.flat, new])
        keys, slot = np.concatenate([self.keys, keys]), np.concatenate([self.slot, slot])
        order = np.argsort(keys, kind="stable")
        self.keys, self.slot = keys[order], slot[order]

    def pieces(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first id, number of ids) of each piece; ids are in ``self.flat``."""
        s, e, doc, h = _cut(buf, off)
        if not len(s):
            return doc, doc, doc
        uniq, first, back = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, uniq)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == uniq[known]
        if not known.all():
            if len(self.keys) + int((~known).sum()) > CACHE_PIECES:
                self._clear()
                known[:] = False
            raw = buf.tobytes()
            self._learn(uniq[~known], [raw[s[i] : e[i]].decode("utf-8") for i in first[~known]])
            at = np.searchsorted(self.keys, uniq)
        slot = self.slot[at][back]
        return doc, self.off[slot], self.off[slot + 1] - self.off[slot]

    def counts(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        doc, _, size = self.pieces(buf, off)
        return np.bincount(doc, weights=size, minlength=len(off) - 1).astype(np.int64)

    def ids(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, offsets per document)."""
        doc, at, size = self.pieces(buf, off)
        per = np.bincount(doc, weights=size, minlength=len(off) - 1).astype(np.int64)
        total = int(size.sum()) if len(size) else 0
        pos = np.repeat(at - (np.cumsum(size) - size), size) + np.arange(total) if total else np.zeros(0, np.int64)
        return self.flat[pos], np.concatenate(([0], np.cumsum(per)))


#: Equal tokens (id and place) in a row that both encodings must have around a cut.
PROOF_TOKENS = 4
_CUT_AT = frozenset(" \t\n\r\x0b\x0c")


def _align(text: str, a: list[tuple[int, int, int]], b: list[tuple[int, int, int]]) -> tuple[int, int] | None:
    """Indices (in ``a``, in ``b``) of one common stable boundary: ``PROOF_TOKENS`` equal tokens with equal
    offsets on both sides of it together, and white space between its two tokens. None if there is none."""
    where = {t: j for j, t in enumerate(b)}
    need, run, best = PROOF_TOKENS, 0, None
    prev = None
    for i, t in enumerate(a):
        j = where.get(t)
        run = run + 1 if j is not None and prev == j - 1 and run else (1 if j is not None else 0)
        prev = j
        if run >= need:
            for k in range(i - need + 2, i + 1):  # a boundary inside the proven run
                if any(c in _CUT_AT for c in text[a[k - 1][2] : a[k][1]]):
                    best = (k, j - (i - k))
                    return best
    return best


def encode_long(tok, text: str, chunk: int, overlap: int,
                seen: Callable[[str], None] | None = None) -> Iterator[np.ndarray]:
    """ids of a huge text, a part at a time, from overlapping chunks (resynchronisation).

    Chunks of ``chunk`` characters are encoded with offsets; each next chunk starts ``overlap`` characters
    before the end of the last. The two encodings are spliced at a boundary that both have, inside
    ``PROOF_TOKENS`` equal tokens and at white space, which no token of these vocabularies crosses. Where no
    such boundary exists the overlap is doubled, and at worst both chunks are encoded as one.
    ``seen`` is told of each event (``"splice"``, ``"widen"``, ``"joined"``), for tests."""
    told = seen or (lambda _: None)

    def encode(a: int, b: int) -> list[tuple[int, int, int]]:
        e = tok.encode(text[a:b], add_special_tokens=False)
        return [(i, s + a, t + a) for i, (s, t) in zip(e.ids, e.offsets)]

    lo, hi = 0, min(chunk, len(text))
    cur = encode(lo, hi)
    while hi < len(text):
        width = overlap
        while True:
            nlo, nhi = max(lo, hi - width), min(len(text), hi + chunk)
            if nlo == lo:  # nothing is proven: both chunks become one
                told("joined")
                cur, hi = encode(lo, nhi), nhi
                break
            nxt = encode(nlo, nhi)
            cut = _align(text, [t for t in cur if t[1] >= nlo], nxt)
            if cut:
                told("splice")
                keep = sum(1 for t in cur if t[1] < nlo) + cut[0]
                yield np.fromiter((t[0] for t in cur[:keep]), np.uint32, keep)
                cur, lo, hi = nxt[cut[1]:], nxt[cut[1]][1], nhi
                break
            told("widen")
            width *= 2
    yield np.fromiter((t[0] for t in cur), np.uint32, len(cur))
