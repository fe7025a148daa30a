"""Alignment of two tokenizers' tokens by a galloping intersection of their byte ends.

Tokenizer A (byte-level BPE, a ``.json`` of ``tokenizers``) encodes space + text, tokenizer B (``sentencepiece``) the
text, to which it adds the space itself; special tokens' strings are ordinary text. Both sequences spell the same bytes,
so each has an increasing list of byte ends. The shorter list of a document drives: each of its ends gallops (steps of
1, 2, 4, ..., then a binary search) from where its predecessor was found in the longer list (``gallop``). Ends in both
lists cut the tokens into groups; the difference of two neighbouring ranks is the range of longer-list tokens that a
driving token overlaps: its links.

How many documents hold an id pair linked is counted over the whole corpus: blocks of documents send their distinct pairs
to shards and get the counts back in the order sent (``sums``). The highest count of each A id is a table of at most A's
vocabulary, the only thing that passes the driver.

Encoding: a single space between two printable ASCII or Latin-1 letters always starts a new piece in A (its pattern
takes a space only as the first sign of a piece) and in B (if no vocabulary piece has a space after another sign), so text
is cut there and each distinct unit is encoded once per worker. Both conditions are read from the files; where one does not
hold, whole texts are the units.

Edge cases: a null or empty text, or one that a tokenizer does not spell back byte by byte (U+2581 in a text), has no
tokens: zeros and an empty ``groups_sha256``. Null ids stay null, equal rows count as documents each, an empty table gives
an empty result; other columns, whatever their names, are not read. Very long texts are whole: a slice is one document then.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.llm.blocks import pack_table, unpack_table
from tempest.llm.sums import by_block, number_of_shards, placed, sharded_totals
from tempest.llm.textops import lut, text_steps, worker_state
from tempest.session import materialize

#: Text bytes of a block: the documents that ask for their pairs' counts together.
BLOCK_BYTES = 8 << 20
#: Lists that gallop side by side in one numpy step.
LANES = 4096
#: Token ids that a worker keeps of each tokenizer; beyond it the cache starts anew.
CACHE_IDS = 8_000_000

_PLAIN = lut((0x21, 0x7E))


def byte_symbols() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable Latin-1 as itself, the others from
    U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def gallop(short: np.ndarray, long: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """For each entry of the increasing list ``short``, the number of entries of the increasing list ``long`` below
    it. ``short`` is cut into runs that are walked side by side; in a run each entry starts where the one before ended."""
    n, m = len(short), len(long)
    rank = np.zeros(n, np.int64)
    if n == 0 or m == 0:
        return rank
    steps = -(-n // lanes)
    start = np.arange(0, n, steps)
    at = np.zeros(len(start), np.int64)  # all entries before it are below the lane's value
    for k in range(steps):
        i = start + k
        i = i[i < n]
        x, lo = short[i], at[: len(i)].copy()
        hi, jump = lo.copy(), 1
        go = np.flatnonzero((hi < m) & (long[np.minimum(hi, m - 1)] < x))
        while len(go):
            lo[go] = hi[go] + 1
            hi[go] = np.minimum(hi[go] + jump, m)
            jump *= 2
            go = go[(hi[go] < m) & (long[np.minimum(hi[go], m - 1)] < x[go])]
        hi = np.maximum(hi, lo)
        go = np.flatnonzero(lo < hi)
        while len(go):
            mid = (lo[go] + hi[go]) >> 1
            below = long[mid] < x[go]
            lo[go] = np.where(below, mid + 1, lo[go])
            hi[go] = np.where(below, hi[go], mid)
            go = go[lo[go] < hi[go]]
        rank[i] = lo
        at = lo
    return rank


def intersect(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rank, common, first): ``common[t]``: the end of token t is also one of ``long``; token t overlaps the long
    tokens ``first[t]`` to ``rank[t]``. The last ends are the same, as two spellings of the same bytes have."""
    rank = gallop(short, long)
    common = long[rank] == short if len(short) else np.zeros(0, bool)
    first = np.zeros(len(short), np.int64)
    first[1:] = rank[:-1] + common[:-1]
    return rank, common, first


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (sizes[0] of them), starts[1], ..."""
    total = int(sizes.sum())
    return np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(total) if total else np.zeros(0, np.int64)


class Spelling:
    """One tokenizer: ids of units (each begins with a space) and the bytes of each id."""

    def __init__(self, path: str):
        self.model = path.endswith(".model")
        if self.model:
            import sentencepiece

            self.tok = sentencepiece.SentencePieceProcessor(model_file=path)
            pieces = [self.tok.id_to_piece(i) for i in range(self.tok.vocab_size())]
            self.bytes = [bytes([int(p[3:5], 16)]) if self.tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
            self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        else:
            import json

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tok = Tokenizer.from_file(path)
            self.tok.no_truncation()
            self.tok.no_padding()
            self.tok.encode_special_tokens = True
            symbols = byte_symbols()
            names = {i: s for s, i in self.tok.get_vocab(with_added_tokens=True).items()}
            entries = [names.get(i, "") for i in range(max(names) + 1)]
            self.bytes = [bytes([symbols[c] for c in s]) if all(c in symbols for c in s) else s.encode() for s in entries]
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            pre = spec.get("pre_tokenizer") or {}
            self.cuts = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.size = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, units: list[bytes]) -> list[list[int]]:
        texts = [u.decode("utf-8") for u in units]
        if self.model:
            return self.tok.encode([t[1:] for t in texts], num_threads=1)
        return [e.ids for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def spell(self, ids) -> bytes:
        return b"".join([self.bytes[i] for i in ids])


class Grown:
    """Ragged id lists that grow at the end."""

    def __init__(self):
        self.flat, self.start, self.n = np.zeros(1 << 16, np.int32), [0], 0

    def add(self, lists: list[list[int]]) -> None:
        size = sum(map(len, lists))
        if self.n + size > len(self.flat):
            self.flat = np.concatenate((self.flat[: self.n], np.zeros(max(size, len(self.flat)), np.int32)))
        for x in lists:
            self.flat[self.n : self.n + len(x)] = x
            self.n += len(x)
            self.start.append(self.n)


class TwoSpellings:
    """Both tokenizers with a cache of units."""

    def __init__(self, a_path: str, b_path: str):
        self.both = Spelling(a_path), Spelling(b_path)
        self.cuts = all(s.cuts for s in self.both)
        self._anew()

    @classmethod
    def on_worker(cls, a_path: str, b_path: str) -> "TwoSpellings":
        st = worker_state()
        if ("two", a_path, b_path) not in st:
            st[("two", a_path, b_path)] = cls(a_path, b_path)
        return st[("two", a_path, b_path)]

    def _anew(self):
        self.known: dict[bytes, int] = {}
        self.ids, self.same = (Grown(), Grown()), []

    def _look_up(self, units: list[bytes]) -> np.ndarray:
        at = list(map(self.known.get, units))
        new = [u for u, i in zip(units, at) if i is None]
        if new:
            lists = [s.encode(new) for s in self.both]
            for grown, x in zip(self.ids, lists):
                grown.add(x)
            self.same += [self.both[0].spell(a) == u == self.both[1].spell(b) for u, a, b in zip(new, *lists)]
            for u in new:
                self.known[u] = len(self.known)
            at = list(map(self.known.__getitem__, units))
        return np.array(at, np.int64)

    def encode(self, buf: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each tokenizer (ids, token count per document) of a slice of documents; none where the spellings differ."""
        if max(g.n for g in self.ids) > CACHE_IDS:
            self._anew()
        size = np.diff(off)
        full = size > 0
        off2 = np.concatenate(([0], np.cumsum(size + full)))
        data = np.full(off2[-1], 0x20, np.uint8)
        keep = np.ones(len(data), bool)
        keep[off2[:-1][full]] = False
        data[keep] = buf
        first = np.zeros(len(data), bool)
        first[off2[:-1][full]] = True
        if self.cuts and len(data) > 2:
            latin = np.zeros(len(data), bool)  # the second byte of U+00C0 to U+00FF
            latin[1:] = data[:-1] == 0xC3
            plain = _PLAIN[data]
            first[2:-1] |= (data[2:-1] == 0x20) & (plain | latin)[1:-2] & (plain | (data == 0xC3))[3:]
        starts = np.flatnonzero(first)
        if not len(starts):
            return [(np.zeros(0, np.int32), np.zeros(len(size), np.int64)) for _ in self.both]
        ends = np.append(starts, len(data)).astype(np.int64)
        units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        unit = self._look_up(units.dictionary.to_pylist())[units.indices.to_numpy()]
        doc = np.searchsorted(off2, starts, side="right") - 1
        good = np.array(self.same)[unit]
        if not good.all():  # compare the whole text: what one unit lacks another might have
            for d in np.unique(doc[~good]):
                mine = unit[doc == d]
                if not all(b"".join(s.spell(g.flat[g.start[u] : g.start[u + 1]]) for u in mine) == data[off2[d] : off2[d + 1]].tobytes()
                           for s, g in zip(self.both, self.ids)):
                    unit[doc == d] = -1
        unit, doc = unit[unit >= 0], doc[unit >= 0]
        out = []
        for grown in self.ids:
            start = np.array(grown.start)
            a, n = start[unit], start[unit + 1] - start[unit]
            out.append((grown.flat[ragged(a, n)], np.bincount(doc, weights=n, minlength=len(size)).astype(np.int64)))
        return out


def align(a_size: np.ndarray, b_size: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
    """Tokens of a slice's documents by their byte sizes → (common per A token, common per B token, link A index,
    link B index). In each document the shorter list drives."""
    ends, count = [np.cumsum(a_size), np.cumsum(b_size)], [n_a, n_b]
    common = [np.zeros(len(e), bool) for e in ends]
    links: list[list[np.ndarray]] = [[], []]
    for drive, docs in ((0, n_a <= n_b), (1, n_a > n_b)):
        at = [np.flatnonzero(np.repeat(docs, n)) for n in count]
        s, t = at[drive], at[1 - drive]
        rank, same, first = intersect(ends[drive][s], ends[1 - drive][t])
        common[drive][s[same]] = True
        common[1 - drive][t[rank[same]]] = True
        size = rank - first + 1
        links[drive].append(np.repeat(s, size))
        links[1 - drive].append(t[ragged(first, size)])
    return common[0], common[1], np.concatenate(links[0]), np.concatenate(links[1])


def group_digests(ids: list[np.ndarray], common: list[np.ndarray], doc_ends: np.ndarray) -> list[str]:
    """SHA-256 of each document's ``a1,a2|b1;a3|b2,b3``; ``doc_ends``: tokens of A and B up to each document's end."""
    width = max(2, *(len(str(int(x.max()))) if len(x) else 1 for x in ids))
    cells = np.zeros((sum(map(len, ids)), width + 1), np.uint8)
    for k, (x, last) in enumerate(zip(ids, common)):
        group = np.cumsum(last) - last
        edge = np.flatnonzero(common[1 - k]) + 1
        place = np.arange(len(x)) + (np.concatenate(([0], edge))[group] if k == 0 else edge[group])
        digits, rest = np.zeros((len(x), width + 1), np.uint8), x.astype(np.int64)
        digits[:, width] = np.where(last, ord("|;"[k]), ord(","))
        for c in range(width - 1, -1, -1):
            digits[:, c] = np.where((rest > 0) | (c == width - 1), 48 + rest % 10, 0)
            rest = rest // 10
        cells[place] = digits
    shown = cells > 0
    at = np.concatenate(([0], np.cumsum(shown.sum(axis=1))))[np.concatenate(([0], doc_ends))]
    flat = cells[shown].tobytes()
    return [hashlib.sha256(flat[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(at[:-1], at[1:])]


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of aligned documents: (block, n_keys, keys, counts, docs, pairs). ``keys``: distinct (A id << 32 | B id)
    linked in the block, ``counts``: documents of the block that hold it, ``docs``: a row per document, ``pairs``: its
    distinct linked pairs (place in ``keys``, number of links) one document after the other."""

    def pack(block: int, held: list[tuple]) -> pa.RecordBatch:
        rows = pa.Table.from_batches([h[0] for h in held]).combine_chunks().to_batches()[0]
        keys, at, n = np.unique(np.concatenate([h[1] for h in held]), return_inverse=True, return_counts=True)
        pairs = pa.RecordBatch.from_arrays([pa.array(at.astype(np.uint32)), pa.array(np.concatenate([h[2] for h in held]))], ["at", "n"])
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([len(keys)], pa.int64()),
             *(pa.array([x], pa.binary()) for x in (keys.tobytes(), n.astype(np.uint32).tobytes(), pack_table(rows), pack_table(pairs)))],
            ["block", "n_keys", "keys", "counts", "docs", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = TwoSpellings.on_worker(a_path, b_path)
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for rb, buf, off in text_steps(batches, "text"):
            (a, n_a), (b, n_b) = two.encode(buf, off)
            common_a, common_b, link_a, link_b = align(two.both[0].size[a], two.both[1].size[b], n_a, n_b)
            ends_a, ends_b = np.cumsum(n_a), np.cumsum(n_b)
            key = a[link_a].astype(np.uint64) << np.uint64(32) | b[link_b].astype(np.uint64)
            doc = np.searchsorted(ends_a, link_a, side="right")
            order = np.lexsort((key, doc))
            key, doc = key[order], doc[order]
            new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))[: len(key)])
            n_docs = rb.num_rows
            rows = pa.RecordBatch.from_arrays(
                [rb.column("doc_id"), pa.array(n_a), pa.array(n_b),
                 pa.array(np.diff(np.concatenate(([0], np.cumsum(common_a)))[np.concatenate(([0], ends_a))])),
                 pa.array(np.bincount(doc, minlength=n_docs)), pa.array(np.bincount(doc[new], minlength=n_docs)),
                 pa.array(group_digests([a, b], [common_a, common_b], ends_a + ends_b), pa.string())],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_pairs", "groups_sha256"])
            held.append((rows, key[new], np.diff(np.append(new, len(key))).astype(np.uint32)))
            size += len(buf)
            if size >= block_bytes:
                yield pack(block, held)
                block, held, size = block + 1, [], 0
                pa.default_memory_pool().release_unused()
        if held:
            yield pack(block, held)

    return materialize(docs.select("doc_id", "text").mapInArrow(run, "block long, n_keys long, keys binary, counts binary, docs binary, pairs binary"), "aligned")


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose id pair's document count is the
    highest of its A id), count_sum (of the links' counts), groups_sha256."""
    spark = docs.sparkSession
    d = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    blocks = aligned_blocks(d, a_path, b_path, block_bytes)
    shards = number_of_shards(blocks.agg(F.sum("n_keys")).first()[0] or 0)

    def highest(keys: np.ndarray, totals: np.ndarray) -> tuple[bytes, bytes]:
        a = (keys >> np.uint64(32)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        return a[cut].tobytes(), np.maximum.reduceat(totals, cut).tobytes()

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, n in zip(b.column("s_keys").to_pylist(), b.column("s_values").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(a, np.int64)), pa.array(np.frombuffer(n, np.int64))], ["a", "n"])

    totals = materialize(sharded_totals(blocks, shards, highest), "pair-counts")
    tops = (totals.where("s_keys is not null").select("s_keys", "s_values").mapInArrow(opened, "a long, n long")
            .groupBy("a").agg(F.max("n").alias("n")).toPandas())  # at most a row for each id of A's vocabulary
    top = np.zeros(int(tops["a"].max()) + 1 if len(tops) else 1, np.int64)
    top[tops["a"].to_numpy(np.int64)] = tops["n"].to_numpy(np.int64)
    held = spark.sparkContext.broadcast(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = held.value
        for rb in batches:
            for keys, rows, pairs, answers in zip(*(rb.column(c) for c in ("keys", "docs", "pairs", "answers"))):
                keys, rows, pairs = np.frombuffer(keys.as_py(), np.uint64), unpack_table(rows.as_py()), unpack_table(pairs.as_py())
                count = placed(keys, shards, answers.as_py() or [])
                at, n = pairs.column("at").to_numpy(), pairs.column("n").to_numpy().astype(np.int64)
                good = count == best[(keys >> np.uint64(32)).astype(np.int64)]
                ends = np.cumsum(rows.column("n_pairs").to_numpy())
                sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[np.concatenate(([0], ends))]) for x in (n * good[at], n * count[at])]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), pa.array(sums[0]), pa.array(sums[1]),
                     rows.column("groups_sha256")],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    joined = blocks.select("block", "keys", "docs", "pairs").join(by_block(totals), "block", "left").drop("block")
    return joined.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align_tokenizers(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
