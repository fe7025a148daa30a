"""Language-model scoring by online logistic context mixing; total bits per byte of every document.

A text is its words and one end token. It is coded as a sequence of binary decisions, each predicted by several
hashed-context bit predictors whose stretched probabilities are mixed by weights that a gate selects:

* *Seen?* Has this document had the token before? Predictors: the place (log2) with the last decision, the last
  four decisions, the previous word, the previous two words, the previous word's length and last byte (counts of
  the whole corpus in hashed slots), and the document's own share so far. Gate: log2 of the place. The mixed
  logit is refined adaptively by the document's running prediction error.
* *Which seen token?* Is it the one that followed the previous word when the document had that last? Predictors: how often
  the document has had the previous word, that word itself, and how often the document has had the expected one. If not (or
  nothing is expected), it has the probability of its count among the document's other tokens so far.
* *Known?* For a new token: does it occur in other training documents? An adaptive estimate of the document, with
  the corpus' share as its prior.
* *Which known token?* The ``CODE`` bits of its hash, one by one, each in the context of the bits before: predictors of
  orders 0-2 (no word, the previous one, the previous two) over hashed slots, mixed by weights per bit. Among the tokens with
  these bits it has its share of the corpus count, without the tokens that the document has had (they would have been
  "seen") and without the document's own occurrences; of a training document each decision is left out of its own counts.
* *Bytes.* An unknown word is spelled, bit by bit of its bytes and an end byte: predictors of orders 0-4 inside the
  word over hashed slots, mixed by weights per bit and place. They count word types of the corpus once each.

All probabilities together are those of one code, so the sum of logarithms is the text's log-probability.

Counts cover all training documents (crc32(id) mod 5 != 1): blocks of documents send their distinct words with
counts, Spark sums them by word, and the answers return to the blocks (``blocks``); what is gathered grows with
the vocabulary. The mixing weights (a few hundred numbers) are fitted on all of that too: those of *seen?* by one
online pass over the training texts of each block, averaged by the blocks' decisions, and so are those of *which?*; those of
the spelling by Newton steps over all word types, reduced to counted (context, byte) pairs. Hashed slots are tables of fixed
size, broadcast (43 MB).

Edge cases: null and empty texts are the end token alone; a null id is in neither fold and is learned from;
repeated rows get equal scores; without training documents every count is 0 and scores are finite; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.llm.blocks import pack_answers, unpack_answers, unpack_table, write_blocks
from tempest.llm.textops import MULT, SPACE_WORD, mix, prefix_hash, span_hash, spans, text_steps
from tempest.session import materialize

END_HASH = 0x5DEECE66D
SEEN_BITS = 16
SEEN_K = 5
SPELL_BITS = 21
ORDERS = 5
GATES = 16
#: Bits of a known token's code; log2 of the hashed slots of its predictors, and of those that travel as one packed array.
CODE, NEXT_BITS, NEXT_SHARD, NEXT_K = 12, 21, 14, 3
#: Rates of the adaptive refinement that are tried.
RATES = (0.0, 0.05, 0.1, 0.2, 0.4)
#: Newton steps of the spelling weights at most, and the pull to the weights that they begin with.
STEPS, RIDGE = 8, 1.0
#: Bytes of text in a block: fewer distinct words are asked for in all.
BLOCK = 16 << 20
LOG10 = np.log(10.0)


def tokens(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The token streams of a slice: doc, t (place), h (hash), rank (earlier occurrences), seen, slots (K rows)."""
    n = len(off) - 1
    s, e, wd = spans(buf, off, SPACE_WORD)
    wh = span_hash(prefix_hash(buf), s, e, buf)
    count = np.bincount(wd, minlength=n) + 1
    first = np.concatenate(([0], np.cumsum(count)))
    doc = np.repeat(np.arange(n), count)
    t = np.arange(len(doc)) - first[doc]
    at = np.arange(len(wh)) + wd  # each earlier document has added its end token
    h = np.full(len(doc), END_HASH, np.uint64)
    h[at] = wh
    shape = np.zeros(len(doc), np.uint64)
    if len(s):
        shape[at] = (np.minimum(e - s, 31) << 8 | buf[e - 1]).astype(np.uint64)
    own = h ^ mix(doc.astype(np.uint64) + np.uint64(1))  # a word of a document, as one 64-bit hash
    order = np.argsort(own, kind="stable")  # occurrences in text order
    new = np.ones(len(doc), bool)
    new[1:] = own[order][1:] != own[order][:-1]
    start = np.flatnonzero(new)
    rank = np.zeros(len(doc), np.int64)
    rank[order] = np.arange(len(doc)) - np.repeat(start, np.diff(np.append(start, len(doc))))
    size = np.zeros(len(doc), np.int64)
    size[order] = np.repeat(np.diff(np.append(start, len(doc))), np.diff(np.append(start, len(doc))))
    seen = rank > 0

    def back(x: np.ndarray, j: int) -> np.ndarray:
        y = np.zeros_like(x)
        y[j:] = x[:-j]
        y[t < j] = 0
        return y

    p1, p2 = back(h, 1), back(h, 2)
    bits = sum(back(seen.astype(np.uint64), j) << np.uint64(j - 1) for j in range(1, 5))
    gate = np.minimum(np.log2(t + 1).astype(np.int64), GATES - 1)
    ctx = [gate.astype(np.uint64) * np.uint64(2) + (bits & np.uint64(1)), bits, p1, p1 * np.uint64(MULT) + p2, back(shape, 1)]
    slots = np.stack([(mix(c + np.uint64(k * 0x1234567)) >> np.uint64(64 - SEEN_BITS)).astype(np.int64) + (k << SEEN_BITS)
                      for k, c in enumerate(ctx)])
    return {"doc": doc, "t": t, "h": h, "rank": rank, "tf": size, "seen": seen, "slots": slots, "gate": gate,
            "first": first, "ws": s, "we": e, "at": at, "p1": p1, "p2": p2, "own": own, "order": order, "new": new}


def expected(tk: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Of the tokens whose previous word the document has had before: i (token), hit (it follows again what followed then),
    after (how often the previous word came before), count (how often the expected token did)."""
    own, order, new, rank, doc = (tk[x] for x in ("own", "order", "new", "rank", "doc"))
    n = len(own)
    word, place = np.empty(n, np.int64), np.empty(n, np.int64)
    word[order], place[order] = np.cumsum(new) - 1, np.arange(n)
    i = 1 + np.flatnonzero((rank[:-1] > 0) & (doc[:-1] == doc[1:]))
    then = order[place[i - 1] - 1] + 1
    key = word[order] * (n + 1) + order
    count = np.searchsorted(key, word[then] * (n + 1) + i) - np.flatnonzero(new)[word[then]]
    return {"i": i, "hit": own[i] == own[then], "after": rank[i - 1], "count": count}


def codes(h: np.ndarray) -> np.ndarray:
    return (mix(h + np.uint64(0xC0DE)) >> np.uint64(64 - CODE)).astype(np.int64)


def next_decisions(tk: dict[str, np.ndarray], e: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The decisions of *which?*, one gate after the other: (slots of the predictors, tokens, outcome). e: ``expected(tk)``."""

    def slots(base: list[np.ndarray], node: np.ndarray) -> np.ndarray:
        return np.stack([(mix(x + node * np.uint64(MULT)) >> np.uint64(64 - NEXT_BITS)).astype(np.int64) for x in base])

    some = tk["seen"][e["i"]]
    i, after, count = e["i"][some], e["after"][some], e["count"][some]
    ctx = [np.minimum(after, 31).astype(np.uint64), tk["p1"][i], (np.minimum(count, 31) * GATES + tk["gate"][i]).astype(np.uint64)]
    yield slots([mix(c + np.uint64(k * 0x9E37)) for k, c in enumerate(ctx)], np.zeros(len(i), np.uint64)), i, e["hit"][some]
    i = np.flatnonzero(~tk["seen"])
    code = codes(tk["h"][i])
    ctx = [np.zeros(len(i), np.uint64), tk["p1"][i], tk["p1"][i] * np.uint64(MULT) + tk["p2"][i]]
    base = [mix(c + np.uint64((k + NEXT_K) * 0x9E37)) for k, c in enumerate(ctx)]
    for b in range(CODE):
        yield slots(base, ((1 << b) | (code >> (CODE - b))).astype(np.uint64)), i, code >> (CODE - 1 - b) & 1 == 1


def next_table(counts: np.ndarray) -> np.ndarray:
    """Stretched predictions of all slots: as counted, without an outcome 0 of their own, and without an outcome 1."""
    n0, n1 = counts[:, 0], counts[:, 1]
    return np.concatenate([_stretch(n0, n1), _stretch(np.maximum(n0 - 1, 0), n1), _stretch(n0, np.maximum(n1 - 1, 0))])


def _next_inputs(table: np.ndarray, slots: np.ndarray, y: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """The predictions and a one; the decisions ``mine`` are left out of their own counts."""
    return np.concatenate([table[slots + (mine * (1 + y) << NEXT_BITS)], np.ones((1, len(y)), np.float32)])


def _stretch(n0: np.ndarray, n1: np.ndarray, a: float = 0.4) -> np.ndarray:
    """ln(p/(1-p)) of a bit predictor with counts n0, n1, pulled to 0 where it has seen little."""
    return (np.log((n1 + a) / (n0 + a)) * ((n0 + n1) / (n0 + n1 + 1.5))).astype(np.float32)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


class Mixer:
    """Logistic mixing: a weight vector per gate, refined online by the prediction error."""

    def __init__(self, gates: int, k: int, w: np.ndarray | None = None):
        self.w = np.full((gates, k + 1), 1.0 / k, np.float32) if w is None else w
        if w is None:
            self.w[:, -1] = 0

    def logit(self, st: np.ndarray, gate: np.ndarray) -> np.ndarray:
        w = self.w[gate]
        out = w[:, -1].copy()
        for k in range(len(st)):
            out += w[:, k] * st[k]
        return out

    def learn(self, st: np.ndarray, gate: np.ndarray, y: np.ndarray, rate: float = 0.02, step: int = 512) -> None:
        """One online pass in the order given, in steps of ``step`` decisions."""
        x = np.concatenate([st, np.ones((1, st.shape[1]), np.float32)])
        for a in range(0, st.shape[1], step):
            g = gate[a : a + step]
            err = y[a : a + step] - _squash((self.w[g] * x[:, a : a + step].T).sum(1))
            n = np.bincount(g, minlength=len(self.w))
            move = np.zeros_like(self.w)
            np.add.at(move, g, err[:, None].astype(np.float32) * x[:, a : a + step].T)
            some = n > 0
            self.w[some] += rate * 8 * move[some] / np.sqrt(n[some])[:, None]


def _own_share(tk: dict[str, np.ndarray]) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(tk["seen"])))
    ones = c[:-1] - c[tk["first"][tk["doc"]]]
    return np.log((ones + 0.5) / (tk["t"] - ones + 0.5)).astype(np.float32)


def seen_logit(tk: dict[str, np.ndarray], table: np.ndarray, mixer: Mixer, rate: float) -> np.ndarray:
    """Mixed logit of *seen?* at every token, refined by the running error of its document."""
    x = mixer.logit(_seen_inputs(tk, table), tk["gate"])
    return x + rate * _running_error(tk, x) if rate else x


def _seen_inputs(tk: dict[str, np.ndarray], table: np.ndarray) -> np.ndarray:
    return np.concatenate([table[tk["slots"]], _own_share(tk)[None]])


def _running_error(tk: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    err = np.concatenate(([0.0], np.cumsum(tk["seen"] - _squash(x))))
    return (err[:-1] - err[tk["first"][tk["doc"]]]) / np.sqrt(tk["t"] + 16.0)


def spell_bits(words: list[bytes] | np.ndarray, off: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each of 8 bits: (slots of the K orders, gate, bit, word index) of all bytes of all words + end byte."""
    if off is None:
        data = np.frombuffer(b"".join(w + b" " for w in words), np.uint8)
        off = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words]))).astype(np.int64)
    else:
        data = words
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    place = np.arange(len(data)) - off[owner]
    ctx = np.zeros(len(data), np.uint64)
    ctxs = [ctx]
    for j in range(1, ORDERS):
        prev = np.zeros(len(data), np.uint64)
        prev[j:] = data[:-j]
        prev[place < j] = 0
        ctx = ctx | prev << np.uint64(8 * (j - 1))
        ctxs.append(ctx)
    base = [mix(c * np.uint64(8) + np.uint64(k)) for k, c in enumerate(ctxs)]
    for b in range(8):
        node = ((1 << b) | (data.astype(np.int64) >> (8 - b))).astype(np.uint64)
        bit = (data >> (7 - b)) & 1
        slots = np.stack([(mix(x + node * np.uint64(MULT)) >> np.uint64(64 - SPELL_BITS)).astype(np.int64) for x in base])
        yield slots, np.minimum(place, 3) * 8 + b, bit, owner


def spell_log(words: list[bytes], table: np.ndarray, mixer: Mixer) -> np.ndarray:
    """ln probability of each word's spelling."""
    out = np.zeros(len(words))
    for a in range(0, len(words), 20_000):
        part = words[a : a + 20_000]
        for slots, gate, bit, owner in spell_bits(part):
            x = mixer.logit(table[slots], gate)
            ll = -np.logaddexp(0, np.where(bit == 1, -x, x))
            out[a : a + len(part)] += np.bincount(owner, weights=ll, minlength=len(part))
    return out


def _lower(buf: np.ndarray) -> bytes:
    low = buf.copy()
    low[(buf >= 65) & (buf <= 90)] += 32
    return low.tobytes()


def _gather(blocks: DataFrame) -> DataFrame:
    """(kind, block, h, c, c1, word): kind 0: a distinct word of a block, its count and type bytes in training texts;
    kind 1: a slot of *seen?* (h), its counts of 0 (c) and 1 (c1) in the task's training texts; kind 2: 2^NEXT_SHARD slots of
    *which?*, the h-th so many, their counts in the task's training texts (word: packed pairs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero, one = np.zeros(SEEN_K << SEEN_BITS, np.int64), np.zeros(SEEN_K << SEEN_BITS, np.int64)
        following = np.zeros(2 << NEXT_BITS, np.int32)
        for b in batches:
            for block, payload in zip(b.column("block").to_pylist(), b.column("payload")):
                us, cs, ws = [], [], []
                for part, buf, off in text_steps([unpack_table(payload.as_py())], "text"):
                    fit = part.column("fit").to_numpy(zero_copy_only=False).astype(bool)
                    tk = tokens(buf, off)
                    ok = fit[tk["doc"]]
                    for k in range(SEEN_K):
                        sl = tk["slots"][k]
                        one += np.bincount(sl[ok & tk["seen"]], minlength=len(one))
                        zero += np.bincount(sl[ok & ~tk["seen"]], minlength=len(zero))
                    at = [(slots * 2 + y)[:, ok[i]].ravel() for slots, i, y in next_decisions(tk, expected(tk))]
                    following += np.bincount(np.concatenate(at), minlength=len(following)).astype(np.int32)
                    u, first, inv = np.unique(tk["h"], return_index=True, return_inverse=True)
                    us.append(u)
                    cs.append(np.bincount(inv, weights=ok, minlength=len(u)).astype(np.int64))
                    low, word_at = _lower(buf), np.full(len(tk["h"]), -1, np.int64)
                    word_at[tk["at"]] = np.arange(len(tk["at"]))
                    s, e = tk["ws"], tk["we"]
                    ws.append(np.array([low[s[i] : e[i]] if i >= 0 else b"" for i in word_at[first]], object))
                u, first, inv = np.unique(np.concatenate(us), return_index=True, return_inverse=True)
                c = np.bincount(inv, weights=np.concatenate(cs), minlength=len(u)).astype(np.int64)
                word = np.concatenate(ws)[first]
                for a in range(0, len(u), 20_000):
                    z = min(a + 20_000, len(u))
                    yield _rows(0, block, u[a:z].view(np.int64), c[a:z], np.zeros(z - a, np.int64), list(word[a:z]))
        some = np.flatnonzero(zero + one)
        for a in range(0, len(some), 50_000):
            x = some[a : a + 50_000]
            yield _rows(1, 0, x, zero[x], one[x], [None] * len(x))
        for k, part in enumerate(following.reshape(-1, 2 << NEXT_SHARD)):
            if part.any():
                none = np.zeros(1, np.int64)
                yield _rows(2, 0, np.array([k]), none, none, [pa.compress(part.tobytes(), "zstd", asbytes=True)])

    return blocks.mapInArrow(run, "kind int, block long, h long, c long, c1 long, word binary")


def _rows(kind: int, block: int, h: np.ndarray, c: np.ndarray, c1: np.ndarray, word: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(h), kind, np.int32)), pa.array(np.full(len(h), block, np.int64)), pa.array(h), pa.array(c),
         pa.array(c1), pa.array(word, pa.binary())], ["kind", "block", "h", "c", "c1", "word"])


def _spell_pairs(types: DataFrame) -> DataFrame:
    """(g, c), written: the distinct (gate place, context of 4 bytes, next byte) of all word types (word binary), counted."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            words = [w.as_py() for w in rb.column("word")]
            if not words:
                continue
            data = np.frombuffer(b"".join(w + b" " for w in words), np.uint8)
            off = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words]))).astype(np.int64)
            place = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
            g = data.astype(np.int64) | np.minimum(place, 3) << 40
            for j in range(1, ORDERS):
                prev = np.zeros(len(data), np.int64)
                prev[j:] = data[:-j]
                prev[place < j] = 0
                g |= prev << (8 * j)
            u, c = np.unique(g, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(c.astype(np.int64))], ["g", "c"])

    return materialize(types.mapInArrow(pairs, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")), "spelled")


def _pair_bits(g: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each of 8 bits of the pairs' bytes: (slots of the K orders, gate, bit), as ``spell_bits`` gives them for words."""
    data, ctx, place = g & 0xFF, (g >> 8 & 0xFFFFFFFF).astype(np.uint64), g >> 40
    base = [mix((ctx & np.uint64((1 << 8 * k) - 1)) * np.uint64(8) + np.uint64(k)) for k in range(ORDERS)]
    for b in range(8):
        node = ((1 << b) | (data >> (8 - b))).astype(np.uint64)
        slots = np.stack([(mix(x + node * np.uint64(MULT)) >> np.uint64(64 - SPELL_BITS)).astype(np.int64) for x in base])
        yield slots, place * 8 + b, (data >> (7 - b)) & 1


def _spell_counts(grams: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Slot counts of the spelling predictors over all pairs; at most 2^SPELL_BITS slots reach the driver."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero, one = np.zeros(1 << SPELL_BITS, np.int64), np.zeros(1 << SPELL_BITS, np.int64)
        for rb in batches:
            g, c = rb.column("g").to_numpy(), rb.column("c").to_numpy()
            for slots, _, bit in _pair_bits(g):
                y = bit == 1
                for slot in slots:
                    np.add.at(one, slot[y], c[y])
                    np.add.at(zero, slot[~y], c[~y])
        some = np.flatnonzero(zero + one)
        for a in range(0, len(some), 50_000):
            x = some[a : a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(zero[x]), pa.array(one[x])], ["slot", "n0", "n1"])

    t = grams.mapInArrow(nodes, "slot long, n0 long, n1 long").groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    zero, one = np.zeros(1 << SPELL_BITS, np.float32), np.zeros(1 << SPELL_BITS, np.float32)
    slot = t["slot"].to_numpy()
    zero[slot], one[slot] = t["n0"].to_numpy(), t["n1"].to_numpy()
    return zero, one


def _fit_spelling(grams: DataFrame, zero: np.ndarray, one: np.ndarray) -> Mixer:
    """Weights of the spelling mixer on all word types, each left out of its own counts: Newton steps of the logistic
    regression per gate. A task adds up the gradients and Hessians of its pairs, Spark those of the tasks."""
    m, k = Mixer(32, ORDERS), ORDERS + 1
    start = m.w.astype(np.float64)
    counts = grams.sparkSession.sparkContext.broadcast((zero, one))

    def sums_at(w: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            zero, one = counts.value
            grad, hess = np.zeros((32, k)), np.zeros((32, k, k))
            for rb in batches:
                g, c = rb.column("g").to_numpy(), rb.column("c").to_numpy()
                for slots, gate, bit in _pair_bits(g):
                    y = bit.astype(np.float32)
                    st = _stretch(np.maximum(zero[slots] - (1 - y), 0), np.maximum(one[slots] - y, 0))
                    x = np.concatenate([st, np.ones((1, len(g)), np.float32)]).T.astype(np.float64)
                    p = _squash((w[gate] * x).sum(1))
                    for i in np.unique(gate):
                        at = gate == i
                        grad[i] += x[at].T @ (c[at] * (y[at] - p[at]))
                        hess[i] += (x[at].T * (c[at] * p[at] * (1 - p[at]))) @ x[at]
            v = np.concatenate([grad.ravel(), hess.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v))), pa.array(v)], ["i", "v"])

        return run

    w = start.copy()
    for _ in range(STEPS):
        total = np.zeros(32 * k * (k + 1))
        for r in grams.mapInArrow(sums_at(w), "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # 1,344 numbers
            total[r.i] = r.v
        grad, hess = total[: 32 * k].reshape(32, k), total[32 * k :].reshape(32, k, k)
        move = np.linalg.solve(hess + RIDGE * np.eye(k), (grad - RIDGE * (w - start))[..., None])[..., 0]
        w = w + move / np.maximum(1.0, np.abs(move).max(1, keepdims=True))  # no weight moves by more than 1 a step
        if np.abs(move).max() < 1e-3:
            break
    m.w = w.astype(np.float32)
    return m


def _fit_seen(blocks: DataFrame, table: np.ndarray) -> tuple[Mixer, float]:
    """Weights of *seen?* and the rate of its adaptive refinement on all training texts: each block's weights after one
    online pass over them, averaged over the blocks by the decisions of their gates; the rate with the least loss."""
    shared = blocks.sparkSession.sparkContext.broadcast(table)
    width = SEEN_K + 2  # of a gate: its decisions, and its weights times these

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            for payload in b.column("payload"):
                rb = unpack_table(payload.as_py())
                m, n, loss = Mixer(GATES, SEEN_K + 1), np.zeros(GATES), np.zeros(len(RATES))
                for _, buf, off in text_steps([rb.filter(rb.column("fit"))], "text"):
                    tk = tokens(buf, off)
                    st = _seen_inputs(tk, table)
                    m.learn(st, tk["gate"], tk["seen"].astype(np.float32))
                    n += np.bincount(tk["gate"], minlength=GATES)
                    x = m.logit(st, tk["gate"])
                    run_error = _running_error(tk, x)
                    for i, rate in enumerate(RATES):
                        z = x + rate * run_error
                        loss[i] += np.logaddexp(0, np.where(tk["seen"], -z, z)).sum()
                v = np.concatenate([np.concatenate([n[:, None], n[:, None] * m.w], axis=1).ravel(), loss])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v))), pa.array(v)], ["i", "v"])
                pa.default_memory_pool().release_unused()  # a worker lives on after the task

    v = np.zeros(GATES * (width + 1) + len(RATES))
    for r in blocks.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # a few hundred numbers
        v[r.i] = r.v
    by_gate, loss = v[: GATES * (width + 1)].reshape(GATES, width + 1), v[GATES * (width + 1) :]
    m = Mixer(GATES, SEEN_K + 1)
    some = by_gate[:, 0] > 0
    m.w[some] = (by_gate[some, 1:] / by_gate[some, :1]).astype(np.float32)
    return m, RATES[int(np.argmin(loss))]


def _next_counts(got: DataFrame) -> np.ndarray:
    """Counts of 0 and 1 of all slots of *which?*: a table of fixed size, summed in parts by Spark."""
    width = 2 << NEXT_SHARD

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for x in t["word"]:
            total += np.frombuffer(pa.decompress(x.as_buffer(), width * 4, "zstd"), np.int32)
        return pa.table({"h": t["h"].slice(0, 1), "word": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    out = np.zeros((1 << NEXT_BITS - NEXT_SHARD, width), np.float32)
    for r in got.where("kind = 2").select("h", "word").groupBy("h").applyInArrow(add, "h long, word binary").toArrow().to_pylist():
        out[r["h"]] = np.frombuffer(r["word"], np.float32)
    return out.reshape(-1, 2)


def _code_mass(words: DataFrame) -> np.ndarray:
    """Occurrences in training texts of all tokens with a code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CODE, np.int64)
        for rb in batches:
            np.add.at(total, codes(rb.column("h").to_numpy().view(np.uint64)), rb.column("c").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["code", "c"])

    out = np.zeros(1 << CODE)
    for r in words.select("h", "c").mapInArrow(run, "code long, c long").groupBy("code").agg(F.sum("c").alias("c")).collect():  # 4096 rows
        out[r.code] = r.c
    return out


def _fit_next(blocks: DataFrame, table: np.ndarray) -> np.ndarray:
    """Weights of *which?* on all training texts, a row for each gate, each decision left out of its own counts: those of
    each block after one online pass over them, averaged over the blocks by their decisions."""
    shared = blocks.sparkSession.sparkContext.broadcast(table)
    gates, k = CODE + 1, NEXT_K + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            for payload in b.column("payload"):
                rb = unpack_table(payload.as_py())
                w, n = Mixer(gates, NEXT_K).w, np.zeros(gates)
                for _, buf, off in text_steps([rb.filter(rb.column("fit"))], "text"):
                    tk = tokens(buf, off)
                    for g, (slots, i, y) in enumerate(next_decisions(tk, expected(tk))):
                        x = _next_inputs(table, slots, y, np.ones(len(y), bool))
                        for a in range(0, len(y), 1024):
                            z = x[:, a : a + 1024]
                            w[g] += np.float32(0.02 * 8 / np.sqrt(z.shape[1])) * (z @ (y[a : a + 1024] - _squash(w[g] @ z)))
                        n[g] += len(y)
                v = np.concatenate([n[:, None], n[:, None] * w], axis=1).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v))), pa.array(v)], ["i", "v"])
                pa.default_memory_pool().release_unused()  # a worker lives on after the task

    v = np.zeros(gates * (k + 1))
    for r in blocks.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # 65 numbers
        v[r.i] = r.v
    by_gate = v.reshape(gates, k + 1)
    w = Mixer(gates, NEXT_K).w
    some = by_gate[:, 0] > 0
    w[some] = by_gate[some, 1:] / by_gate[some, :1]
    return w


def context_mixing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every document."""
    fold = F.crc32(docs[id_col].cast("string").cast("binary")) % 5
    d = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
                    F.coalesce(fold != 1, F.lit(True)).alias("fit"))
    kind = d.schema["doc_id"].dataType.simpleString()
    blocks = write_blocks(d, "text", BLOCK)
    got = materialize(_gather(blocks), "gathered")
    words = got.where("kind = 0").groupBy("h").agg(F.sum("c").alias("c"), F.first("word").alias("word"))
    words = materialize(words, "words")
    n, v = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    singles = words.where("c = 1").count()
    sl = got.where("kind = 1").groupBy("h").agg(F.sum("c").alias("c"), F.sum("c1").alias("c1")).toArrow()  # fixed table
    zero, one = np.zeros(SEEN_K << SEEN_BITS, np.float32), np.zeros(SEEN_K << SEEN_BITS, np.float32)
    zero[sl["h"].to_numpy()], one[sl["h"].to_numpy()] = sl["c"].to_numpy(), sl["c1"].to_numpy()
    seen_table = _stretch(zero, one)
    news = float(zero[: 1 << SEEN_BITS].sum())  # decisions "not seen": every one is in one slot of the first context
    types = words.where("c > 0 and length(word) > 0").select("word")
    pairs = _spell_pairs(types)
    s0, s1 = _spell_counts(pairs)
    model = {"seen": seen_table, "spell": _stretch(s0, s1), "spell_w": _fit_spelling(pairs, s0, s1).w,
             "unknown": (singles + 1.0) / (news + 2.0)}
    mixer, model["rate"] = _fit_seen(blocks, seen_table)
    model["seen_w"] = mixer.w
    model["next"] = next_table(_next_counts(got))
    model["next_w"] = _fit_next(blocks, model["next"])
    model["mass"] = _code_mass(words)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    answers = got.where("kind = 0").select("block", "h").join(words.select("h", "c"), "h").select("block", "h", "c")
    answers = pack_answers(answers, "h", "c", np.uint64, np.int64)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        m = shared.value
        keys, count = unpack_answers(right, "h", "c", np.uint64, np.int64)
        out = []
        for payload in left["payload"]:
            for part, buf, off in text_steps([unpack_table(payload.as_py())], "text"):
                out.append(_score_slice(part, buf, off, keys, count, m, n, v))
        return pa.Table.from_batches(out)

    schema = f"doc_id {kind}, fit boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"
    r = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    return r.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score",
                    "score", (-F.col("score") * float(np.log2(10.0)) / F.col("n_bytes")).alias("bits_per_byte"))


def _score_slice(part: pa.RecordBatch, buf: np.ndarray, off: np.ndarray, keys: np.ndarray, count: np.ndarray, m: dict,
                 n: int, v: int) -> pa.RecordBatch:
    tk = tokens(buf, off)
    docs, doc, first = len(off) - 1, tk["doc"], tk["first"]
    fit = part.column("fit").to_numpy(zero_copy_only=False).astype(bool)
    c = count[np.searchsorted(keys, tk["h"])].astype(np.float64)
    base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    # seen?
    x = seen_logit(tk, m["seen"], Mixer(0, 1, m["seen_w"]), m["rate"])
    ll = -np.logaddexp(0, np.where(tk["seen"], -x, x))
    # which? each decision of a training document without itself
    mine = fit[doc]
    again, e = tk["seen"], expected(tk)
    bits = np.zeros(len(doc))
    for g, (slots, i, y) in enumerate(next_decisions(tk, e)):
        z = m["next_w"][g] @ _next_inputs(m["next"], slots, y, mine[i])
        bits[i] -= np.logaddexp(0, np.where(y, -z, z))
    others, other_than = tk["t"].astype(np.float64), again.copy()
    others[e["i"]] -= e["count"]
    other_than[e["i"][e["hit"]]] = False
    ll[again] += bits[again]
    ll[other_than] += np.log(tk["rank"][other_than] / others[other_than])
    # known? without the document's own occurrences
    other = c - np.where(mine, tk["tf"], 0)
    new = ~again
    known = new & (other > 0)
    unknown = new & ~known
    news, unk = np.concatenate(([0], np.cumsum(new))), np.concatenate(([0], np.cumsum(unknown)))
    before, before_u = news[:-1] - news[first[doc]], unk[:-1] - unk[first[doc]]
    p_unknown = (before_u + 4 * m["unknown"]) / (before + 4)
    ll[unknown] += np.log(p_unknown[unknown])
    ll[known] += np.log1p(-p_unknown[known])
    # the tokens with its code, less those that the document has had
    code = codes(tk["h"])
    by = np.argsort(doc << CODE | code, kind="stable")
    cut = np.concatenate(([True], np.diff((doc << CODE | code)[by]) != 0)) if len(by) else np.zeros(0, bool)
    start = np.flatnonzero(cut)
    size = np.diff(np.append(start, len(by)))
    mass = np.concatenate(([0.0], np.cumsum(np.where(new, np.maximum(other, 0), 0)[by])))
    rest = np.empty(len(by))
    rest[by] = np.repeat(mass[start], size) - mass[:-1] - np.where(mine[by], np.repeat(size, size), 0)
    rest += m["mass"][code]
    ll[known] += bits[known] + np.log(other[known] / np.maximum(rest[known], other[known]))
    at = np.full(len(doc), -1, np.int64)
    at[tk["at"]] = np.arange(len(tk["at"]))
    some = np.flatnonzero(unknown)
    low = _lower(buf)
    s, e = tk["ws"], tk["we"]
    ll[some] += spell_log([low[s[i] : e[i]] if i >= 0 else b"" for i in at[some]], m["spell"], Mixer(0, 1, m["spell_w"]))
    per = lambda w: np.bincount(doc, weights=w, minlength=docs)
    size = np.diff(first)
    bytes_ = per(np.where(at >= 0, (e - s)[np.maximum(at, 0)] + 1 if len(s) else 1, 1)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), part.column("fit"), pa.array(size.astype(np.int64)), pa.array(per(c > 0).astype(np.int64)),
         pa.array(per(base)), pa.array(per(ll) / LOG10), pa.array(bytes_)],
        ["doc_id", "fit", "n_tokens", "n_known", "base_score", "score", "n_bytes"])


def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing(spark.read.parquet(f"{sf_dir}/documents.parquet"))
