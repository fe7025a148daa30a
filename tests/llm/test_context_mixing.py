import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tempest.llm import op5_context_mixing as op5
from tempest.llm.blocks import unpack_table, write_blocks
from tempest.llm.textops import text_buffer

from .conftest import odd_rows, words


def toks(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def test_counts_and_base_equal_brute_force(spark, odd):
    rows = odd_rows() + [(100 + i, words(i % 7, 40 + i), "en", "s", 0, *odd_rows()[0][5:]) for i in range(40)]
    df = spark.createDataFrame(rows, odd.schema).repartition(3)
    got = op5.context_mixing(df).collect()
    fold = {x[0]: None if x[0] is None else zlib.crc32(str(x[0]).encode()) % 5 for x in rows}
    c = Counter(w for x in rows if fold[x[0]] != 1 for w in toks(x[1]))
    n, v = sum(c.values()), len(c)
    want = sorted((x[0] or 0, fold[x[0]] == 1, len(t := toks(x[1])), sum(c[w] > 0 for w in t), n) for x in rows)
    assert sorted((x.doc_id or 0, x.held_out, x.n_tokens, x.n_known, x.train_tokens) for x in got) == want
    base = {x[0]: sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in toks(x[1])) for x in rows}
    for x in got:
        assert x.base_score == pytest.approx(base[x.doc_id], rel=1e-9)
        assert math.isfinite(x.score) and x.score < 0 and x.bits_per_byte > 0


def test_spelling_is_a_probability(spark):
    r = np.random.default_rng(1)
    table = op5._stretch(r.integers(0, 50, 1 << op5.SPELL_BITS).astype(np.float32), r.integers(0, 50, 1 << op5.SPELL_BITS).astype(np.float32))
    m = op5.Mixer(32, op5.ORDERS)
    total = 0.0
    for c in range(256):  # every next byte after "ab": the bits' probabilities sum to one
        data = np.frombuffer(b"ab" + bytes([c]), np.uint8)
        ll = 0.0
        for slots, gate, bit, _ in op5.spell_bits(data, np.array([0, 3])):
            x = m.logit(table[slots[:, 2:]], gate[2:])
            ll += float(-np.logaddexp(0, np.where(bit[2:] == 1, -x, x))[0])
        total += math.exp(ll)
    assert total == pytest.approx(1, abs=1e-5)


def test_token_stream(spark):
    buf, off = text_buffer(pa.array(["a B a b a", "", "A"]))
    tk = op5.tokens(buf, off)
    assert tk["doc"].tolist() == [0] * 6 + [1] + [2] * 2
    assert tk["t"].tolist() == [0, 1, 2, 3, 4, 5, 0, 0, 1]
    assert tk["rank"].tolist() == [0, 0, 1, 1, 2, 0, 0, 0, 0]
    assert tk["tf"].tolist() == [3, 2, 3, 2, 3, 1, 1, 1, 1]
    assert tk["h"][0] == tk["h"][7] and tk["h"][5] == tk["h"][6] == op5.END_HASH


def test_mixing_learns_and_beats_the_base_on_repeating_text(spark):
    rows = [(i, " ".join(words(i % 11, 60).split() * 2)) for i in range(120)]
    got = op5.context_mixing(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    held = [x for x in got if x.held_out]
    assert held and sum(x.score for x in held) > sum(x.base_score for x in held)


def test_empty_tables_and_no_training(spark, no_docs):
    assert op5.context_mixing(no_docs).collect() == []
    only = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    got = op5.context_mixing(spark.createDataFrame([(i, "some words here") for i in only], "doc_id long, text string")).collect()
    assert [x.n_known for x in got] == [0] * 3 and all(math.isfinite(x.score) for x in got)


def test_seen_weights_are_those_of_every_training_text(spark):
    """The fit by blocks, against a plain loop over all of them (more texts than the 20,000 that a sample once held)."""
    docs = spark.range(21_000).selectExpr("id as doc_id", "if(id < 20000, 'a b a', repeat(concat('w', id % 7, ' x x '), 4)) as text", "id % 5 != 1 as fit").repartition(2)
    blocks = write_blocks(docs, "text", 1 << 15)
    table = np.random.default_rng(2).normal(size=op5.SEEN_K << op5.SEEN_BITS).astype(np.float32)
    n, w = 0, 0
    for b in blocks.collect():
        rb = unpack_table(bytes(b.payload))
        tk = op5.tokens(*text_buffer(rb.filter(rb.column("fit")).column("text")))
        m = op5.Mixer(op5.GATES, op5.SEEN_K + 1)
        m.learn(op5._seen_inputs(tk, table), tk["gate"], tk["seen"].astype(np.float32))
        c = np.bincount(tk["gate"], minlength=op5.GATES)[:, None]
        n, w = n + c, w + c * m.w
    got, rate = op5._fit_seen(blocks, table)
    some = n[:, 0] > 0
    assert blocks.count() > 2 and n.sum() == docs.where("fit").selectExpr("sum(size(split(trim(text), ' ')) + 1)").first()[0]
    assert np.allclose(got.w[some], (w / np.maximum(n, 1))[some], atol=1e-6) and rate in op5.RATES


def test_spelling_weights_are_those_of_every_word_type(spark):
    """Counted pairs give the gradient of a plain loop over all types (more than the 40,000 that a sample once held)."""
    types = spark.range(45_000).selectExpr("cast(concat('t', lower(hex(id * 7919))) as binary) as word").repartition(3)
    words_ = sorted(bytes(r.word) for r in types.collect())
    pairs = op5._spell_pairs(types)
    zero, one = op5._spell_counts(pairs)
    assert int(pairs.selectExpr("sum(c)").first()[0]) == sum(len(w) + 1 for w in words_)
    assert zero.sum() + one.sum() == 8 * op5.ORDERS * sum(len(w) + 1 for w in words_)
    m = op5._fit_spelling(pairs, zero, one)
    start = op5.Mixer(32, op5.ORDERS).w
    grads, loss = np.zeros((2, *m.w.shape)), [0.0, 0.0]
    for slots, gate, bit, _ in op5.spell_bits(words_):
        y = bit.astype(np.float32)
        st = op5._stretch(np.maximum(zero[slots] - (1 - y), 0), np.maximum(one[slots] - y, 0))
        for i, w in enumerate((start, m.w)):
            z = op5.Mixer(32, op5.ORDERS, w).logit(st, gate)
            np.add.at(grads[i], gate, (y - op5._squash(z))[:, None] * np.concatenate([st, np.ones((1, len(y)))]).T)
            loss[i] += np.logaddexp(0, np.where(bit == 1, -z, z)).sum()
    # nearly flat at the weights found, on every type
    assert np.abs(grads[1] - op5.RIDGE * (m.w - start)).max() < 0.01 * np.abs(grads[0]).max() and loss[1] < loss[0]


def test_the_words_before_a_word_change_its_cost(spark):
    """Texts in which every word has its few followers, against the same words in any order."""
    r = random.Random(4)
    vocab = [f"w{k}" for k in range(400)]
    after = {w: r.sample(vocab, 3) for w in vocab}

    def text(n):
        out = [r.choice(vocab)]
        while len(out) < n:
            out.append(r.choice(after[out[-1]]))
        return out

    fit = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 5 != 1][:600]
    held = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 5 == 1][:60]
    rows = [(i, " ".join(text(90))) for i in fit]
    for a, b in zip(held[::2], held[1::2]):
        ws = text(90)
        rows += [(a, " ".join(ws)), (b, " ".join(r.sample(ws, len(ws))))]
    got = {x.doc_id: x.score for x in op5.context_mixing(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[b] for b in held[1::2]) < 1.1 * sum(got[a] for a in held[::2]) < 0


def test_which_token_is_a_code(spark):
    """Over a closed vocabulary the chances of every next token sum to one: what followed, other seen tokens, known ones."""
    buf, off = text_buffer(pa.array(["a b c a b a"] * 2))
    tk = op5.tokens(buf, off)
    e = op5.expected(tk)
    got = {(int(tk["doc"][i]), int(tk["t"][i])): (bool(h), int(c)) for i, h, c in zip(e["i"], e["hit"], e["count"])}
    # after the second "a": "b", had once; after the second "b": "c", had once; after the third "a": "b", had twice
    assert got == {(d, t): x for d in (0, 1) for t, x in {4: (True, 1), 5: (False, 1), 6: (False, 2)}.items()}
    r = np.random.default_rng(3)
    counts = r.integers(0, 60, (1 << op5.NEXT_BITS, 2)).astype(np.float32)
    table, w = op5.next_table(counts), r.normal(size=(op5.CODE + 1, op5.NEXT_K + 1))
    vocab = [f"v{k}" for k in range(30_000)]
    buf, off = text_buffer(pa.array([f"x y {v}" for v in vocab]))
    tk = op5.tokens(buf, off)
    bits = np.zeros(len(tk["doc"]))
    for g, (slots, i, y) in enumerate(op5.next_decisions(tk, op5.expected(tk))):
        z = w[g] @ op5._next_inputs(table, slots, y, np.zeros(len(y), bool))
        bits[i] -= np.logaddexp(0, np.where(y, -z, z))
    third = tk["t"] == 2
    one = dict(zip(op5.codes(tk["h"][third]).tolist(), bits[third].tolist()))
    assert len(one) > 0.99 * (1 << op5.CODE) and sum(math.exp(x) for x in one.values()) == pytest.approx(1, abs=0.01)
