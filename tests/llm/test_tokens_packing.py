import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tempest.llm import op2_packing as op2
from tempest.llm import op3_token_counts as op3
from tempest.llm.pieces import encode_long
from tempest.session import materialize

from .conftest import odd_rows, words

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def ids_of(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library(spark, odd, tok):
    r = op3.count_tokens(odd, PATH, chunk=20_000, overlap=200)
    assert r.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((x.doc_id or 0, x.n_bytes, x.n_tokens, x.over_limit) for x in r.collect())
    want = sorted((x[0] or 0, len((x[1] or "").encode()), n := len(ids_of(tok, x[1])), n > 2048) for x in odd_rows())
    assert got == want


def test_pieces_equal_the_library_on_random_unicode(tok):
    from tempest.llm.pieces import PieceEncoder
    from tempest.llm.textops import text_buffer
    import pyarrow as pa

    r = random.Random(4)
    alphabet = list("abcXYZ019 \t\n\r\x0b\x0c\x1c\x85.,-'<|>*$#éèÉßÿ×÷ÀñḈ 　ªºσςΣİıDŽ数한é😀'") + ["'s", "'re", "<|startoftext|>", "<|ENDOFTEXT|>", "  "]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    enc = PieceEncoder(PATH)
    ids, at = enc.ids(*text_buffer(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == ids_of(tok, t), repr(t)


@pytest.mark.parametrize("chunk,overlap", [(300, 20), (500, 3), (997, 64), (5000, 400)])
def test_resynchronised_chunks_equal_the_whole(tok, chunk, overlap):
    for text in (words(9, 3000), "a" * 2500 + " " + words(2, 300), "it's <|endoftext|> 12 é " * 400, "x y" * 10):
        events = []
        got = np.concatenate(list(encode_long(tok, text, chunk, overlap, events.append)))
        assert got.tolist() == ids_of(tok, text)
        if len(text) > 2 * chunk:
            assert events


def test_overlap_widens_and_joins_where_nothing_aligns(tok):
    events = []
    text = "b" * 3000 + " " + words(6, 500)
    got = np.concatenate(list(encode_long(tok, text, 400, 10, events.append)))
    assert got.tolist() == ids_of(tok, text)
    assert {"widen", "joined", "splice"} <= set(events)


def check_packing(rows, docs, tok):
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id or 0, r.piece), []).append(r)
    want = []
    for x in docs:
        ids = np.array([*ids_of(tok, x[1]), 0], "<u4")
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            want.append((x[0] or 0, k, a, len(part), zlib.crc32(part.tobytes())))
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seqs.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 2048
    return seqs


def test_packing_round_trip(spark, odd, tok):
    rows = op2.pack_documents(odd, PATH).collect()
    seqs = check_packing(rows, odd_rows(), tok)
    assert len(seqs) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_tree_of_small_nodes_packs_nearly_as_well_as_one(spark):
    r = random.Random(1)
    sizes = [r.randint(1, 2047) for _ in range(3000)]
    rows = [(i, 0, 0, s, 0, i) for i, s in enumerate(sizes)]
    d = materialize(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, uid long").repartition(7), "t")
    got = op2.pack(d, group_items=40, fan_in=3).collect()
    assert len(got) == 3000
    seqs = {}
    for x in got:
        seqs.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for places in seqs.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 2048
    one = len(op2.best_fit(np.array(sizes), 2048)[2])
    assert len(seqs) <= 1.08 * one  # nodes of 40 items; a bin is never opened again


def test_best_fit_takes_the_tightest_bin():
    b, place, fill = op2.best_fit(np.array([6, 5, 3, 4, 2]), 10)
    assert fill.tolist() == [10, 10]
    assert sorted(zip(b.tolist(), place.tolist())) == [(0, 0), (0, 6), (1, 0), (1, 5), (1, 8)]


def test_empty_tables(spark, no_docs):
    assert op3.count_tokens(no_docs, PATH).collect() == []
    assert op2.pack_documents(no_docs, PATH).collect() == []


def test_queries_read_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert op3.op3_token_counts(spark, sf).count() == n
    assert op2.op2_packing(spark, sf).select(F.countDistinct("doc_id")).first()[0] == n


def test_counted_best_fit_is_best_fit():
    r = random.Random(8)
    for capacity, n in ((10, 300), (60, 2000), (2048, 500), (2048, 5000)):
        sizes = np.array([r.choice((r.randint(1, capacity - 1), capacity // 2 + 1, capacity // 3)) for _ in range(n)])
        runs = op2.best_fit_counted({int(s): int(c) for s, c in zip(*np.unique(sizes, return_counts=True))}, capacity)
        bins = {}
        for size, rank, k, per, b, place in runs.tolist():
            for i in range(k):
                bins.setdefault(b + i, []).extend((place + j * size, size) for j in range(per))
        assert sorted(s for x in bins.values() for _, s in x) == sorted(sizes.tolist())
        for x in bins.values():
            ends = np.cumsum([s for _, s in sorted(x)])
            assert [o for o, _ in sorted(x)] == [0, *ends[:-1]] and ends[-1] <= capacity
        assert sorted(sum(s for _, s in x) for x in bins.values()) == sorted(op2.best_fit(sizes, capacity)[2].tolist())


def test_every_underfull_bin_travels(spark):
    """Bins that no node can fill go up to the root all the same, more of them than one node takes."""
    up = op2._pack(np.arange(30_000), np.full(30_000, 1500), 0, 2048, 8, False)
    assert sum(up.column("up").to_pylist()) == 30_000  # 20,000 once
    sizes = [1100 + i % 7 for i in range(400)] + [500 + i % 90 for i in range(23)]  # long ones, then the few that fit with them
    rows = [(i, 0, 0, s, 0, i) for i, s in enumerate(sizes)]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"
    d = materialize(spark.createDataFrame(rows, schema).repartitionByRange(9, "uid"), "t")
    for group in (20, 40, 1000):
        got = op2.pack(d, group_items=group, fan_in=3).collect()
        assert sorted(x.length for x in got) == sorted(sizes)
        seqs = {}
        for x in got:
            seqs.setdefault(x.sequence_id, []).append((x.offset, x.length))
        for places in seqs.values():
            ends = np.cumsum([n for _, n in sorted(places)])
            assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
        assert len(seqs) <= 408
        assert any(x.sequence_id < 0 for x in got) == (group < 400)  # 1000 are one node
