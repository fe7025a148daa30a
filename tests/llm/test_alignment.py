import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tempest.llm import op11_alignment as op11

from .conftest import odd_rows, words

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    """[(doc_id, text)] → the result's rows, with another library for A and plain loops."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    docs, held = [], Counter()
    for i, text in rows:
        a, b = (enc.encode_ordinary(" " + text), sp.encode(text)) if text else ([], [])
        a_bytes = [enc.decode_single_token_bytes(x) for x in a]
        b_bytes = [bytes([int(sp.id_to_piece(x)[3:5], 16)]) if sp.is_byte(x) else sp.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            a, b, a_bytes, b_bytes = [], [], [], []
        ranges = []
        for toks in (a_bytes, b_bytes):
            at, out = 0, []
            for x in toks:
                out.append((at, at + len(x)))
                at += len(x)
            ranges.append(out)
        links, k = [], 0
        for x, (s, e) in zip(a, ranges[0]):
            while k and ranges[1][k][0] > s:
                k -= 1
            while ranges[1][k][1] <= s:
                k += 1
            for y, (t, f) in zip(b[k:], ranges[1][k:]):
                if t >= e:
                    break
                links.append((x, y))
        both = {e for _, e in ranges[0]} & {e for _, e in ranges[1]}
        groups = defaultdict(lambda: ([], []))
        for side in (0, 1):
            g = 0
            for x, (_, e) in zip((a, b)[side], ranges[side]):
                groups[g][side].append(str(x))
                g += e in both
        text_form = ";".join(",".join(x) + "|" + ",".join(y) for _, (x, y) in sorted(groups.items()))
        held.update(set(links))
        docs.append((i, len(a), len(b), len(both), links, hashlib.sha256(text_form.encode()).hexdigest() if a else ""))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return [(i, na, nb, g, len(l), sum(held[p] == top[p[0]] for p in l), sum(held[p] for p in l), h) for i, na, nb, g, l, h in docs]


def rows_of(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 300)), st.sets(st.integers(0, 300), min_size=1), st.integers(1, 7))
def test_gallop_is_a_lower_bound(short, long, lanes):
    s, t = np.array(sorted(short), np.int64), np.array(sorted(long), np.int64)
    assert op11.gallop(s, t, lanes).tolist() == np.searchsorted(t, s).tolist()


def test_small_documents_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = op11.align_tokenizers(docs.repartition(3), A, B, block_bytes=20_000)  # many blocks
    assert got.columns == COLS
    assert rows_of(got) == sorted(brute(rows), key=repr)


def test_odd_rows_and_signs(spark, odd):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert rows_of(op11.align_tokenizers(odd, A, B)) == sorted(brute(rows), key=repr)
    r = random.Random(5)
    alphabet = list("abé ñ  \n\t.'▁1  　数한😀́×÷ÀÿÃ") + ["'s", " the", "<|endoftext|>", "<s>", "<0x0A>", "  ", " é"]
    texts = [(i, "".join(r.choice(alphabet) for _ in range(r.randint(0, 30)))) for i in range(1500)]
    got = rows_of(op11.align_tokenizers(spark.createDataFrame(texts, "doc_id long, text string"), A, B))
    want = sorted(brute(texts), key=repr)
    assert got == want
    assert any(x[7] == "" for x in want) and sum(x[1] > 0 for x in want) > 700


def test_cut_units_equal_whole_texts():
    import pyarrow as pa

    from tempest.llm.textops import text_buffer

    two = op11.TwoSpellings(A, B)
    assert two.cuts
    texts = pa.array([words(1, 300), "a b é c", None])
    cut = two.encode(*text_buffer(texts))
    two.cuts = False
    whole = two.encode(*text_buffer(texts))
    assert all((x[0] == y[0]).all() and (x[1] == y[1]).all() for x, y in zip(cut, whole))


def test_empty_table(spark, no_docs):
    assert op11.align_tokenizers(no_docs, A, B).collect() == []


@pytest.mark.parametrize("ids", ["string", "int"])
def test_other_id_types(spark, ids):
    df = spark.createDataFrame([(1, "a b"), (2, "a b")], "doc_id int, text string").selectExpr(f"cast(doc_id as {ids}) doc_id", "text")
    assert [r.count_sum for r in op11.align_tokenizers(df, A, B).collect()] == [4, 4]
