import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from tempest.llm import op7_quality_model as op7
from tempest.llm.answers import answer, ask, distinct_keys, in_order, pack_keys, unpack_keys
from tempest.llm.blocks import pack_answers, unpack_answers, unpack_table, write_blocks
from tempest.llm.textops import text_buffer

from .conftest import odd_rows, words

ORDER = op7.ORDER
PAD = bytes(ORDER - 1)


def brute_model(texts):
    """Interpolated modified Kneser-Ney over bytes with plain dictionaries."""
    counts = {ORDER: Counter()}
    for t in texts:
        b = PAD + t.encode()
        counts[ORDER].update(b[i - ORDER + 1 : i + 1] for i in range(ORDER - 1, len(b)))
    for k in range(ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    disc, ctx = {}, {}
    for k, c in counts.items():
        n = Counter(c.values())
        n1, n2, n3, n4 = n[1], n[2], n[3], n[4]
        if n1 and n2:
            y = n1 / (n1 + 2 * n2)
            d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
            disc[k] = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]
        else:
            disc[k] = [0.5, 0.75, 0.9]
        ctx[k] = defaultdict(lambda: [0, 0.0])
        for g, v in c.items():
            ctx[k][g[:-1]][0] += v
            ctx[k][g[:-1]][1] += disc[k][min(v, 3) - 1]

    def p(g):
        k = len(g)
        low = p(g[1:]) if k > 1 else 1 / 256
        if g[:-1] not in ctx[k]:
            return low
        total, cuts = ctx[k][g[:-1]]
        v = counts[k].get(g, 0)
        return (max(v - disc[k][min(v, 3) - 1], 0) if v else 0) / total + cuts / total * low

    return p


def test_grams_end_at_each_byte_and_do_not_cross_documents():
    buf, off = text_buffer(pa.array(["ab", "", "cdefgh"]))
    g = [int(x).to_bytes(ORDER, "big") for x in op7.grams(buf, off)]
    assert g == [(PAD + t[:i]).rjust(9)[-ORDER:] for t in (b"ab", b"cdefgh") for i in range(1, len(t) + 1)]


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, words(i % 40, 30) + f" no {i}", "en" if i % 3 else "de") for i in range(150)] + [(900, "@@@@ ### 0000 ||||" * 8, "en"), (901, "zz", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(150) if i % 2], "doc_id long, quality int")
    return rows, docs, labels


def test_log_probabilities_equal_brute_force(spark, small):
    rows, docs, labels = small
    scored = op7.perplexities(docs, op7.trusted_ids(labels)).collect()
    import zlib

    fit = [t for i, t, _ in rows if i < 150 and i % 2 and zlib.crc32(str(i).encode()) % 5]
    assert sum(x._fit for x in scored) == len(fit)
    p = brute_model(fit)
    by = {i: t for i, t, _ in rows}
    for x in scored:
        b = PAD + by[x.doc_id].encode()
        want = sum(math.log(p(b[i - ORDER + 1 : i + 1])) for i in range(ORDER - 1, len(b)))
        assert x._lp == pytest.approx(want, rel=1e-9) and x._bytes == len(b) - ORDER + 1
    assert abs(sum(p(b"ren "[-ORDER + 1 :] + bytes([c])) for c in range(256)) - 1) < 1e-9


def test_junk_goes_and_clean_text_stays(small):
    _, docs, labels = small
    v = {x.doc_id: x for x in op7.verdicts(op7.perplexities(docs, op7.trusted_ids(labels))).collect()}
    assert not v[900]._kept
    assert np.mean([v[i]._kept for i in range(150)]) > 0.98
    assert v[901]._kept  # two bytes decide nothing


def test_odd_rows_no_trust_and_empty_tables(spark, odd, no_docs, odd_labels):
    out = op7.verdicts(op7.perplexities(odd, op7.trusted_ids(odd_labels), keep_text=True))
    got = out.collect()
    assert len(got) == len(odd_rows()) and set(odd.columns) <= set(out.columns)
    assert all(x._kept for x in got if not (x.text or "").strip())
    free = op7.verdicts(op7.perplexities(odd, op7.trusted_ids(odd_labels.where("false")))).collect()
    assert len(free) == len(odd_rows()) and all(x._kept and x._perplexity is None for x in free)
    assert op7.verdicts(op7.perplexities(no_docs, op7.trusted_ids(odd_labels))).collect() == []


def test_most_labelled_junk_goes(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    scored = op7.perplexities(spark.read.parquet(f"{sf}/documents.parquet"), op7.trusted_ids(labels))
    v = op7.verdicts(scored).join(labels, "doc_id").collect()
    assert np.mean([not x._kept for x in v if x.quality == 0]) > 0.9
    assert np.mean([not x._kept for x in v if x._trusted and not x._fit]) < 0.01


def test_answers_keep_their_keys_in_planes(spark):
    keys = [0, 1, 255, 256, 2**40 - 1, 2**39 + 7]
    rows = spark.createDataFrame([(i % 2, k, k / 2) for i, k in enumerate(keys * 3)], "block long, g long, lp double").repartition(2)
    t = pack_answers(rows, "g", "lp", np.int64, np.float64, planes=True).toArrow()
    for b in (0, 1):
        g, lp = unpack_answers(t.filter(pa.compute.equal(t["block"], b)), "g", "lp", np.int64, np.float64, planes=True)
        assert g.tolist() == sorted(keys[b::2] * 3) and lp.tolist() == [k / 2 for k in g.tolist()]


def test_a_language_that_the_model_has_not_learnt_is_kept(spark, small):
    _, docs, labels = small
    other = str.maketrans("thenorisa", "QXZWKJVYB")
    rows = [(2000 + i, words(i, 30).translate(other), "xx" if i % 2 else None) for i in range(60)]
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    for n in (0, 10):
        few = spark.createDataFrame([(2000 + i, 1) for i in range(n)], labels.schema)
        v = {x.doc_id: x for x in op7.verdicts(op7.perplexities(docs, op7.trusted_ids(labels.union(few)))).collect()}
        assert all(v[i]._kept and v[i]._threshold is None and v[i]._perplexity is not None for i, _, _ in rows)
        assert not v[900]._kept and v[1]._threshold is not None


def test_values_return_in_the_order_of_the_keys(spark):
    docs = spark.createDataFrame([(i, words(i % 7, 40)) for i in range(60)] + [(99, ""), (98, None)], "doc_id long, text string").repartition(4)
    blocks = write_blocks(docs, block_bytes=1500)
    asked = ask(blocks, lambda rb: np.unique(np.array([int.from_bytes(w.encode()[:7]) for t in rb["text"].to_pylist() for w in (t or "").split()], np.int64)), 5)
    keys = distinct_keys(asked, "g")
    got = answer(asked, keys.selectExpr("shard", "g", "g / 8D as lp"), "g", "lp").toArrow()
    want = {int.from_bytes(w.encode()[:7]) for r in docs.collect() for w in (r.text or "").split()}
    assert sorted(r.g for r in keys.collect()) == sorted(want) and blocks.count() > 4
    for r in blocks.collect():
        words_of = [w for t in unpack_table(bytes(r.payload))["text"].to_pylist() for w in (t or "").split()]
        g = np.unique(np.array([int.from_bytes(w.encode()[:7]) for w in words_of], np.int64))
        assert in_order(g, got.filter(pa.compute.equal(got["block"], r.block)), 5).tolist() == (g / 8).tolist()


def test_packed_keys_return():
    for k in ([], [5], [0, 1, 2**40 - 1, 2**62], [-(2**63), -1, 0, 2**63 - 1]):
        k = np.array(k, np.int64)
        assert unpack_keys(pack_keys(k)).tolist() == k.tolist()


def test_columns_with_the_names_of_the_operator(spark, small):
    rows, docs, labels = small
    clash = ["_id", "_id0", "_lang0", "_l", "_t", *op7.OWN]
    wide = docs.selectExpr("*", *[f"'{c}' as {c}" for c in clash])
    kept = op7.without_low_quality(wide, op7.trusted_ids(labels)).collect()
    plain = op7.verdicts(op7.perplexities(docs, op7.trusted_ids(labels))).where("_kept").collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in plain} and 900 not in {r.doc_id for r in kept}
    assert all(r[c] == c for r in kept for c in clash) and kept[0].text is not None
    v = op7.verdicts(op7.perplexities(wide, op7.trusted_ids(labels))).collect()
    assert {r.doc_id: r._perplexity for r in v}.keys() == {r[0] for r in rows} and all(r._id == "_id" for r in v)


def test_every_trusted_label_is_learnt_from(spark):
    labels = spark.range(60_000).selectExpr("id as doc_id", "1 as quality")
    ids = op7.trusted_ids(labels.union(labels))
    assert ids.count() == 60_000
    docs = spark.createDataFrame([(i * 997, words(i, 20), "en") for i in range(60)] + [(None, "no id", "en"), (70_000, words(1, 9), "en")],
                                 "doc_id long, text string, lang string").repartition(3)
    got = op7.perplexities(docs, ids).collect()
    fit = {i * 997 for i in range(60) if zlib.crc32(str(i * 997).encode()) % 5}
    assert {x.doc_id for x in got if x._fit} == fit and sum(x._trusted for x in got) == 60 and len(got) == 62
