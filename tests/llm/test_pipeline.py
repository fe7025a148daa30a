import corpus_pipeline
import pytest

import __spark_entry__ as E
from tempest.session import materialize

from .conftest import odd_rows, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The small documents with cases of known outcome, and the other tables, in a folder of their own."""
    root = tmp_path_factory.mktemp("sf")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = [r.text for r in docs.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where(
        "lang = 'en' and toxic = 0 and quality = 1 and n_chars between 800 and 3000").orderBy("doc_id").limit(3).collect()]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(10_001, clean[0] + " end"), (10_002, " ".join(clean[1].split()[::-1]) + " " + item), (10_003, "%$# @@ || 00 ~~ " * 60),
            (10_004, " ".join(clean[2].split()[::-1]))]
    extra = spark.createDataFrame([(i, t, "en", "src1", len(t)) for i, t in rows], docs.schema)
    docs.unionByName(extra).write.parquet(f"{root}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{root}/{t}.parquet")
    return str(root)


def test_stages_take_effect(spark, planted):
    out = spark.read.parquet(f"{planted}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        before = out
        out = materialize(stage(spark, out, planted), "t")
        if name != "packing":
            assert out.columns == before.columns
            assert out.exceptAll(before).isEmpty()  # rows go, none changes
        left[name] = {r.doc_id for r in out.select("doc_id").collect()}
    assert 10_003 in left["toxicity"] and 10_003 not in left["quality"]
    assert 10_001 in left["quality"] and 10_001 not in left["near_duplicates"]
    assert 10_002 in left["near_duplicates"] and 10_002 not in left["decontaminate"]
    assert left["packing"] == left["decontaminate"]
    assert len(left["decontaminate"]) > 0.5 * len(left["quality"])


def test_run_is_registered_and_odd_rows_pass(spark, odd, odd_labels, tmp_path):
    assert E.queries()["pipeline"] is corpus_pipeline.run
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    odd.select(cols).write.parquet(f"{tmp_path}/documents.parquet")
    odd_labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {r[0] for r in odd_rows()}
    assert sum(r.doc_id == 2 for r in got) == 0  # a copy of 1


def test_every_operator_is_registered_once():
    names = [k for k in E.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert words(1, 3)
