import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempest.llm import op1_toxicity as op1

from .conftest import odd_rows, words

BAD = ["idiot", "scum", "moron", "trash", "loser"]


def documents(n=700):
    r = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        ws, toxic = words(i, r.randint(5, 200)).split(), r.random() < 0.25
        if toxic:
            for _ in range(r.randint(1, 3)):
                ws.insert(r.randrange(len(ws)), r.choice(BAD).upper() + r.choice(["", "!", "***"]))
        rows.append((i, " ".join(ws), r.choice(["en", "de", None])))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def planted(spark):
    rows, labels = documents()
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


@pytest.fixture(scope="module")
def model(planted):
    return op1.train(planted[0], planted[1])


def test_held_out_accuracy(planted, model):
    docs, _, y = planted
    got = op1.score(docs, model).collect()
    held = [x for x in got if x.held_out]
    assert 100 < len(held) < 200
    assert np.mean([x.predicted == y[x.doc_id] for x in held]) > 0.95
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got)


def test_one_insult_in_a_long_text_counts(spark, model):
    base = words(99, 20_000)
    at = len(base) // 2
    df = spark.createDataFrame([(1, base, "en"), (2, base[:at] + " idiot " + base[at:], "en")], "doc_id long, text string, lang string")
    a, b = [x.score for x in op1.score(df, model).orderBy("doc_id").collect()]
    assert b > 0.5 > a


def test_filter_drops_what_the_thresholds_say(planted, model):
    docs, _, _ = planted
    bad = {x.doc_id for x in op1.score(docs, model).where("toxic").collect()}
    assert {r.doc_id for r in op1.without_toxic(docs, model).collect()} == {i for i in range(700)} - bad
    assert set(model.thresholds) <= {"en", "de"}


def test_labels_of_the_held_out_fold_are_not_learned(spark, planted, model):
    docs, labels, _ = planted
    flipped = labels.withColumn("toxic", F.when(op1.remainder(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = op1.train(docs, flipped)
    assert np.array_equal(other.vec, model.vec) and other.scale == model.scale


def test_odd_rows_no_labels_and_empty_tables(spark, odd, no_docs, odd_labels):
    m = op1.train(odd, odd_labels)
    got = op1.score(odd, m).collect()
    assert len(got) == len(odd_rows()) and all(0 <= x.score <= 1 for x in got)
    assert [x.held_out for x in got if x.doc_id is None] == [False]
    empty = op1.train(odd, odd_labels.where("false"))
    assert {x.score for x in op1.score(odd, empty).collect()} == {0.0}
    assert op1.score(no_docs, m).collect() == []
    assert op1.without_toxic(odd, empty).columns == odd.columns
    assert op1.without_toxic(odd, empty).count() == len(odd_rows())
