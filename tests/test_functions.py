from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tempest.functions import java_hash, java_length, java_split
from tempest.functions.pymodel import py_java_hash, py_java_length, py_java_split


def test_java_split_edge_cases(spark):
    df = spark.createDataFrame([("a  b ",), ("",), ("   ",), (" x",), ("a,,b,,",)], "s string")
    got = [r[0] for r in df.select(java_split("s", " ")).collect()]
    assert got == [["a", "", "b"], [""], [], ["", "x"], ["a,,b,,"]]
    assert df.select(java_split("s", ",")).collect()[4][0] == ["a", "", "b"]


def test_java_split_with_longer_separators(spark):
    rows = ["xaaa", "aa", "aaa", "baab", "baa", "aab", "", "b a|b  aa ", "ab", "b"]
    df = spark.createDataFrame([(x,) for x in rows], "s string")
    for sep in ("aa", "a|aa", "aa|a", r"\s+", "ab"):
        got = [r.x for r in df.select(java_split("s", sep).alias("x")).collect()]
        assert got == [py_java_split(x, sep) for x in rows], sep
    assert [r.x for r in df.select(java_split("s", "aa").alias("x")).collect()][0] == ["x", "a"]


def test_java_hash_fixture_values(spark):
    rows = [("sensor_1",), ("sensor_6",), ("sensor_7",), ("sensor_10",), ("",), ("é",), ("😀",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(java_hash("s")).collect()]
    assert got == [1262115052, 1262115057, 1262115058, 470860996, 0, 233, 1772899, None]


def test_java_length_counts_utf16_units(spark):
    got = [r[0] for r in spark.createDataFrame([("abc",), ("😀",), ("é",)], "s string").select(java_length("s")).collect()]
    assert got == [3, 2, 1]


_text = st.text(alphabet=st.sampled_from(list("ab ,_é😀")), max_size=12)


@settings(max_examples=1, deadline=None)
@given(st.lists(_text, min_size=40, max_size=40))
def test_string_functions_match_python_model(spark, samples):
    # one DataFrame per hypothesis example, 40 strings each, compared with the pure-Python JDK model
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select("s", java_split("s", " ").alias("sp"), java_split("s", ",").alias("sc"),
                    java_hash("s").alias("h"), java_length("s").alias("n")).collect()
    for r in got:
        assert r.sp == py_java_split(r.s, " ")
        assert r.sc == py_java_split(r.s, ",")
        assert r.h == py_java_hash(r.s)
        assert r.n == py_java_length(r.s)


def test_split_sql_expr_matches_column_form(spark):
    from tempest.operators.udfs import split_sql_expr

    df = spark.createDataFrame([("sensor_10",), ("a__b__",), ("",), ("___",)], "id string")
    a = df.select(F.expr(split_sql_expr("id", "_")).alias("x")).collect()
    assert [[p.word for p in r.x] for r in a] == [["sensor", "10"], ["a", "", "b"], [""], []]


def test_epoch_seconds_ignores_session_zone(spark):
    from tempest.readings import epoch_seconds

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 00:00:07.9' AS ts UNION ALL SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59.5'")
        assert [r[0] for r in df.select(epoch_seconds(F.col("ts"))).collect()] == [1719792007, -1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_java_comparisons_with_nan(spark):
    from tempest.functions import java_gt, java_lt
    from tempest.operators.routing import split_by_threshold

    df = spark.createDataFrame([(float("nan"),), (31.0,), (30.0,), (None,)], "temperature double")
    assert [r[0] for r in df.select(java_gt("temperature", 30.0)).collect()] == [False, True, False, None]
    assert [r[0] for r in df.select(java_lt("temperature", 31.0)).collect()] == [False, False, True, None]
    assert [r.tag for r in split_by_threshold(df).collect()] == ["low", "high", "low", "low"]
