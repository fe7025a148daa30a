import pytest
from pyspark.sql import functions as F

from tempest.operators import changelog, routing, tables, transforms, udfs, wordcount
from tempest.readings import parse_lines, reading_text, to_line


def test_changelog_sensor_6(sensor_df):
    got = changelog.retract_count_avg(sensor_df).where("id = 'sensor_6'").orderBy("seq", F.col("flag").asc()).collect()
    assert [(r.flag, r.cnt, round(r.avg_temp, 6)) for r in got] == [(True, 1, 15.4), (False, 1, 15.4), (True, 2, 15.4)]
    assert changelog.retract_count_avg(sensor_df).count() == 2 * 13 - 4


def test_split_select_union(sensor_df):
    t = routing.split_by_threshold(sensor_df, 30.0)
    assert routing.select_tags(t, "high").count() == 6 and routing.select_tags(t, "low").count() == 7
    u = routing.union_all(routing.select_tags(t, "high"), routing.select_tags(t, "low"), routing.select_tags(t, "high", "low"))
    assert u.count() == 26


def test_connect_map_and_side_output(sensor_df):
    t = routing.split_by_threshold(sensor_df, 30.0)
    c = routing.warning_status(routing.select_tags(t, "high"), routing.select_tags(t, "low"), keep=("seq",))
    rows = {r.seq: r for r in c.collect()}
    assert rows[0].status == "high temp warning" and rows[0].temperature == 35.8
    assert rows[7].status == "normal" and rows[7].temperature is None
    s = routing.tag_side_output(sensor_df, F.col("temperature") > 30)
    assert s.where("tag = 'lowTemp'").count() == 7


def test_write_tagged_writes_each_tag_once(spark, sensor_df, tmp_path):
    s = routing.tag_side_output(sensor_df, F.col("temperature") > 30)
    routing.write_tagged(s, {
        "main": lambda d: d.write.parquet(str(tmp_path / "main")),
        "lowTemp": lambda d: d.write.parquet(str(tmp_path / "low")),
    })
    assert spark.read.parquet(str(tmp_path / "main")).count() == 6
    assert spark.read.parquet(str(tmp_path / "low")).count() == 7


def test_line_transforms(sensor_df):
    lines = sensor_df.select("seq", to_line(sensor_df).alias("value"))
    assert lines.where("seq = 0").first().value == "sensor_1,1547718199,35.8"
    assert transforms.prefix_filter(lines).count() == 9
    assert transforms.line_fields(lines, keep=("seq",)).count() == 39
    assert transforms.line_lengths(lines, keep=("seq",)).where("seq = 0").first().len == 24


def test_reading_text(sensor_df):
    r = sensor_df.select(reading_text(sensor_df).alias("t")).first().t
    assert r == "SensorReading{id='sensor_1', timestamp=1547718199, temperature=35.8}"


def test_parse_lines_failfast_and_permissive(spark):
    good = spark.createDataFrame([("sensor_1,1547718199,35.8,extra",)], "value string")
    assert parse_lines(good).first().asDict() == {"id": "sensor_1", "timestamp": 1547718199, "temperature": 35.8}
    bad = spark.createDataFrame([("sensor_1,abc,35.8",), ("sensor_7",), ("",), ("sensor_6,1547718201,15.4",)], "value string")
    with pytest.raises(Exception):
        parse_lines(bad).collect()
    ok, rejects = parse_lines(bad, mode="permissive")
    assert ok.count() == 1 and rejects.count() == 3


def test_word_count_fixture(spark):
    docs = spark.createDataFrame([("hello world\nhello spark \n\n spark  stream\n   ",)], "text string")
    got = {r.word: r.cnt for r in wordcount.word_count(wordcount.text_lines(docs)).collect()}
    assert got == {"hello": 2, "spark": 2, "world": 1, "stream": 1, "": 3}


def test_running_word_count(spark):
    big = 1 << 62  # hash ids and long texts need no room in one number
    w = spark.createDataFrame([(big, 1 << 25, "a"), (3, 0, "a"), (3, 1, "b"), (big, 0, "a")], "doc_id long, pos int, word string")
    got = wordcount.running_word_count(w, block=2).orderBy("doc_id", "pos").collect()
    assert [(r.word, r.cnt) for r in got] == [("a", 1), ("b", 1), ("a", 2), ("a", 3)]


def test_tables_count_avg_and_sql(spark, sensor_df):
    t = tables.table_view(sensor_df, {"temperature": "temp"})
    got = {r.id: (r.cnt, round(r.avg_temp, 6)) for r in tables.group_count_avg(t).collect()}
    assert got == {"sensor_1": (7, 30.142857), "sensor_6": (2, 15.4), "sensor_7": (2, 1.85), "sensor_10": (2, 43.1)}
    tables.register_view(t, "fx_input")
    assert {r.id: r.cnt for r in tables.group_count_avg_sql(spark, "fx_input").collect()}["sensor_1"] == 7
    tables.register_view(sensor_df, "fx_sensor_plain")
    assert tables.select_where_sql(spark, "fx_sensor_plain", "sensor_6").count() == 2


def test_udfs(spark, sensor_df):
    t = tables.table_view(sensor_df, {"timestamp": "ts", "temperature": "temp"})
    got = udfs.split_table(t).where("id = 'sensor_10'").collect()
    assert sorted((r.word, r.length) for r in got) == [("10", 2), ("10", 2), ("sensor", 6), ("sensor", 6)]
    udfs.register_hash_code(spark)
    t.createOrReplaceTempView("fx_udf")
    assert spark.sql("SELECT hashCode(id) AS h FROM fx_udf WHERE id = 'sensor_10' LIMIT 1").first().h == 470860996
    udfs.register_avg_temp(spark)
    r = spark.sql("SELECT id, avgTemp(temp) AS a FROM fx_udf GROUP BY id").collect()
    assert {x.id: round(x.a, 6) for x in r}["sensor_1"] == 30.142857
    udfs.register_split_udtf(spark)
    n = spark.sql("SELECT id, word, length FROM fx_udf, LATERAL split_words(id)").count()
    assert n == 26


def test_split_table_function_takes_any_separator(spark):
    spark.createDataFrame([("it's'a''",), ("",), ("xaaa",)], "id string").createOrReplaceTempView("fx_sep")
    udfs.register_split_udtf(spark, "split_quote", "'")
    udfs.register_split_udtf(spark, "split_aa", "aa")
    assert sorted(r.word for r in spark.sql("SELECT word FROM fx_sep, LATERAL split_quote(id)").collect()) == ["", "a", "it", "s", "xaaa"]
    assert sorted(r.word for r in spark.sql("SELECT word FROM fx_sep, LATERAL split_aa(id)").collect()) == ["", "a", "it's'a''", "x"]


def test_rich_map_lifecycle(sensor_df):
    import pandas as pd

    def fn(b: pd.DataFrame, res):
        return pd.DataFrame({"id": b.id, "tag": [res] * len(b)})

    got = transforms.rich_map(sensor_df, fn, "id string, tag string", open_fn=lambda: "opened")
    assert {r.tag for r in got.collect()} == {"opened"}


def test_python_function_surface(sensor_df):
    lines = sensor_df.select("seq", to_line(sensor_df).alias("value"))
    m = transforms.map_python(lines, lambda r: {"seq": r["seq"], "n": len(r["value"])}, "seq long, n long")
    assert {r.seq: r.n for r in m.collect()}[0] == 24
    f = transforms.flat_map_python(lines, lambda r: [{"field": x} for x in r["value"].split(",")], "field string")
    assert f.count() == 39
    k = transforms.filter_python(lines, lambda r: r["value"].startswith("sensor_1"))
    assert k.count() == 9 and k.columns == ["seq", "value"]


def test_python_flat_map_with_empty_batches(sensor_df):
    f = transforms.flat_map_python(sensor_df, lambda r: [{"id": r["id"]}] if r["seq"] == 3 else [], "id string")
    assert [r.id for r in f.collect()] == ["sensor_10"]


def test_append_only_result_as_retract_stream(sensor_df):
    r = changelog.as_retract_stream(sensor_df.select("id", "temperature"))
    assert r.columns == ["flag", "id", "temperature"] and r.where("flag").count() == 13


def test_text_lines_strip_crlf(spark):
    docs = spark.createDataFrame([("a b\r\nc\r\n\r\n",)], "text string")
    lines = [r.line for r in wordcount.text_lines(docs).orderBy("line_no").collect()]
    assert lines == ["a b", "c", ""]
    assert {r.word: r.cnt for r in wordcount.word_count(wordcount.text_lines(docs)).collect()} == {"a": 1, "b": 1, "c": 1, "": 1}


def test_running_word_count_shuffles_occurrences_once(spark, monkeypatch):
    """Only the range partitioning sees single occurrences: what is written are blocks, and nothing is sorted or
    joined by word but a row per block and word. Ids may repeat or be null."""
    rows = [(i if i % 5 else 7 if i % 2 else None, j, f"w{(i * j) % 13}" if (i + j) % 4 else None) for i in range(40) for j in range(50)]
    words = spark.createDataFrame(rows, "doc_id long, pos int, word string").repartition(3)
    written, plain = [], wordcount.materialize

    def spied(d, name):
        out = plain(d, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(wordcount, "materialize", spied)
    got = wordcount.running_word_count(words, block=64)
    want, now = [], {}
    for i, j, w in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        now[w] = now.get(w, 0) + 1
        want.append(repr((i, j, w, now[w])))
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(want)
    assert written and max(written) < len(rows) / 20
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if ("Window" in x or "Join" in x or "Sort" in x) and "pos#" in x]
