"""Stream = batch: the same input replayed in several micro-batches gives the batch answer; a stream
stopped and restarted from its checkpoint gives the answer of one uninterrupted run."""

import os
import random
import time

import pytest

from tempest.operators import alarms, rolling
from tempest.streaming import folds
from tempest.streaming import processors as P
from tempest.streaming import runner
from tempest.sources.files import stream_readings_csv

from .conftest import RISE_ROWS, SCHEMA, SENSOR_ROWS


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """A handful of rows a batch: more than two partitions are only overhead."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def land(folder, rows, parts, t0=1_700_000_000):
    """Write rows as CSV files in arrival order, with increasing modification times."""
    os.makedirs(folder, exist_ok=True)
    size = -(-len(rows) // parts)
    for k in range(parts):
        chunk = rows[k * size:(k + 1) * size]
        p = os.path.join(folder, f"part-{k:03d}.csv")
        with open(p, "w") as f:
            for seq, i, t, v in chunk:
                f.write(f"{seq},{i},{t},{v}\n")
        os.utime(p, (t0 + k * 10, t0 + k * 10))


def stream_of(spark, folder):
    return spark.readStream.schema("seq long, id string, timestamp long, temperature double").option("maxFilesPerTrigger", 1).csv(folder)


def run(spark, tmp_path, name, stream):
    return runner.run_to_table(spark, stream, name, runner.StreamRun(str(tmp_path / f"{name}-o"), str(tmp_path / f"{name}-c")))


@pytest.mark.parametrize("parts", [1, 3])
def test_keyed_count_stream_equals_batch(spark, tmp_path, sensor_df, parts):
    land(str(tmp_path / "in"), SENSOR_ROWS, parts)
    out = folds.run_keyed(stream_of(spark, str(tmp_path / "in")), rolling.count_spec(), "kc", str(tmp_path / "kc"))
    assert sorted(out.collect()) == sorted(rolling.keyed_count(sensor_df).collect())


def test_jump_and_max_by_multi_batch(spark, tmp_path, sensor_df):
    land(str(tmp_path / "in"), SENSOR_ROWS, 2)
    s = stream_of(spark, str(tmp_path / "in"))
    j = folds.run_keyed(s, alarms.jump_spec(10.0), "j", str(tmp_path / "j"))
    assert sorted(j.collect()) == sorted(alarms.jump_alarm(sensor_df, 10.0).collect())
    m = folds.run_keyed(s, rolling.max_by_spec(["timestamp"]), "m", str(tmp_path / "m"))
    assert sorted(m.collect()) == sorted(rolling.rolling_max_by(sensor_df).collect())


def test_rise_alarm_stream_keeps_rows_behind_other_keys(spark, tmp_path):
    """sensor_2 is far behind sensor_1's times and must not lose a row."""
    land(str(tmp_path / "in"), RISE_ROWS, 2)
    op = alarms.RiseAlarm(10, rows=2)
    out = folds.run_keyed(stream_of(spark, str(tmp_path / "in")), op, "r", str(tmp_path / "r"), at_end=op.at_end)
    got = sorted(tuple(r) for r in out.drop("seq").collect())
    assert got == sorted(tuple(r) for r in alarms.rise_alarm(spark.createDataFrame(RISE_ROWS, SCHEMA), 10).select("id", "fire_ts", "message").collect())
    assert len({r[0] for r in got}) == 2


def test_restart_from_checkpoint_equals_one_run(spark, tmp_path, sensor_df):
    folder = str(tmp_path / "in")
    land(folder, SENSOR_ROWS[:8], 2)
    def once():
        return folds.run_keyed(stream_of(spark, folder), rolling.count_spec(), "rs", str(tmp_path / "rs"))

    once()
    # more files land while the job is down; the restart continues from the committed offsets and state
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, "part-009.csv")
    with open(p, "w") as f:
        for seq, i, t, v in SENSOR_ROWS[8:]:
            f.write(f"{seq},{i},{t},{v}\n")
    os.utime(p, (1_800_000_000, 1_800_000_000))
    out = once()
    assert sorted(out.collect()) == sorted(rolling.keyed_count(sensor_df).collect())


def test_csv_landing_source(spark, tmp_path):
    land(str(tmp_path / "in2"), [(i, t, v, 0) for _, i, t, v in SENSOR_ROWS], 2)
    s = stream_readings_csv(spark, str(tmp_path / "in2"), 1)
    assert s.isStreaming and s.columns == ["id", "timestamp", "temperature"]


def test_late_window_stream_fixture(spark, tmp_path):
    """FIXTURES.md W6 table: firings, and the windows that the end of the input closes."""
    folder = str(tmp_path / "in")
    land(folder, SENSOR_ROWS, 3)
    s = stream_of(spark, folder)
    s = s.withColumn("arrival", s["seq"])
    out = folds.run_late_window(s, 5, 2, 60, root=str(tmp_path / "w6"), flush=False)
    got = sorted((r.tag, r.id, (r.window_end or 0) - 1547718000, r.seq) for r in out.collect())
    main = [("main", "sensor_1", 200, 0), ("main", "sensor_6", 205, 1), ("main", "sensor_7", 205, 2), ("main", "sensor_10", 210, 3),
            ("main", "sensor_1", 210, 5), ("main", "sensor_1", 205, 9), ("main", "sensor_1", 215, 7), ("main", "sensor_6", 220, 8)]
    late = [("late", "sensor_1", -1547718000, 11)]
    assert got == sorted(main + late)
    flushed = folds.run_late_window(s, 5, 2, 60, root=str(tmp_path / "w6"))  # a restart with nothing new, closed
    assert sorted((r.id, r.seq) for r in flushed.exceptAll(out).collect()) == [("sensor_10", 12), ("sensor_7", 10)]


def _disordered(n, seed):
    r = random.Random(seed)
    return [(i, r.choice(["a", "a", "a", "b", None]), 1000 + 3 * i + r.randint(-60, 10), r.choice([None, float(r.randint(0, 9)), 5.0])) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_late_window_stream_does_not_depend_on_the_cut(spark, tmp_path, parts):
    from tempest.operators import late_windows

    rows = _disordered(40, 7)
    land_parquet(spark, str(tmp_path / "in"), rows, parts)
    s = parquet_stream(spark, str(tmp_path / "in"))
    got = folds.run_late_window(s.withColumn("arrival", s["seq"]), 10, 4, 15, root=str(tmp_path / "w"), block=8)
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumn("arrival", df["seq"])
    main = late_windows.late_window_emissions(df, 10, 4, 15, flush_at_end=True, block=8)
    late = late_windows.late_window_min_by(df, 10, 4, 15, block=8)[1]
    assert _key(got.where("tag = 'main'").select(*main.columns).collect()) == _key(main.collect())
    assert _key(got.where("tag = 'late'").select(*late.columns).collect()) == _key(late.collect())
    assert late.count() > 3 and main.where("emitted_after is null").count() > 0


@pytest.mark.parametrize("lag", [3, 1000])  # positions that a row waits for earlier ones
def test_any_order_of_files_gives_the_batch_answer(spark, tmp_path, lag):
    from tempest.operators import changelog, count_windows

    rows = _disordered(24, 3)
    chunks = [rows[k : k + 8] for k in range(0, 24, 8)]
    for c in (chunks[1], chunks[2][::-1], chunks[0]):
        spark.createDataFrame(c, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)  # files are taken by their modification times
    s = parquet_stream(spark, str(tmp_path / "in"))
    df = spark.createDataFrame(rows, SCHEMA)
    for name, spec in (("l", changelog.count_avg_spec()), ("w", count_windows.CountWindow(3, 2)))[: 2 if lag == 3 else 1]:
        out = folds.run_keyed(s, spec, name, str(tmp_path / name), block=4, lag=lag)
        assert _key(_r(out.collect())) == _key(_r(spec.run(df, block=4).collect())), name
        took = folds.read_changes(spark, str(tmp_path / name), out.schema).where("change = -1").count()
        assert (took > 0) == (lag < 1000)


def test_late_rows_reach_the_late_output_however_late(spark, tmp_path):
    rows = [(0, "a", 5_000_000, 1.0), (1, "a", 9_000_000, 2.0), (2, "a", 1_000, 3.0), (3, None, 9_000_001, 4.0), (4, None, 9_000_002, None)]
    land_parquet(spark, str(tmp_path / "in"), rows, len(rows))
    s = parquet_stream(spark, str(tmp_path / "in"))
    got = folds.run_late_window(s.withColumn("arrival", s["seq"]), 5, 2, 60, root=str(tmp_path / "w"))
    assert sorted((r.tag, r.id or "", r.seq) for r in got.collect()) == [("late", "a", 2), ("main", "", 3), ("main", "a", 0), ("main", "a", 1)]


def test_side_outputs_stream_one_pass(spark, tmp_path):
    from pyspark.sql import functions as F

    from tempest.operators import routing
    from tempest.sinks.files import batch_folder

    land(str(tmp_path / "in"), SENSOR_ROWS, 3)
    s = routing.tag_side_output(stream_of(spark, str(tmp_path / "in")), F.col("temperature") > 30)
    out = {t: str(tmp_path / t) for t in ("main", "lowTemp")}
    q = routing.side_outputs_stream(
        s, {t: batch_folder(p) for t, p in out.items()}, str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(out["main"]).count() == 6 and spark.read.parquet(out["lowTemp"]).count() == 7


def test_streaming_word_count_carries_totals_across_batches(spark, tmp_path):
    from tempest.operators import wordcount

    from .conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    folder = str(tmp_path / "docs")
    for k in range(3):
        docs.where(f"doc_id >= {20 * k} AND doc_id < {20 * k + 20}").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = folds.run_word_count(wordcount.word_occurrences(stream), root=str(tmp_path / "wc"), block=1 << 8)
    assert len(os.listdir(tmp_path / "wc" / "out")) >= 3 and len(os.listdir(tmp_path / "wc" / "carry" / "totals")) == 2
    want = sorted(wordcount.running_word_count(wordcount.word_occurrences(docs), block=1 << 8).collect())
    assert sorted(out.collect()) == want


def _r(rows, n=6):
    return sorted((tuple(round(x, n) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


def test_more_folds_equal_batch_over_three_batches(spark, tmp_path, sensor_df):
    from tempest.operators import changelog, count_windows, windows
    from tempest.plans.registry import count_acc, range_acc, range_result
    from pyspark.sql import functions as F

    land(str(tmp_path / "in"), SENSOR_ROWS, 3)
    s = stream_of(spark, str(tmp_path / "in"))

    c = folds.run_keyed(s, changelog.count_avg_spec(), "cl", str(tmp_path / "cl"))
    assert _r(c.collect()) == _r(changelog.retract_count_avg(sensor_df).select(*c.columns).collect())

    for size, slide in ((10, 2), (1, 1)):
        w = folds.run_keyed(s, count_windows.CountWindow(size, slide), "cw", str(tmp_path / f"cw{size}{slide}"))
        assert _r(w.collect()) == _r(count_windows.count_window_slide(sensor_df, size, slide).collect())

    late = 10**6  # nothing is behind the watermark: the windows of all rows
    x = folds.run_group_window(s, 15, range_acc(), range_result(), "gw", delay=late, root=str(tmp_path / "gw"))
    assert _r(x.collect()) == _r(windows.group_window(sensor_df, 15, range_acc(), range_result()).select(*x.columns).collect())
    y = folds.run_group_window(s, 15, count_acc(), {"cnt": F.col("n")}, "sw", slide=5, delay=late, root=str(tmp_path / "sw"))
    assert _r(y.collect()) == _r(windows.slide_count(sensor_df, 15, 5).select(*y.columns).collect())


ODD = [(0, "a", 10, 1.0), (1, "a", 11, None), (2, None, 12, 5.0), (3, "a", 13, 9.0), (4, None, 14, None), (5, "a", 15, float("nan")), (6, None, 16, 2.0),
       (7, "a", 17, 30.0), (8, None, 18, 40.0)]


def land_parquet(spark, folder, rows, parts):
    size = -(-len(rows) // parts)
    for k in range(parts):
        spark.createDataFrame(rows[k * size : (k + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def parquet_stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def _key(rows):
    return sorted(repr(tuple(r)) for r in rows)


def test_null_keys_and_null_readings_batch_equals_stream(spark, tmp_path):
    from tempest.operators import changelog, count_windows

    df = spark.createDataFrame(ODD, SCHEMA)
    land_parquet(spark, str(tmp_path / "in"), ODD, 2)
    s = parquet_stream(spark, str(tmp_path / "in"))
    for name, spec in (("j", alarms.jump_spec(10.0)), ("m", rolling.max_by_spec(["timestamp"])), ("l", changelog.count_avg_spec())):
        assert _key(folds.run_keyed(s, spec, name, str(tmp_path / name)).collect()) == _key(spec.run(df, block=2).collect()), name
    w = folds.run_keyed(s, count_windows.CountWindow(2, 1), "w", str(tmp_path / "w"))
    assert _key(w.collect()) == _key(count_windows.count_window_slide(df, 2, 1, block=2).collect())
    op = alarms.RiseAlarm(2, rows=2)
    out = folds.run_keyed(s, op, "ra", str(tmp_path / "ra"), at_end=op.at_end)
    assert _key(out.drop("seq").collect()) == _key(alarms.rise_alarm(df, 2, block=2).select("id", "fire_ts", "message").collect())
    assert [r.cnt for r in rolling.keyed_count(df).where("id is null").orderBy("seq").collect()] == [1, 2, 3, 4]
    assert [(r.flag, r.cnt) for r in changelog.retract_count_avg(df).where("id = 'a'").orderBy("seq", "flag").collect()][:3] == [(True, 1), (False, 1), (True, 2)]


def test_table_stored_as_a_folder_is_streamed_whole(spark, tmp_path):
    from tempest.plans import registry

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    got = registry.q_stream_keyed_count(spark, str(tmp_path))
    assert got.count() == events.count()
    assert sorted(got.collect()) == sorted(registry.q_keyed_count(spark, str(tmp_path)).collect())


@pytest.mark.parametrize("parts", [1, 3])
def test_over_rows_stream_equals_batch(spark, tmp_path, parts):
    from tempest.operators import windows

    rows = sorted(SENSOR_ROWS, key=lambda r: (r[2], r[0])) + [(20, None, 1547718300, 1.0), (21, None, 1547718301, None), (22, "sensor_7", 1547718302, None)]
    land_parquet(spark, str(tmp_path / "in"), rows, parts)
    s = parquet_stream(spark, str(tmp_path / "in")).withColumnRenamed("timestamp", "ts").withColumnRenamed("temperature", "temp")
    t = spark.createDataFrame(rows, "seq long, id string, ts long, temp double")
    for n, delay in ((2, 0), (4, 10**6))[: 1 if parts == 1 else 2]:
        o = folds.run_over_rows(s, n, delay, root=str(tmp_path / f"o{n}"))
        assert o.where("tag = 'late'").isEmpty()
        assert _key(_r(o.drop("tag").collect())) == _key(_r(windows.over_rows(t, n).select(*o.columns[1:]).collect()))


def test_over_rows_behind_the_watermark_are_late(spark, tmp_path):
    rows = [(0, "a", 100, 1.0), (1, "b", 200, 2.0), (2, "a", 150, 3.0), (3, "a", 195, 4.0), (4, "a", 300, 5.0), (5, "a", 299, 6.0), (6, "a", None, 7.0)]
    land_parquet(spark, str(tmp_path / "in"), rows, 3)  # three rows a file; the third file has one
    s = parquet_stream(spark, str(tmp_path / "in")).withColumnRenamed("timestamp", "ts").withColumnRenamed("temperature", "temp")
    got = sorted((r.tag, r.seq, r.cnt, r.avg_temp) for r in folds.run_over_rows(s, 1, 10, root=str(tmp_path / "o")).collect())
    # the first file sets the watermark to 190: 150 waits with it, 195 comes in time; 300 and 299 are released at the end
    assert got == [("late", 6, None, None), ("main", 0, 1, 1.0), ("main", 1, 1, 2.0), ("main", 2, 2, 2.0), ("main", 3, 2, 3.5), ("main", 4, 2, 5.5), ("main", 5, 2, 5.0)]
    late = [(0, "a", 100, 1.0), (1, "a", 90, 2.0)]
    land_parquet(spark, str(tmp_path / "in2"), late, 2)
    s = parquet_stream(spark, str(tmp_path / "in2")).withColumnRenamed("timestamp", "ts").withColumnRenamed("temperature", "temp")
    assert sorted((r.tag, r.seq) for r in folds.run_over_rows(s, 1, 5, root=str(tmp_path / "o2")).collect()) == [("late", 1), ("main", 0)]


def test_nan_readings_batch_equals_stream(spark, tmp_path):
    nan = float("nan")
    rows = [(0, "a", 10, 5.0), (1, "a", 11, nan), (2, "a", 12, 30.0), (3, "a", 13, 2.0), (4, "b", 14, nan), (5, "b", 15, 1.0)]
    schema = "seq long, id string, timestamp long, temperature double"
    df = spark.createDataFrame(rows, schema)
    assert sorted((r.seq, r.temperature) for r in alarms.jump_alarm(df, 10.0).collect()) == [(3, 2.0)]
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    df.coalesce(1).write.mode("overwrite").parquet(folder + "/p")
    s = spark.readStream.schema(schema).parquet(folder + "/p")
    j = folds.run_keyed(s, alarms.jump_spec(10.0), "nj", str(tmp_path / "nj"))
    assert sorted(r.seq for r in j.collect()) == [3]
    m = folds.run_keyed(s, rolling.max_by_spec(["timestamp"]), "nm", str(tmp_path / "nm"))
    b = rolling.rolling_max_by(df)
    assert sorted((r.seq, r.max_seq) for r in m.collect()) == sorted((r.seq, r.max_seq) for r in b.collect())


def test_map_and_list_state_restart_and_expiry(spark, tmp_path):
    nan = float("nan")
    rows = [(0, "a", "x", 1.0), (1, "a", "y", 2.0), (2, None, "x", 3.0), (3, "a", "x", None), (4, "a", "x", nan), (5, "a", None, 5.0), (6, None, "x", 6.0), (7, "a", None, 7.0)]
    schema = "seq long, id string, sub string, value double"

    def go(processor, name, part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"{name}-in"))
        s = spark.readStream.schema(schema).parquet(str(tmp_path / f"{name}-in"))
        s = s.withColumn("is_null", s["value"].isNull())
        out = runner.keyed(s, "id", processor, processor.schema(), "ProcessingTime")
        got = runner.run_to_table(spark, out, name, runner.StreamRun(str(tmp_path / f"{name}-o"), str(tmp_path / f"{name}-c")))
        return [tuple(r) for r in got.orderBy("seq").collect()]

    go(P.LastBySubKey(), "m", rows[:4])  # the second run goes on from the checkpoint
    assert [repr(r[4]) for r in go(P.LastBySubKey(), "m", rows[4:])] == ["None", "None", "None", "1.0", "None", "None", "3.0", "5.0"]
    short = P.LastBySubKey(ttl_ms=1500)
    go(short, "t", rows[:2])
    time.sleep(2)
    assert [r[4] for r in go(short, "t", [(8, "a", "x", 8.0)])] == [None, None, None]
    go(P.RecentValues(2), "l", rows[:4])
    assert [r[2:] for r in go(P.RecentValues(2), "l", rows[5:])] == [
        (1, 1.0, 1.0), (2, 1.0, 2.0), (1, 3.0, 3.0), (1, 2.0, 2.0), (1, 5.0, 5.0), (2, 3.0, 6.0), (2, 5.0, 7.0)]


def test_user_reduce_on_value_state(spark, tmp_path):
    land(str(tmp_path / "in"), SENSOR_ROWS, 2)
    fields = "seq long, id string, timestamp long, temperature double"
    larger = P.KeyedReduce(lambda a, b: {**b, "temperature": max(a["temperature"], b["temperature"])}, ["seq", "id", "timestamp", "temperature"], fields)
    out = run(spark, tmp_path, "red", runner.keyed(stream_of(spark, str(tmp_path / "in")), "id", larger, fields))
    want = rolling.rolling_reduce_max(spark.createDataFrame(SENSOR_ROWS, SCHEMA))
    assert _r(out.collect()) == _r(want.select(*out.columns).collect())
