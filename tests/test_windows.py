from pyspark.sql import functions as F

from tempest.operators import late_windows, windows
from tempest.operators.tables import table_view

from .conftest import rel


def test_tumble_count_and_sum_first(sensor_df):
    got = sorted((r.id, rel(r.window_end), r.cnt) for r in windows.tumble_count(sensor_df, 15).collect())
    assert ("sensor_1", 210, 5) in got and ("sensor_1", 225, 2) in got and len(got) == 8
    s = {(r.id, rel(r.window_end)): (r.first_seq, round(r.temperature, 6)) for r in windows.tumble_sum_first(sensor_df, 15).collect()}
    assert s[("sensor_1", 210)] == (0, 143.9) and s[("sensor_1", 225)] == (6, 67.1) and s[("sensor_10", 300)] == (12, 48.1)


def test_slide_count_sensor_1(sensor_df):
    got = sorted((rel(r.window_end), r.cnt) for r in windows.slide_count(sensor_df, 15, 5).where("id = 'sensor_1'").collect())
    assert got == [(200, 1), (205, 2), (210, 5), (215, 6), (220, 5), (225, 2)]
    others = windows.slide_count(sensor_df, 15, 5).where("id <> 'sensor_1'").collect()
    assert len(others) == 6 * 3 and all(r.cnt == 1 for r in others)


def test_group_window_count_avg(sensor_df):
    t = table_view(sensor_df, {"timestamp": "ts", "temperature": "temp"}, rowtime="rt")
    got = sorted((r.id, rel(r.window_end), r.cnt, round(r.avg_temp, 6)) for r in windows.tumble_count_avg(t, 10).collect())
    assert got == sorted([("sensor_1", 200, 1, 35.8), ("sensor_1", 210, 4, 27.025), ("sensor_1", 220, 2, 33.55),
                          ("sensor_6", 210, 1, 15.4), ("sensor_6", 220, 1, 15.4), ("sensor_7", 210, 1, 6.7),
                          ("sensor_7", 300, 1, -3.0), ("sensor_10", 210, 1, 38.1), ("sensor_10", 300, 1, 48.1)])


def test_group_window_sql(spark, sensor_df):
    table_view(sensor_df, {"timestamp": "ts", "temperature": "temp"}, rowtime="rt").createOrReplaceTempView("fx_sensor")
    got = spark.sql("SELECT id, count(id) AS cnt, avg(temp) AS avg_temp, unix_seconds(window.end) AS e "
                    "FROM fx_sensor GROUP BY id, window(rt, '10 seconds')").where("id = 'sensor_1'").collect()
    assert sorted((rel(r.e), r.cnt) for r in got) == [(200, 1), (210, 4), (220, 2)]


def test_over_rows_fixture(sensor_df):
    t = table_view(sensor_df, {"timestamp": "ts", "temperature": "temp"})
    got = sorted((rel(r.ts), r.cnt, round(r.avg_temp, 6)) for r in windows.over_rows(t, 2).where("id = 'sensor_1'").collect())
    assert got == [(199, 1, 35.8), (204, 2, 32.4), (206, 3, 24.933333), (207, 3, 25.1), (209, 3, 26.366667),
                   (212, 3, 35.4), (213, 3, 33.3)]


def test_late_windows_fixture(sensor_df):
    d = sensor_df.withColumn("arrival", F.col("seq"))
    main, late = late_windows.late_window_min_by(d, 5, 2, 60)
    got = {(r.id, rel(r.window_end) - 5): r.seq for r in main.collect()}
    assert got == {("sensor_1", 195): 0, ("sensor_6", 200): 1, ("sensor_7", 200): 2, ("sensor_10", 205): 3,
                   ("sensor_1", 205): 5, ("sensor_1", 200): 9, ("sensor_1", 210): 7, ("sensor_6", 215): 8,
                   ("sensor_7", 290): 10, ("sensor_10", 290): 12}
    assert [r.seq for r in late.collect()] == [11]


def test_window_apply_full_window_function(sensor_df):
    import pandas as pd

    def count_fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": [pdf.id.iloc[0]], "window_end": [pdf.window_end.iloc[0]], "cnt": [len(pdf)]})

    got = windows.window_apply(sensor_df, count_fn, "id string, window_end long, cnt long", 15, 5)
    assert sorted((rel(r.window_end), r.cnt) for r in got.where("id = 'sensor_1'").collect()) == [
        (200, 1), (205, 2), (210, 5), (215, 6), (220, 5), (225, 2)]


def test_late_window_emissions_fixture(sensor_df):
    """FIXTURES.md W6 table: (emitted after seq, window start, id, best seq)."""
    d = sensor_df.withColumn("arrival", F.col("seq"))
    got = sorted((r.emitted_after, rel(r.window_end) - 5, r.id, r.seq) for r in late_windows.late_window_emissions(d, 5, 2, 60).collect())
    assert got == sorted([(2, 195, "sensor_1", 0), (4, 200, "sensor_6", 1), (4, 200, "sensor_7", 2), (6, 205, "sensor_10", 3),
                          (6, 205, "sensor_1", 5), (9, 200, "sensor_1", 9), (10, 210, "sensor_1", 7), (10, 215, "sensor_6", 8)])
    flushed = late_windows.late_window_emissions(d, 5, 2, 60, flush_at_end=True).where("emitted_after IS NULL").collect()
    assert sorted((r.id, rel(r.window_end) - 5, r.seq) for r in flushed) == [("sensor_10", 290, 12), ("sensor_7", 290, 10)]


def test_late_window_min_by_puts_null_readings_last(spark):
    rows = [(0, "a", 100, None, 0), (1, "a", 101, 7.0, 1), (2, "a", 102, 9.0, 2), (3, "b", 100, None, 3)]
    df = spark.createDataFrame(rows, "seq long, id string, timestamp long, temperature double, arrival long")
    main, _ = late_windows.late_window_min_by(df, 5, 2, 60)
    assert sorted((r.id, r.seq) for r in main.collect()) == [("a", 1), ("b", 3)]


def test_full_window_function_sees_sorted_batches_of_one_huge_window(spark):
    from pyspark.sql import functions as F

    class Ordered:
        """Largest batch, and whether the rows came in order."""

        def __init__(self):
            self.last, self.ok, self.largest, self.n = None, True, 0, 0

        def add(self, rows):
            v = rows.column("temperature").to_pylist()
            self.ok &= v == sorted(v) and (self.last is None or self.last <= v[0])
            self.last, self.largest, self.n = v[-1], max(self.largest, len(v)), self.n + len(v)

        def result(self):
            return [{"n": self.n, "ok": self.ok, "largest": self.largest}]

    df = spark.range(60_000).select(F.lit("a").alias("id"), F.lit(5).cast("long").alias("timestamp"), F.rand(1).alias("temperature"))
    df = df.unionByName(spark.createDataFrame([(None, 7, 1.0), (None, 8, 4.0), ("b", 9, None)], "id string, timestamp long, temperature double"))
    got = {r.id: r for r in windows.window_process(df.where("temperature is not null"), Ordered, "n long, ok boolean, largest long", 10, order=["temperature"]).collect()}
    assert (got["a"].n, got["a"].ok) == (60_000, True) and got["a"].largest <= 10_000 and got["a"].window_end == 10
    assert (got[None].n, len(got)) == (2, 2)
    m = {r.id: (r["rows"], r.median) for r in windows.window_median(df, 10).collect()}
    assert m[None] == (2, 2.5) and m["a"][0] == 60_000 and abs(m["a"][1] - 0.5) < 0.02
    plan = windows.window_median(df, 10)._jdf.queryExecution().toString()
    assert "FlatMapGroupsInArrow" in plan


def test_small_windows_share_one_group_and_one_shuffle(spark):
    from pyspark.sql import functions as F

    df = spark.range(30_000).select(F.when(F.col("id") % 11 != 0, F.concat(F.lit("s"), F.col("id") % 400)).alias("id"), (F.col("id") % 173).alias("timestamp"),
                                    F.when(F.col("id") % 5 != 0, (F.col("id") * 7919 % 1009).cast("double")).alias("temperature"))
    want = {}
    for r in df.where("temperature is not null").collect():
        want.setdefault((r.id, r.timestamp // 10 * 10 + 10), []).append(r.temperature)
    got = windows.window_median(df, 10)
    assert {(r.id, r.window_end): (r["rows"], r.median) for r in got.collect()} == {
        k: (len(v), (sorted(v)[(len(v) - 1) // 2] + sorted(v)[len(v) // 2]) / 2) for k, v in want.items()}
    assert got.count() == len(want) > 5_000
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1, plan
