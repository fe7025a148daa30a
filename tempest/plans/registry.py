"""Registered queries over the driver tables, each with an independent DuckDB oracle.

Sensor view (all sensor queries): ``id = 'sensor_' || user_id``, ``timestamp`` = whole epoch seconds
of ``ts``, ``temperature = value``, ``seq = event_id`` from ``events``; word count reads
``documents.text``. The driver tables span 30 days with ~70 readings per sensor, so durations are
scaled up from the reference's seconds (24 h windows instead of 10-15 s, and so on); the fixture
tests use the reference's own constants. Averages and sums are rounded to 6 decimals on both sides
(double sums depend on the addition order); window ends are BIGINT epoch seconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.operators import alarms, changelog, count_windows, late_windows, rolling, routing, tables, transforms, udfs, windows
from tempest.operators import wordcount
from tempest.functions.java import java_gt
from tempest.session import scratch_path
from tempest.sinks import files as csv_sink
from tempest.sinks import kafka as kafka_sink
from tempest.sources import files
from tempest.sources import kafka as kafka_source
from tempest.readings import parse_lines, reading_text, sensor_view, to_line

# Parameters of the registered queries (durations in seconds).
DAY = 86_400
SLIDE = 28_800
LATE_SIZE, LATE_DELAY, LATE_LATENESS = 21_600, 600, 3_600
LATE_EVERY, LATE_SHIFT = 17, 60  # arrival model: every 17th reading arrives 60 positions late
LATE_RUNS = 3
RISE_INTERVAL = 43_200
JUMP_THRESHOLD = 10.0
HIGH_THRESHOLD = 30.0


def count_acc() -> dict:
    return {"n": ("count", F.lit(1))}


def range_acc() -> dict:
    """A user's accumulator: count, sum and extremes of the readings."""
    t = F.col("temperature")
    return {"n": ("count", t), "s": ("sum", t), "lo": ("min", t), "hi": ("max", t)}


def range_result() -> dict:
    return {"cnt": F.col("n"), "avg_temp": F.round(F.round("s", 6) / F.col("n"), 6), "spread": F.round(F.col("hi") - F.col("lo"), 6)}


Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_view(_read(spark, sf_dir, "events"))


def sensor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table form ``id, timestamp as ts, temperature as temp, rt.rowtime`` plus ``seq``."""
    return tables.table_view(sensor(spark, sf_dir), {"timestamp": "ts", "temperature": "temp"}, rowtime="rt")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sensor view as CSV text lines ``id,timestamp,temperature`` (what a sensor file holds)."""
    s = sensor(spark, sf_dir)
    return s.select("seq", to_line(s).alias("line"))


def _r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


def _arrival(df: DataFrame) -> DataFrame:
    late = (F.col("seq") % LATE_EVERY) == 0
    return df.withColumn("arrival", F.when(late, F.col("seq") + LATE_SHIFT).otherwise(F.col("seq")))


# ---------------------------------------------------------------- word count, lines, parsing


def q_word_count(spark, d):
    return wordcount.word_count(wordcount.text_lines(_read(spark, d, "documents")))


def q_running_word_count(spark, d):
    return wordcount.running_word_count(wordcount.word_occurrences(_read(spark, d, "documents")))


def q_text_file_lines(spark, d):
    """S1: the sensor lines written as text files and read line by line."""
    path = scratch_path(spark, "lines")
    lines(spark, d).select("line").write.text(path)
    return files.read_lines(spark, path).withColumnRenamed("value", "line")


def q_csv_table_roundtrip(spark, d):
    """S8, K5: readings as a CSV table with the declared schema, and a query of it into the CSV table sink."""
    src, out = scratch_path(spark, "csv-in"), scratch_path(spark, "csv-out")
    sensor(spark, d).select("id", "timestamp", "temperature").write.csv(src)
    csv_sink.write_csv_table(files.read_readings_csv(spark, src, table_names=True).select("id", "temp"), out)
    return spark.read.schema("id string, temperature double").csv(out)


def q_csv_payload_roundtrip(spark, d):
    """S9, K6: readings as CSV payloads of a topic and back."""
    s = sensor(spark, d).select("id", "timestamp", F.col("temperature").alias("temp"))
    return kafka_source.csv_values(kafka_sink.csv_values(s))


def q_line_lengths(spark, d):
    return transforms.line_lengths(lines(spark, d), "line", keep=("seq",))


def q_line_fields(spark, d):
    return transforms.line_fields(lines(spark, d), "line", ",", keep=("seq",))


def q_prefix_filter(spark, d):
    return transforms.prefix_filter(lines(spark, d), "sensor_1", "line")


def q_parse_lines(spark, d):
    return parse_lines(lines(spark, d), "line", "failfast", keep=["seq"])


def q_reading_text(spark, d):
    s = sensor(spark, d)
    return s.select("seq", reading_text(s).alias("text"))


# ---------------------------------------------------------------- table API / SQL


def q_select_where(spark, d):
    return tables.select_where(sensor(spark, d), "sensor_1")


def q_select_where_sql(spark, d):
    tables.register_view(sensor(spark, d), "tempest_sensor")
    return tables.select_where_sql(spark, "tempest_sensor", "sensor_1")


def q_group_count_avg(spark, d):
    return tables.group_count_avg(sensor_table(spark, d)).select("id", "cnt", _r6("avg_temp"))


def q_group_count_avg_sql(spark, d):
    tables.register_view(sensor_table(spark, d), "tempest_input")
    return tables.group_count_avg_sql(spark, "tempest_input").select("id", "cnt", _r6("avg_temp"))


def q_avg_temp_udaf(spark, d):
    return sensor_table(spark, d).groupBy("id").agg(udfs.avg_temp("temp").alias("avg_temp")).select("id", _r6("avg_temp"))


# ---------------------------------------------------------------- split / connect / union / side output


def _tagged(spark, d):
    return routing.split_by_threshold(sensor(spark, d), HIGH_THRESHOLD)


def q_split_high(spark, d):
    return routing.select_tags(_tagged(spark, d), routing.HIGH)


def q_split_low(spark, d):
    return routing.select_tags(_tagged(spark, d), routing.LOW)


def q_union_all(spark, d):
    t = _tagged(spark, d)
    return routing.union_all(
        routing.select_tags(t, routing.HIGH), routing.select_tags(t, routing.LOW), routing.select_tags(t, routing.HIGH, routing.LOW)
    )


def q_connect_map(spark, d):
    t = _tagged(spark, d)
    return routing.warning_status(routing.select_tags(t, routing.HIGH), routing.select_tags(t, routing.LOW), keep=("seq",))


def q_side_outputs(spark, d):
    return routing.tag_side_output(sensor(spark, d), java_gt("temperature", HIGH_THRESHOLD))


# ---------------------------------------------------------------- rolling / keyed state


def q_rolling_sum(spark, d):
    return rolling.rolling_sum(sensor(spark, d)).select("seq", "id", "timestamp", _r6("temperature"))


def q_rolling_max_by(spark, d):
    return rolling.rolling_max_by(sensor(spark, d))


def q_rolling_reduce(spark, d):
    return rolling.rolling_reduce_max(sensor(spark, d))


def q_keyed_count(spark, d):
    return rolling.keyed_count(sensor(spark, d))


def q_shard_count(spark, d):
    s = sensor(spark, d).withColumn("shard", F.col("seq") % 4)
    return rolling.shard_count(s)


def q_retract_changelog(spark, d):
    # average of the sum rounded to 6 decimals: exact for the 2-decimal driver data, and free of the
    # last-bit noise of double sums that would move exact half-way averages across a rounding boundary
    return _rounded_changelog(changelog.retract_count_avg(sensor(spark, d)))


def _rounded_changelog(c):
    s6 = F.round("sum_temp", 6)
    return c.select("flag", "seq", "id", "cnt", s6.alias("sum_temp"), F.round(s6 / F.col("cnt"), 6).alias("avg_temp"))


def q_retract_avg_temp(spark, d):
    """The changelog of the user aggregate avgTemp."""
    acc = {"_s": ("sum", F.col("temperature")), "_m": ("count", F.col("temperature"))}
    return changelog.changelog_spec(acc, {"avg_temp": F.round(F.round("_s", 6) / F.col("_m"), 6)}).run(sensor(spark, d))


def q_jump_alarm(spark, d):
    return alarms.jump_alarm(sensor(spark, d), JUMP_THRESHOLD)


def q_rise_alarm(spark, d):
    return alarms.rise_alarm(sensor(spark, d), RISE_INTERVAL)


# ---------------------------------------------------------------- windows


def q_tumble_count(spark, d):
    return windows.tumble_count(sensor(spark, d), DAY)


def q_tumble_sum_first(spark, d):
    return windows.tumble_sum_first(sensor(spark, d), DAY).select("id", "window_end", "first_seq", "timestamp", _r6("temperature"))


def q_tumble_count_avg(spark, d):
    return windows.tumble_count_avg(sensor_table(spark, d), DAY).select("id", "cnt", _r6("avg_temp"), "window_end")


def q_tumble_count_avg_sql(spark, d):
    tables.register_view(sensor_table(spark, d), "tempest_sensor_rt")
    return spark.sql(
        f"""SELECT id, count(id) AS cnt, round(avg(temp), 6) AS avg_temp, unix_seconds(window.end) AS window_end
            FROM tempest_sensor_rt GROUP BY id, window(rt, '{DAY} seconds')"""
    )


def q_slide_count(spark, d):
    return windows.slide_count(sensor(spark, d), DAY, SLIDE)


def q_count_window_tumble(spark, d):
    return count_windows.count_window_tumble(sensor(spark, d), 10).select("id", "block", _r6("avg_temp"))


def q_count_window_slide(spark, d):
    return count_windows.count_window_slide(sensor(spark, d), 10, 2).select("id", "seq", _r6("avg_temp"))


def q_over_rows(spark, d):
    return windows.over_rows(sensor_table(spark, d), 2).select("id", "ts", "seq", "cnt", _r6("avg_temp"))


def q_over_rows_sql(spark, d):
    tables.register_view(sensor_table(spark, d), "tempest_sensor_over")
    return spark.sql(
        """SELECT id, ts, seq, count(id) OVER ow AS cnt, round(avg(temp) OVER ow, 6) AS avg_temp
           FROM tempest_sensor_over
           WINDOW ow AS (PARTITION BY id ORDER BY rt, seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
    )


def _late(spark, d):
    return late_windows.late_window_min_by(_arrival(sensor(spark, d)), LATE_SIZE, LATE_DELAY, LATE_LATENESS)


def q_late_window_main(spark, d):
    return _late(spark, d)[0]


def q_late_window_late(spark, d):
    return _late(spark, d)[1]


def q_late_window_emissions(spark, d):
    return late_windows.late_window_emissions(_arrival(sensor(spark, d)), LATE_SIZE, LATE_DELAY, LATE_LATENESS)


def q_late_window_flushed(spark, d):
    """As above, with the windows that the end of the bounded input closes."""
    return late_windows.late_window_emissions(_arrival(sensor(spark, d)), LATE_SIZE, LATE_DELAY, LATE_LATENESS, flush_at_end=True)


def q_user_accumulator(spark, d):
    """U4: a user's accumulator (sum, count, extremes) with its merge and result."""
    return windows.group_window(sensor(spark, d), DAY, range_acc(), range_result())


def q_window_median(spark, d):
    """U5: a full-window function, the rows of a window handed over sorted, batch by batch."""
    return windows.window_median(sensor(spark, d), DAY).select("id", "window_end", "rows", _r6("median"))


# ---------------------------------------------------------------- user functions


def q_hash_code(spark, d):
    t = sensor_table(spark, d)
    return t.select("seq", "id", "ts", udfs.hash_code("id").alias("hash_code"))


def q_split_lateral(spark, d):
    return udfs.split_table(sensor_table(spark, d), "id", "_", keep=("seq", "id", "ts"))


def q_split_lateral_sql(spark, d):
    tables.register_view(sensor_table(spark, d), "tempest_sensor_udtf")
    return spark.sql(
        f"SELECT seq, id, ts, t.word, t.length FROM tempest_sensor_udtf LATERAL VIEW inline({udfs.split_sql_expr('id', '_')}) t AS word, length"
    )


def q_hash_code_sql(spark, d):
    tables.register_view(sensor_table(spark, d), "tempest_sensor_hash")
    udfs.register_hash_code(spark, "hashCode")
    return spark.sql("SELECT seq, id, ts, hashCode(id) AS hash_code FROM tempest_sensor_hash")


def q_split_udtf_sql(spark, d):
    tables.register_view(sensor_table(spark, d), "tempest_sensor_split")
    udfs.register_split_udtf(spark, "split_words")
    return spark.sql("SELECT seq, id, ts, w.word, w.length FROM tempest_sensor_split, LATERAL split_words(id) AS w")


def q_avg_temp_sql(spark, d):
    tables.register_view(sensor_table(spark, d), "tempest_sensor_avg")
    udfs.register_avg_temp(spark, "avgTemp")
    # average times count, rounded: free of the last-bit noise of double sums
    return spark.sql("SELECT id, cnt, round(a * cnt, 4) AS sum_temp FROM "
                     "(SELECT id, avgTemp(temp) AS a FROM tempest_sensor_avg GROUP BY id) JOIN "
                     "(SELECT id, count(temp) AS cnt FROM tempest_sensor_avg GROUP BY id) USING (id)")


# ---------------------------------------------------------------- streaming twins (availableNow → parquet)


def _running(spark, d, spec, name):
    from tempest.streaming import folds, runner

    return folds.run_keyed(runner.stream_sensor(spark, d), spec, name)


def q_stream_keyed_count(spark, d):
    return _running(spark, d, rolling.count_spec(), "keyed_count")


def q_stream_shard_count(spark, d):
    from tempest.streaming import folds, runner

    src = runner.stream_sensor(spark, d).withColumn("shard", F.col("seq") % 4)
    return folds.run_keyed(src, rolling.count_spec("shard"), "shard_count")


def q_stream_jump_alarm(spark, d):
    return _running(spark, d, alarms.jump_spec(JUMP_THRESHOLD), "jump_alarm")


def q_stream_rolling_max_by(spark, d):
    return _running(spark, d, rolling.max_by_spec(["timestamp"]), "rolling_max_by")


def q_stream_rolling_reduce(spark, d):
    return _running(spark, d, rolling.reduce_max_spec(), "rolling_reduce")


def q_stream_retract_changelog(spark, d):
    return _rounded_changelog(_running(spark, d, changelog.count_avg_spec(), "retract_changelog"))


def q_stream_count_window_slide(spark, d):
    return _running(spark, d, count_windows.CountWindow(10, 2), "count_window_slide").select("id", "seq", _r6("avg_temp"))


def q_stream_count_window_tumble(spark, d):
    return _running(spark, d, count_windows.CountWindow(10, 10), "count_window_tumble").select("id", "seq", _r6("avg_temp"))


def q_stream_word_count(spark, d):
    """The streaming word count: per word occurrence, the running count of the word."""
    from tempest.streaming import folds, runner

    return folds.run_word_count(wordcount.word_occurrences(runner.stream_table(spark, d, "documents")))


def _java_max(a: float | None, b: float | None) -> float | None:
    """``Math.max`` on doubles (NaN if either side is NaN); a null reading does not count."""
    return b if a is None else a if b is None or a != a else b if b != b else max(a, b)


def _reduce_max(prev: dict, cur: dict) -> dict:
    """The reference's reduce as a user's function: the current timestamp, the larger temperature."""
    return {"timestamp": cur["timestamp"], "temperature": _java_max(prev["temperature"], cur["temperature"])}


def _user_reduce():
    from tempest.operators.blockfold import UserReduce

    return UserReduce(_reduce_max, ("timestamp", "temperature"))


def q_user_reduce(spark, d):
    """A4 with an opaque Python function."""
    return _user_reduce().run(sensor(spark, d)).select("seq", "id", "timestamp", "temperature")


def q_stream_user_reduce(spark, d):
    return _running(spark, d, _user_reduce(), "user_reduce").select("seq", "id", "timestamp", "temperature")


def q_stream_rise_alarm(spark, d):
    from tempest.streaming import folds, runner

    op = alarms.RiseAlarm(RISE_INTERVAL)
    return folds.run_keyed(runner.stream_sensor(spark, d), op, "rise_alarm", at_end=op.at_end).drop("seq")


def q_stream_over_rows(spark, d):
    from tempest.streaming import folds, runner

    src = runner.stream_sensor(spark, d).withColumnRenamed("timestamp", "ts").withColumnRenamed("temperature", "temp")
    return folds.run_over_rows(src, 2).where("tag = 'main'").select("id", "ts", "seq", "cnt", _r6("avg_temp"))


def _processor(spark, d, processor, columns: dict, name: str, run=None):
    from tempest.streaming import runner

    src = runner.stream_table(spark, d, "events")
    src = src.select(F.col("event_id").alias("seq"), F.concat(F.lit("sensor_"), F.col("user_id")).alias("id"),
                     *[c.alias(n) for n, c in columns.items()]).withColumn("is_null", F.col("value").isNull())
    return runner.run_to_table(spark, runner.keyed(src, "id", processor, processor.schema(), "ProcessingTime"), name, run)


def q_stream_last_by_type(spark, d):
    """P8: map state with an expiry of a year: the last value of each type of a sensor's events."""
    from tempest.streaming.processors import LastBySubKey

    out = _processor(spark, d, LastBySubKey(ttl_ms=365 * DAY * 1000), {"sub": F.col("event_type"), "value": F.col("value")}, "last_by_type")
    return out.withColumnRenamed("sub", "event_type")


def q_stream_recent_values(spark, d):
    """P7: list state: extremes of a sensor's last three values."""
    from tempest.streaming.processors import RecentValues

    return _processor(spark, d, RecentValues(3), {"value": F.col("value")}, "recent_values")


def _group_window(spark, d, name, size, accumulators, results, **kw):
    from tempest.streaming import folds, runner

    return folds.run_group_window(runner.stream_sensor(spark, d), size, accumulators, results, name, **kw)


def q_stream_tumble_count(spark, d):
    return _group_window(spark, d, "tumble_count", DAY, count_acc(), {"cnt": F.col("n")})


def q_stream_slide_count(spark, d):
    return _group_window(spark, d, "slide_count", DAY, count_acc(), {"cnt": F.col("n")}, slide=SLIDE)


def q_stream_tumble_sum_first(spark, d):
    first = F.struct(F.col("seq").alias("s"), F.col("timestamp").alias("t"))
    out = _group_window(spark, d, "tumble_sum_first", DAY, {"f": ("min", first), "s": ("sum", F.col("temperature"))},
                        {"first_seq": F.col("f.s"), "timestamp": F.col("f.t"), "temperature": F.round("s", 6)})
    return out.select("id", "window_end", "first_seq", "timestamp", "temperature")


def q_stream_tumble_count_avg(spark, d):
    """W7 on a stream: each window once, when the watermark passes its end; the last ones at the end of the input."""
    acc = {"n": ("count", F.col("id")), "s": ("sum", F.col("temperature")), "m": ("count", F.col("temperature"))}
    out = _group_window(spark, d, "tumble_count_avg", DAY, acc, {"cnt": F.col("n"), "avg_temp": F.round(F.try_divide("s", "m"), 6)}, delay=LATE_DELAY)
    return out.select("id", "cnt", "avg_temp", "window_end")


def _landed(spark, src: DataFrame, order: str, runs: int, name: str):
    """The rows of ``src`` written to a landing folder in ``runs`` parts of the order, one part after the other:
    yields the folder after each part."""
    lo, hi = src.agg(F.min(order), F.max(order)).first()
    landing = scratch_path(spark, name)
    part = F.floor((F.col(order) - (lo or 0)) * runs / F.lit((hi or 0) - (lo or 0) + 1))
    for k in range(runs):
        src.where(part == k).write.mode("append").parquet(landing)
        yield landing


def q_stream_late_window(spark, d):
    """Streaming W6 over the readings in arrival order, landed in thirds: each third is a run of the same job,
    continued from its checkpoint. Firings and late rows are those of the batch replay."""
    from tempest.streaming import folds

    src = _arrival(sensor(spark, d))
    root, out = scratch_path(spark, "late-window"), None
    for landing in _landed(spark, src, "arrival", LATE_RUNS, "landing"):
        out = folds.run_late_window(spark.readStream.schema(src.schema).parquet(landing), LATE_SIZE, LATE_DELAY, LATE_LATENESS, root=root)
    return out


def q_stream_reordered(spark, d):
    """Running counts of a stream whose parts land in the wrong order (the last part first): rows wait for ``lag``
    numbers, later ones correct what was given out. The answer is the batch twin's."""
    from tempest.streaming import folds

    src = sensor(spark, d)
    turned = src.withColumn("turn", F.when(F.col("seq") % 3 == 0, -F.col("seq")).otherwise(F.col("seq")))
    root, out = scratch_path(spark, "reordered"), None
    for landing in _landed(spark, turned, "turn", 3, "landing"):
        out = folds.run_keyed(spark.readStream.schema(turned.schema).parquet(landing).drop("turn"), changelog.count_avg_spec(), "reordered", root, lag=100)
    return _rounded_changelog(out)


def _landing_lines(spark, d):
    """The sensor lines as a landing folder of seven files, each in the order of the readings."""
    path = scratch_path(spark, "landing-lines")
    s = lines(spark, d).withColumn("part", F.col("seq") % 7)
    s.repartitionByRange(7, "part").sortWithinPartitions("part", "seq").select("line", "part").write.partitionBy("part").text(path)
    return path


def q_lines_with_arrival(spark, d):
    """S1, S3: the lines of a landing folder with their arrival numbers (files by path), without sorting them."""
    n = files.lines_with_arrival(spark, f"{_landing_lines(spark, d)}/*/", by_time=False)
    return n.select("arrival", F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part"), "line_no", "line")


def q_stream_lines(spark, d):
    """S3 on a stream: numbers go on from batch to batch. The files land in any order of their times, so the oracle
    has the line number in the file, and every arrival number once."""
    from tempest.streaming import folds

    path = _landing_lines(spark, d)
    n = folds.run_lines(files.stream_lines_located(spark, f"{path}/*/", 3))
    ends = n.groupBy("file").agg(F.min("arrival").alias("first"))
    n = n.join(ends, "file").select(F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part"), "line_no", "line",
                                    (F.col("arrival") - F.col("first")).alias("from_first"), "arrival")
    dense = n.agg(F.countDistinct("arrival") == F.max("arrival") + 1).scalar()
    return n.drop("arrival").withColumn("dense", dense)


def q_stream_side_outputs(spark, d):
    """M5 on a stream: one pass over the source, each tag to its own folder, a batch to its own place in it."""
    from tempest.sinks.files import batch_folder
    from tempest.streaming import runner

    root = scratch_path(spark, "side-outputs")
    tagged = routing.tag_side_output(runner.stream_sensor(spark, d), java_gt("temperature", HIGH_THRESHOLD))
    writers = {t: batch_folder(f"{root}/out/tag={t}") for t in (routing.MAIN_TAG, routing.LOW_TEMP_TAG)}
    routing.side_outputs_stream(tagged, writers, f"{root}/checkpoint", available_now=True).awaitTermination()
    out = spark.read.schema("seq long, id string, timestamp long, temperature double, tag string, batch long").parquet(f"{root}/out")
    return out.drop("batch")


def q_rich_map(spark, d):
    """T8 in a form that does not depend on the partitioning: every reading once, whether its task index is one of
    the stage's tasks, and how often the task's resource had been opened when the reading was mapped."""
    s = sensor(spark, d).select("seq", "id")
    tasks = s.rdd.getNumPartitions()

    def open_task() -> dict:
        from pyspark import TaskContext

        return {"index": TaskContext.get().partitionId(), "opened": 1}

    def tag(batch, task: dict):
        return batch.assign(in_range=0 <= task["index"] < tasks, opened=task["opened"])

    return transforms.rich_map(s, tag, "seq long, id string, in_range boolean, opened int", open_task)


QUERIES: dict[str, Query] = {
    "word_count": q_word_count,
    "running_word_count": q_running_word_count,
    "text_file_lines": q_text_file_lines,
    "csv_table_roundtrip": q_csv_table_roundtrip,
    "csv_payload_roundtrip": q_csv_payload_roundtrip,
    "line_lengths": q_line_lengths,
    "line_fields": q_line_fields,
    "prefix_filter": q_prefix_filter,
    "parse_lines": q_parse_lines,
    "reading_text": q_reading_text,
    "select_where": q_select_where,
    "select_where_sql": q_select_where_sql,
    "split_high": q_split_high,
    "split_low": q_split_low,
    "union_all": q_union_all,
    "connect_map": q_connect_map,
    "side_outputs": q_side_outputs,
    "rolling_sum": q_rolling_sum,
    "rolling_max_by": q_rolling_max_by,
    "rolling_reduce": q_rolling_reduce,
    "keyed_count": q_keyed_count,
    "group_count_avg": q_group_count_avg,
    "group_count_avg_sql": q_group_count_avg_sql,
    "avg_temp_udaf": q_avg_temp_udaf,
    "retract_changelog": q_retract_changelog,
    "retract_avg_temp": q_retract_avg_temp,
    "user_accumulator": q_user_accumulator,
    "tumble_count": q_tumble_count,
    "tumble_sum_first": q_tumble_sum_first,
    "tumble_count_avg": q_tumble_count_avg,
    "tumble_count_avg_sql": q_tumble_count_avg_sql,
    "slide_count": q_slide_count,
    "count_window_tumble": q_count_window_tumble,
    "count_window_slide": q_count_window_slide,
    "over_rows": q_over_rows,
    "over_rows_sql": q_over_rows_sql,
    "jump_alarm": q_jump_alarm,
    "rise_alarm": q_rise_alarm,
    "late_window_main": q_late_window_main,
    "late_window_late": q_late_window_late,
    "late_window_emissions": q_late_window_emissions,
    "late_window_flushed": q_late_window_flushed,
    "hash_code": q_hash_code,
    "hash_code_sql": q_hash_code_sql,
    "split_udtf_sql": q_split_udtf_sql,
    "avg_temp_sql": q_avg_temp_sql,
    "split_lateral": q_split_lateral,
    "split_lateral_sql": q_split_lateral_sql,
    "shard_count": q_shard_count,
    "rich_map": q_rich_map,
    "stream_keyed_count": q_stream_keyed_count,
    "stream_shard_count": q_stream_shard_count,
    "stream_jump_alarm": q_stream_jump_alarm,
    "stream_tumble_count": q_stream_tumble_count,
    "stream_slide_count": q_stream_slide_count,
    "stream_tumble_sum_first": q_stream_tumble_sum_first,
    "stream_side_outputs": q_stream_side_outputs,
    "stream_rolling_max_by": q_stream_rolling_max_by,
    "stream_rolling_reduce": q_stream_rolling_reduce,
    "stream_retract_changelog": q_stream_retract_changelog,
    "stream_count_window_slide": q_stream_count_window_slide,
    "stream_count_window_tumble": q_stream_count_window_tumble,
    "stream_rise_alarm": q_stream_rise_alarm,
    "stream_over_rows": q_stream_over_rows,
    "stream_late_window": q_stream_late_window,
    "stream_tumble_count_avg": q_stream_tumble_count_avg,
    "stream_word_count": q_stream_word_count,
    "stream_reordered": q_stream_reordered,
    "stream_last_by_type": q_stream_last_by_type,
    "stream_recent_values": q_stream_recent_values,
    "window_median": q_window_median,
    "user_reduce": q_user_reduce,
    "stream_user_reduce": q_stream_user_reduce,
    "lines_with_arrival": q_lines_with_arrival,
    "stream_lines": q_stream_lines,
}


# SURVEY §2 operator IDs exercised by each registered query.
SURVEY_IDS: dict[str, str] = {
    "word_count": "T5 A1 F1", "running_word_count": "T5 A2 F1", "line_lengths": "T2 F2",
    "line_fields": "T3 F1", "prefix_filter": "T4 F3", "parse_lines": "T1 F11", "reading_text": "T7 D2 F10",
    "select_where": "S10 T9", "select_where_sql": "S12 T10", "split_high": "M1 M2", "split_low": "M1 M2",
    "union_all": "M4", "connect_map": "M3 T6", "side_outputs": "M5 P11", "rolling_sum": "A2",
    "rolling_max_by": "A3", "rolling_reduce": "A4 F5", "keyed_count": "A6 P6", "group_count_avg": "A5",
    "group_count_avg_sql": "A7 S12", "avg_temp_udaf": "A8 U3", "retract_changelog": "A9",
    "tumble_count": "W1 U4", "tumble_sum_first": "W3", "tumble_count_avg": "W7 S11 F9",
    "tumble_count_avg_sql": "W8 F9", "slide_count": "W2", "count_window_tumble": "W5",
    "count_window_slide": "W4", "over_rows": "O1", "over_rows_sql": "O2", "jump_alarm": "P9 F6",
    "rise_alarm": "P10 F7", "late_window_main": "W6 P1 P2 P3", "late_window_late": "W6 P4",
    "late_window_emissions": "W6 P2 P3", "hash_code": "U1 F4", "split_lateral": "U2 J1",
    "split_lateral_sql": "U2 J2", "shard_count": "P5", "rich_map": "T8",
    "stream_keyed_count": "S2 A6 P6 U7", "stream_jump_alarm": "S2 P9 U7", "stream_rolling_max_by": "S2 A3",
    "stream_rolling_reduce": "S2 A4", "stream_retract_changelog": "S2 A9",
    "stream_count_window_slide": "S2 W4 P7", "stream_count_window_tumble": "S2 W5 P7",
    "stream_rise_alarm": "S2 P10 P2", "stream_over_rows": "S2 O3", "stream_late_window": "S2 W6 P2 P3 P4 P12",
    "stream_word_count": "S2 A2 T5", "stream_tumble_count_avg": "S2 W7 W8 P1 P2 A10",
    "text_file_lines": "S1", "csv_table_roundtrip": "S8 K5", "csv_payload_roundtrip": "S9 K6", "retract_avg_temp": "A9 U3",
    "user_accumulator": "U4", "late_window_flushed": "W6 P2 P3", "hash_code_sql": "U1 F4", "split_udtf_sql": "U2 J2",
    "avg_temp_sql": "U3 A8", "stream_shard_count": "S2 P5", "stream_tumble_count": "S2 W1 U4", "stream_slide_count": "S2 W2",
    "stream_tumble_sum_first": "S2 W3", "stream_side_outputs": "S2 M5 P11",
    "stream_reordered": "S2 A9", "stream_last_by_type": "S2 P8 U7", "stream_recent_values": "S2 P7 U7", "window_median": "U5", "user_reduce": "A4 U6", "stream_user_reduce": "S2 A4 U7", "lines_with_arrival": "S1 S3", "stream_lines": "S2 S3",
}
