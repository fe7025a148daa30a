import os
import sqlite3

import pytest
import time

from pyspark.sql import functions as F

from tempest.readings import parse_lines
from tempest.sinks import files as file_sinks
from tempest.sinks import kafka as kafka_sinks
from tempest.sinks.upserts import latest_per_key, write_jdbc_upsert, write_redis_hash
from tempest.sources import files, generator, kafka, memory
from tempest.jobs import kafka_table_transform

from .conftest import SENSOR_ROWS


def _write_lines(path, rows):
    with open(path, "w") as f:
        for _, i, t, v in rows:
            f.write(f"{i},{t},{v}\n")


def test_text_and_csv_sources(spark, tmp_path):
    p = tmp_path / "sensor.txt"
    _write_lines(p, SENSOR_ROWS)
    lines = files.read_lines(spark, str(p))
    assert lines.count() == 13
    assert parse_lines(lines).where("id = 'sensor_1'").count() == 7
    t = files.read_readings_csv(spark, str(p), table_names=True)
    assert t.columns == ["id", "timestamp", "temp"] and t.count() == 13


def test_memory_sources(spark):
    c = memory.from_collection(spark, [("sensor_1", 1547718199, 35.8), ("sensor_6", 1547718201, 15.4)])
    assert c.count() == 2 and c.schema["timestamp"].dataType.simpleString() == "bigint"
    e = memory.from_elements(spark, 1, 2, 4, 67, 189)
    assert [r.value for r in e.collect()] == [1, 2, 4, 67, 189]


def test_kafka_payloads(spark, sensor_df):
    raw = spark.createDataFrame([(bytearray(b"sensor_1,1547718199,35.8"),), (bytearray(b"sensor_6,1547718201,15.4"),)], "value binary")
    vals = kafka.decode_value(raw)
    rows = kafka.csv_values(vals).collect()
    assert rows[0].asDict() == {"id": "sensor_1", "timestamp": 1547718199, "temp": 35.8}
    out = kafka_table_transform(vals).collect()
    assert [r.value for r in out] == ["sensor_1,35.8"]
    txt = kafka_sinks.reading_values(sensor_df.drop("seq")).first().value
    assert txt == "SensorReading{id='sensor_1', timestamp=1547718199, temperature=35.8}"


def test_csv_table_sink_positional(spark, sensor_df, tmp_path):
    q = sensor_df.select("id", F.col("temperature").alias("temp")).where("id = 'sensor_1'")
    file_sinks.write_csv_table(q, str(tmp_path / "out"))
    back = spark.read.schema("id string, temperature double").csv(str(tmp_path / "out"))
    assert back.count() == 7


def test_generator_batch_is_seeded_and_partitioned(spark):
    generator.register(spark)
    a = spark.read.format("sensor_walk").option("sensors", 10).option("ticks", 20).option("seed", 7).load()
    b = spark.read.format("sensor_walk").option("sensors", 10).option("ticks", 20).option("seed", 7).load()
    assert a.count() == 200 and a.rdd.getNumPartitions() == 4
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.select("id").distinct().count() == 10


def test_generator_stream_goes_on_after_a_restart(spark, tmp_path):
    generator.register(spark)
    origin = int(time.time())

    def run(batches):
        s = spark.readStream.format("sensor_walk").option("sensors", 3).option("origin", origin).option("interval", 0.25).load()
        q = s.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).start()
        t0 = time.time()
        while sum(p["numInputRows"] > 0 for p in q.recentProgress) < batches and time.time() - t0 < 60:
            time.sleep(0.3)
        q.stop()

    run(2)
    first = spark.read.parquet(str(tmp_path / "o")).count()
    run(2)
    got = spark.read.parquet(str(tmp_path / "o")).collect()
    ticks = len(got) // 3
    assert len(got) > first >= 3 and len(got) == len({(r.id, r.timestamp) for r in got})  # none twice
    batch = spark.read.format("sensor_walk").option("sensors", 3).option("ticks", ticks).load().collect()
    assert sorted(batch) == sorted(got)  # none lost, the same walks


def test_generator_blocks_continue_the_walk():
    whole = generator._walk(5, 2, 0, 3000)
    parts = [generator._walk(5, 2, a, min(a + 700, 3000)) for a in range(0, 3000, 700)]
    assert (whole == [x for p in parts for x in p]).all()
    assert 0.9 < (whole[1:] - whole[:-1]).std() < 1.1


class FakeRedis:
    """Records pipelined HSETs as lines in a folder (executors run in this process in local mode)."""

    def __init__(self, folder):
        self.folder = folder

    def pipeline(self):
        return self

    def hset(self, name, key, value):
        with open(os.path.join(self.folder, f"{os.getpid()}-{id(self)}.log"), "a") as f:
            f.write(f"{name}\t{key}\t{value}\n")

    def execute(self):
        return []


def test_redis_hash_sink_last_write_wins(sensor_df, tmp_path):
    folder = str(tmp_path)
    write_redis_hash(sensor_df, lambda: FakeRedis(folder))
    got = {}
    for fn in os.listdir(folder):
        for line in open(os.path.join(folder, fn)):
            name, k, v = line.rstrip("\n").split("\t")
            got[k] = (name, v)
    assert got == {"sensor_1": ("sensor_temp", "10.0"), "sensor_6": ("sensor_temp", "15.4"),
                   "sensor_7": ("sensor_temp", "-3.0"), "sensor_10": ("sensor_temp", "48.1")}


@pytest.mark.parametrize("merge,column", [("update_insert", "id TEXT"), ("on_conflict", "id TEXT PRIMARY KEY")])
def test_jdbc_upsert_once_per_batch(spark, sensor_df, tmp_path, merge, column):
    db = str(tmp_path / "t.db")
    with sqlite3.connect(db) as c:
        c.execute(f"CREATE TABLE sensor_temp ({column}, temp REAL)")
        c.execute("INSERT INTO sensor_temp VALUES ('sensor_1', 99.0)")
    connect = lambda: sqlite3.connect(db, timeout=60)

    def table():
        with sqlite3.connect(db) as c:
            assert c.execute("SELECT count(*) FROM sensor_temp_stage").fetchone() == (0,)
            return sorted(c.execute("SELECT id, temp FROM sensor_temp").fetchall())

    want = [("sensor_1", 10.0), ("sensor_10", 48.1), ("sensor_6", 15.4), ("sensor_7", -3.0)]
    assert write_jdbc_upsert(sensor_df, connect, merge=merge, batch_id=0)
    assert table() == want
    later = spark.createDataFrame([(99, "sensor_1", 0, 1.5), (98, None, 0, 9.0)], sensor_df.schema)
    assert write_jdbc_upsert(later, connect, merge=merge, batch_id=1)
    assert not write_jdbc_upsert(sensor_df, connect, merge=merge, batch_id=0)  # a replay of the older batch changes nothing
    assert write_jdbc_upsert(sensor_df, connect, merge=merge, batch_id=0, sink="other")
    assert table() == want
    # an attempt that broke off left staged rows; the batch is applied whole all the same
    with sqlite3.connect(db) as c:
        c.execute("INSERT INTO sensor_temp_stage VALUES ('default', 2, 7, 'sensor_1', -1.0)")
    assert write_jdbc_upsert(later, connect, merge=merge, batch_id=2)
    assert table() == [("sensor_1", 1.5), *want[1:]]


def test_replayed_side_output_batch_replaces_itself(spark, sensor_df, tmp_path):
    from tempest.operators import routing

    tagged = routing.split_by_threshold(sensor_df)
    write = {t: file_sinks.batch_folder(f"{tmp_path}/{t}") for t in (routing.HIGH, routing.LOW)}
    for batch_id in (0, 0, 1):  # batch 0 is replayed
        routing.write_tagged(tagged, {t: (lambda d, w=w: w(d, batch_id)) for t, w in write.items()})
    assert spark.read.parquet(f"{tmp_path}/high").where("batch = 0").count() == 6
    assert spark.read.parquet(f"{tmp_path}/low").count() == 14


def test_latest_per_key(sensor_df):
    got = {r.id: r.temperature for r in latest_per_key(sensor_df).collect()}
    assert got["sensor_1"] == 10.0


def test_csv_table_stream_to_csv_sink(spark, tmp_path):
    from tempest.operators import tables

    src = tmp_path / "in"
    src.mkdir()
    _write_lines(src / "a.csv", SENSOR_ROWS)
    s = tables.stream_csv_table(spark, str(src), name="fx_stream_input")
    filtered = spark.sql("SELECT id, temp FROM fx_stream_input WHERE id = 'sensor_1'")
    q = file_sinks.stream_csv_table(filtered, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    back = spark.read.schema("id string, temperature double").csv(str(tmp_path / "out"))
    assert s.isStreaming and back.count() == 7
    b = tables.read_csv_table(spark, str(src / "a.csv"), name="fx_batch_input")
    assert tables.group_count_avg_sql(spark, "fx_batch_input").count() == 4


def test_text_landing_stream_parses(spark, tmp_path):
    src = tmp_path / "lines"
    src.mkdir()
    _write_lines(src / "a.txt", SENSOR_ROWS[:5])
    _write_lines(src / "b.txt", SENSOR_ROWS[5:])
    lines = files.stream_lines(spark, str(src), max_files_per_trigger=1)
    parsed = parse_lines(lines)
    q = parsed.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 13


def test_console_sinks(spark, sensor_df, tmp_path, capsys):
    from tempest.sinks.console import print_batch, print_stream

    print_batch(sensor_df.limit(2), "data", rows=20)
    src = tmp_path / "c"
    src.mkdir()
    _write_lines(src / "a.txt", SENSOR_ROWS[:3])
    q = print_stream(files.stream_lines(spark, str(src)), "lines", rows=20, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    assert "data" in capsys.readouterr().out


def test_generator_values_do_not_depend_on_partitioning(spark):
    generator.register(spark)

    def read(parts):
        return sorted(spark.read.format("sensor_walk").option("sensors", 7).option("ticks", 15).option("seed", 3)
                      .option("partitions", parts).load().collect())

    one, three, seven = read(1), read(3), read(7)
    assert one == three == seven and len(one) == 105
