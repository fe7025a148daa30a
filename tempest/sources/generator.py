"""Seeded random-walk sensor source as a PySpark Python data source (batch and streaming).

Each sensor starts at ``60 + N(0,1) * 20`` and moves by ``N(0,1)`` per tick. The walk of a sensor is a pure function
of ``(seed, sensor, tick)``: its value at every ``BLOCK``-th tick is a coarse walk, and the ticks between are a random
bridge drawn for the block alone, so a micro-batch draws its own blocks and ``ticks / BLOCK`` coarse steps. Sensors are
spread over ``partitions`` input partitions; rows leave as Arrow batches. Timestamps are ``start_ts + tick``.

    spark.dataSource.register(SensorWalkSource)
    spark.read.format("sensor_walk").option("sensors", 10).option("ticks", 100).load()
    spark.readStream.format("sensor_walk").option("origin", int(time.time())).load()

A stream's offset is the number of ticks since ``origin`` (epoch seconds, one tick each ``interval`` seconds). Keep
``origin`` when a query is restarted: the offset then goes on from the checkpoint, no tick is lost or repeated.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "id string, timestamp long, temperature double"


class _Range(InputPartition):
    def __init__(self, first: int, last: int, t0: int, t1: int):
        self.first, self.last, self.t0, self.t1 = first, last, t0, t1


BLOCK = 1024
ROWS_PER_BATCH = 65_536


def _walk(seed: int, sensor: int, t0: int, t1: int) -> np.ndarray:
    """Temperatures of ``sensor`` for ticks ``[t0, t1)``."""
    b0, b1 = t0 // BLOCK, -(-t1 // BLOCK)
    rng = np.random.default_rng([seed, sensor])
    start = 60.0 + rng.standard_normal() * 20.0
    moves = rng.standard_normal(b1) * np.sqrt(BLOCK)  # of whole blocks
    at = start + np.concatenate(([0.0], np.cumsum(moves)))
    parts = []
    for b in range(b0, b1):
        z = np.random.default_rng([seed, sensor, b]).standard_normal(BLOCK)
        parts.append(at[b] + np.cumsum(z - z.mean() + moves[b] / BLOCK))
    return np.concatenate(parts)[t0 - b0 * BLOCK : t1 - b0 * BLOCK] if parts else np.zeros(0)


def _rows(p: _Range, seed: int, start_ts: int) -> Iterator[pa.RecordBatch]:
    for s in range(p.first, p.last):
        for a in range(p.t0, p.t1, ROWS_PER_BATCH):
            z = min(a + ROWS_PER_BATCH, p.t1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"sensor_{s + 1}"] * (z - a)), pa.array(np.arange(a, z, dtype=np.int64) + start_ts), pa.array(_walk(seed, s, a, z))],
                ["id", "timestamp", "temperature"])


class _Opts:
    def __init__(self, options: dict):
        self.sensors = int(options.get("sensors", 10))
        self.ticks = int(options.get("ticks", 10))
        self.seed = int(options.get("seed", 42))
        self.start_ts = int(options.get("start_ts", 1547718199))
        self.partitions = max(1, min(int(options.get("partitions", 4)), self.sensors))
        self.origin = float(options["origin"]) if "origin" in options else None
        self.interval = float(options.get("interval", 1.0))

    def ranges(self, t0: int, t1: int) -> list[_Range]:
        cuts = np.linspace(0, self.sensors, self.partitions + 1).astype(int)
        return [_Range(int(a), int(b), t0, t1) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]


class _Reader(DataSourceReader):
    def __init__(self, o: _Opts):
        self.o = o

    def partitions(self):
        return self.o.ranges(0, self.o.ticks)

    def read(self, partition):
        yield from _rows(partition, self.o.seed, self.o.start_ts)


class _StreamReader(DataSourceStreamReader):
    """Offsets count the ticks that are due by the clock: a function of the options alone, also after a restart."""

    def __init__(self, o: _Opts):
        if o.origin is None:
            raise ValueError("a sensor_walk stream needs the option origin (epoch seconds of tick 0)")
        self.o = o

    def initialOffset(self):
        return {"tick": 0}

    def latestOffset(self):
        return {"tick": max(0, int((time.time() - self.o.origin) // self.o.interval))}

    def partitions(self, start, end):
        t0, t1 = int(start["tick"]), int(end["tick"])
        return self.o.ranges(t0, t1) if t1 > t0 else []

    def read(self, partition):
        yield from _rows(partition, self.o.seed, self.o.start_ts)

    def commit(self, end):
        pass


class SensorWalkSource(DataSource):
    @classmethod
    def name(cls):
        return "sensor_walk"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(_Opts(self.options))

    def streamReader(self, schema):
        return _StreamReader(_Opts(self.options))


def register(spark) -> None:
    spark.dataSource.register(SensorWalkSource)
