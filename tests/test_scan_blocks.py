"""The block scan must give the same answer whatever the block size: force many small blocks
(so keys span blocks and blocks hold many keys) and compare with the DuckDB oracles at sf0.001."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tempest.operators import alarms, changelog, count_windows, late_windows, rolling, windows
from tempest.plans import registry as R
from tempest.plans.oracle import ORACLE

from .conftest import SF_SMALL

BLOCK = 7  # a handful of seq values per block


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return con


def rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(_n(r[c]) for c in cols) for r in df.collect())


def orows(con, name, cols):
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    idx = [names.index(c) for c in sorted(cols)]
    return sorted(tuple(_n(r[i]) for i in idx) for r in cur.fetchall())


def _n(v):
    return round(v, 6) if isinstance(v, float) else v


CASES = {
    "rolling_sum": lambda s: rolling.rolling_sum(s, block=BLOCK).select("seq", "id", "timestamp", F.round("temperature", 6).alias("temperature")),
    "rolling_max_by": lambda s: rolling.rolling_max_by(s, block=BLOCK),
    "rolling_reduce": lambda s: rolling.rolling_reduce_max(s, block=BLOCK),
    "keyed_count": lambda s: rolling.keyed_count(s, block=BLOCK),
    "jump_alarm": lambda s: alarms.jump_alarm(s, R.JUMP_THRESHOLD, block=BLOCK),
    "rise_alarm": lambda s: alarms.rise_alarm(s, R.RISE_INTERVAL, block=BLOCK),
    "count_window_tumble": lambda s: count_windows.count_window_tumble(s, 10, block=BLOCK).select("id", "block", F.round("avg_temp", 6).alias("avg_temp")),
    "count_window_slide": lambda s: count_windows.count_window_slide(s, 10, 2, block=BLOCK).select("id", "seq", F.round("avg_temp", 6).alias("avg_temp")),
    "late_window_main": lambda s: late_windows.late_window_min_by(R._arrival(s), R.LATE_SIZE, R.LATE_DELAY, R.LATE_LATENESS, block=BLOCK)[0],
    "late_window_late": lambda s: late_windows.late_window_min_by(R._arrival(s), R.LATE_SIZE, R.LATE_DELAY, R.LATE_LATENESS, block=BLOCK)[1],
    "over_rows": lambda s: windows.over_rows(
        s.withColumnRenamed("timestamp", "ts").withColumnRenamed("temperature", "temp"), 2, partitions=5
    ).select("id", "ts", "seq", "cnt", F.round("avg_temp", 6).alias("avg_temp")),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_small_blocks_match_oracle(spark, duck, name):
    s = R.sensor(spark, SF_SMALL)
    got = CASES[name](s)
    assert rows(got) == orows(duck, name, got.columns)


def test_changelog_small_blocks(spark, duck):
    s = R.sensor(spark, SF_SMALL)
    c = changelog.retract_count_avg(s, block=BLOCK)
    s6 = F.round("sum_temp", 6)
    got = c.select("flag", "seq", "id", "cnt", s6.alias("sum_temp"), F.round(s6 / F.col("cnt"), 6).alias("avg_temp"))
    assert rows(got) == orows(duck, "retract_changelog", got.columns)
