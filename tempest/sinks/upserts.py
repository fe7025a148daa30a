"""Keyed upsert sinks: Redis hash (``HSET sensor_temp <id> <temperature>``) and a JDBC table
(``update … where id``, insert when no row changed).

Both keep only the *latest* row per key of a micro-batch (by ``seq``) before writing, so the work per
batch is one row per key and the last write per field wins as in the per-record sink. Writes go out per partition through
a client made by an injected factory (one connection per task, opened before and closed after the partition). The
Redis sink writes the same values again when a batch is replayed; the table sink applies a batch once.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempest.functions.java import java_double_text

# Hash name and table of the reference's sinks.
REDIS_HASH = "sensor_temp"
JDBC_TABLE = "sensor_temp"


def latest_per_key(df: DataFrame, key: str = "id", seq: str = "seq", fields: Iterable[str] = ("temperature",)) -> DataFrame:
    """Last row per key in arrival order — a partial (map-side combined) aggregate."""
    return df.groupBy(key).agg(*[F.max_by(f, seq).alias(f) for f in fields])


def write_redis_hash(df: DataFrame, client_factory: Callable[[], object], hash_name: str = REDIS_HASH,
                     key: str = "id", seq: str = "seq", field: str = "temperature", batch: int = 500) -> None:
    """HSET the latest ``field`` text of each key. ``client_factory()`` returns an object with
    ``pipeline()`` whose result has ``hset(name, key, value)`` and ``execute()`` (redis-py compatible)."""
    rows = latest_per_key(df, key, seq, [field]).select(key, java_double_text(field).alias("v"))

    def write(part):
        client = client_factory()
        try:
            pipe = client.pipeline()
            n = 0
            for r in part:
                if r[0] is None or r[1] is None:  # a hash holds no nulls; clients refuse them
                    continue
                pipe.hset(hash_name, r[0], r[1])
                n += 1
                if n % batch == 0:
                    pipe.execute()
                    pipe = client.pipeline()
            pipe.execute()
        finally:
            close = getattr(client, "close", None)
            if close:
                close()

    rows.foreachPartition(write)


#: How the staged rows get into the table: statements with ``{table}`` and ``{mine}`` (the batch's staged rows).
MERGE = {
    # any database, no unique index needed
    "update_insert": [
        "UPDATE {table} SET temp = (SELECT s.temp FROM {mine} s WHERE s.id = {table}.id) WHERE id IN (SELECT id FROM {mine} s)",
        "INSERT INTO {table} (id, temp) SELECT s.id, s.temp FROM {mine} s WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE t.id = s.id)",
    ],
    # a unique index on id and INSERT ... ON CONFLICT
    "on_conflict": ["INSERT INTO {table} (id, temp) SELECT s.id, s.temp FROM {mine} s WHERE true ON CONFLICT (id) DO UPDATE SET temp = excluded.temp"],
    "merge": ["MERGE INTO {table} t USING {mine} s ON t.id = s.id WHEN MATCHED THEN UPDATE SET temp = s.temp WHEN NOT MATCHED THEN INSERT (id, temp) VALUES (s.id, s.temp)"],
}


def create_upsert_tables(connect: Callable[[], object], table: str = JDBC_TABLE) -> None:
    """The staging table and the ledger beside ``table``, where they are missing."""
    conn = connect()
    try:
        cur = conn.cursor()
        cur.execute(f"CREATE TABLE IF NOT EXISTS {table}_stage (sink VARCHAR(200), batch BIGINT, part INTEGER, id VARCHAR(200), temp DOUBLE PRECISION)")
        cur.execute(f"CREATE TABLE IF NOT EXISTS {table}_ledger (sink VARCHAR(200), batch BIGINT, PRIMARY KEY (sink, batch))")
        conn.commit()
    finally:
        conn.close()


def write_jdbc_upsert(df: DataFrame, connect: Callable[[], object], table: str = JDBC_TABLE, key: str = "id",
                      seq: str = "seq", field: str = "temperature", paramstyle: str = "qmark", chunk: int = 500,
                      batch_id: int | None = None, sink: str = "default", merge: str = "update_insert") -> bool:
    """Upsert the latest ``field`` per key. ``connect()`` returns a DB-API connection (URL and credentials are the
    caller's, not hard-coded); staging table and ledger are made by :func:`create_upsert_tables`.

    Each task puts its rows into the staging table, in one transaction that first removes what an earlier attempt of
    the task left. Then one transaction enters (``sink``, ``batch_id``) in the ledger, merges the staged rows into the table
    by set-based statements (``MERGE``) and empties the stage: all of a batch or nothing of it is seen, and a batch that
    the ledger has is not applied again, even if a later batch was. Returns whether it was applied; without ``batch_id``
    it always is. Rows with a null key are left out: ``t.id = s.id`` finds nothing for them."""
    ph = "?" if paramstyle == "qmark" else "%s"
    batch = -1 if batch_id is None else batch_id
    create_upsert_tables(connect, table)
    rows = latest_per_key(df.where(F.col(key).isNotNull()), key, seq, [field])

    def known(cur) -> bool:
        cur.execute(f"SELECT 1 FROM {table}_ledger WHERE sink = {ph} AND batch = {ph}", (sink, batch))
        return cur.fetchone() is not None

    conn = connect()
    try:
        if batch_id is not None and known(conn.cursor()):
            return False
        conn.cursor().execute(f"DELETE FROM {table}_stage WHERE sink = {ph} AND batch = {ph}", (sink, batch))  # of a broken attempt
        conn.commit()
    finally:
        conn.close()

    def stage(part):
        from pyspark import TaskContext

        me = TaskContext.get().partitionId()
        conn = connect()
        try:
            cur = conn.cursor()
            cur.execute(f"DELETE FROM {table}_stage WHERE sink = {ph} AND batch = {ph} AND part = {ph}", (sink, batch, me))
            while some := [(sink, batch, me, r[0], r[1]) for r in itertools.islice(part, chunk)]:
                cur.executemany(f"INSERT INTO {table}_stage (sink, batch, part, id, temp) VALUES ({ph}, {ph}, {ph}, {ph}, {ph})", some)
            conn.commit()
        finally:
            conn.close()

    rows.foreachPartition(stage)
    mine = f"(SELECT id, temp FROM {table}_stage WHERE sink = {ph} AND batch = {ph})"
    conn = connect()
    try:
        cur = conn.cursor()
        if batch_id is not None:
            cur.execute(f"INSERT INTO {table}_ledger (sink, batch) VALUES ({ph}, {ph})", (sink, batch))
        for statement in MERGE[merge]:
            text = statement.format(table=table, mine=mine)
            cur.execute(text, (sink, batch) * text.count(mine))
        cur.execute(f"DELETE FROM {table}_stage WHERE sink = {ph} AND batch = {ph}", (sink, batch))
        conn.commit()
    finally:
        conn.close()
    return True


def upsert_each_batch(writer: Callable[[DataFrame, int], object]) -> Callable[[DataFrame, int], None]:
    """Adapter for ``writeStream.foreachBatch``: ``writer(rows, batch_id)``, e.g.
    ``lambda rows, b: write_jdbc_upsert(rows, connect, batch_id=b)``."""
    return lambda batch_df, batch_id: writer(batch_df, batch_id) and None
