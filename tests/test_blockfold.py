"""A user's reduce function and the rise alarm in parallel blocks against a record-by-record model."""

import random

import pytest
from pyspark.sql import functions as F

from tempest.operators.blockfold import UserReduce, each_block


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def joined(a, b):
    """Associative, not commutative: the order of the records shows."""
    return {"word": a["word"] + b["word"], "n": a["n"] + b["n"]}


def rows_of(n, seed):
    r = random.Random(seed)
    return [(i, r.choice(["hot", "hot", "b", None]), r.choice("xyz") if r.random() < 0.9 else None, r.randint(0, 3)) for i in range(n)]


def model(rows):
    acc, out = {}, []
    for seq, key, word, n in sorted(rows):
        acc[key] = joined(acc[key], {"word": word, "n": n}) if key in acc else {"word": word or "", "n": n}
        out.append((key, seq, acc[key]["word"], acc[key]["n"]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 5, 1000])
def test_user_reduce_equals_the_record_loop(spark, block):
    rows = [(i, k, w or "", n) for i, k, w, n in rows_of(60, 1)]
    df = spark.createDataFrame(rows, "seq long, id string, word string, n long")
    op = UserReduce(joined, ("word", "n"), rows=block)
    got = op.run(df).select("id", "seq", "word", "n").collect()
    assert sorted(map(tuple, got), key=repr) == model(rows)


def test_user_reduce_goes_on_from_a_state_and_on_a_stream(spark, tmp_path):
    from tempest.streaming import folds

    rows = [(i, k, w or "", n) for i, k, w, n in rows_of(30, 2)]
    schema = "seq long, id string, word string, n long"
    op = UserReduce(joined, ("word", "n"), rows=4)
    first, second = (spark.createDataFrame(p, schema) for p in (rows[:13], rows[13:]))
    out = op.run(first).unionByName(op.run(second, op.totals(first)))
    assert sorted(map(tuple, out.select("id", "seq", "word", "n").collect()), key=repr) == model(rows)
    for part in (second, first):  # out of order: the second file corrects what the first gave out
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = folds.run_keyed(s, op, "ur", str(tmp_path / "ur")).select("id", "seq", "word", "n").collect()
    assert sorted(map(tuple, got), key=repr) == model(rows)


def test_groups_over_several_batches_stay_whole(spark):
    import pyarrow as pa

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("s"))
        count = each_block(df, ["k"], "s", lambda t: pa.table({"k": t["k"].slice(0, 1), "n": [t.num_rows], "up": [t["s"].to_pylist() == sorted(t["s"].to_pylist())]}),
                           "k long, n long, up boolean")
        assert sorted(map(tuple, count.collect())) == [(0, 34, True), (1, 33, True), (2, 33, True)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_empty_input(spark):
    df = spark.createDataFrame([], "seq long, id string, word string, n long")
    assert UserReduce(joined, ("word", "n")).run(df).collect() == []


def naive(t, rise, fall, interval, fire):
    from tempest.operators.alarms import replay

    return replay(t, rise, fall, interval, fire)[1]


@pytest.mark.parametrize("seed", range(30))
def test_timer_maps_are_the_replay_as_a_function(seed):
    from tempest.operators.alarms import TimerMap

    r = random.Random(seed)
    runs = []
    for _ in range(r.randint(1, 5)):
        n = r.randint(1, 12)
        t = [None if r.random() < 0.05 else x for x in ([r.randint(0, 60) for _ in range(n)] if seed % 2 else sorted(r.randint(0, 60) for _ in range(n)))]
        kind = [r.choice("rr=" if seed % 3 else "rrf=") for _ in range(n)]
        runs.append((t, [k == "r" for k in kind], [k == "f" for k in kind]))
    interval = r.randint(0, 20)
    whole = None
    for run in runs:
        m = TimerMap.of(*run, interval)
        for fire in (None, *range(-1, 90)):
            assert m(fire) == naive(*run, interval, fire)
        whole = m if whole is None else whole.then(m)
    for fire in (None, *range(-1, 90)):
        want = fire
        for run in runs:
            want = naive(*run, interval, want)
        assert whole(fire) == want


def test_rise_alarm_of_one_long_rising_sensor(spark):
    from tempest.operators import alarms

    r = random.Random(1)
    t, rows = 0, []
    for i in range(3000):
        t += r.randint(0, 3)
        rows.append((i, "a" if i % 10 else "b", t, float(i if i % 7 else i - 1)))
    df = spark.createDataFrame(rows, "seq long, id string, timestamp long, temperature double")
    op = alarms.RiseAlarm(50, rows=16)
    out, state = op.both(df, block=64)
    got = sorted((x.id, x.fire_ts) for x in out.unionByName(op.at_end(state)).collect())
    want = []
    for k in "ab":
        mine = [x for x in rows if x[1] == k]
        last, fire = alarms.RISE_INITIAL_LAST, None
        for _, _, t, v in mine:
            if fire is not None and t > fire:
                want.append((k, fire))
                fire = None
            if v > last and fire is None:
                fire = t + 50
            elif v < last:
                fire = None
            last = v
        if fire is not None and fire <= rows[-1][2]:
            want.append((k, fire))
    assert got == sorted(want) and len(got) > 50


def test_records_without_a_carry_do_not_go_through_the_function_again(spark):
    """Every record is reduced once in its block; only records with both a carry and a result are merged."""
    from pyspark.sql import functions as F

    rows = [(f"k{i % 50}" if i % 7 else None, i, float(i * 31 % 97)) for i in range(2_000)]
    df = spark.createDataFrame(rows, "id string, seq long, v double").repartition(4)
    calls = spark.sparkContext.accumulator(0)

    def add(a, b):
        calls.add(1)
        return {"v": a["v"] + b["v"]}

    got = {(r.id, r.seq): r.v for r in UserReduce(add, ("v",)).run(df).collect()}
    want, now = {}, {}
    for k, s, v in rows:
        now[k] = now.get(k, 0.0) + v
        want[k, s] = now[k]
    assert got == want
    seed = df.groupBy("id").agg((F.max("v") * 0 + 1).alias("one"))
    merged = UserReduce(add, ("v",))._merged(seed.select("id", F.when(F.col("id") == "k1", F.struct(F.col("one").alias("v"))).alias("a"),
                                                          F.when(F.col("id") != "k2", F.struct((F.col("one") * 2).alias("v"))).alias("b")), "a", "b", "m")
    assert {r.id: r.m and r.m.v for r in merged.collect()} == {k: 3.0 if k == "k1" else None if k is None or k == "k2" else 2.0 for k in now}


def test_user_reduce_works_on_batches_of_many_keys(spark, monkeypatch):
    """Neither a key nor a block costs a call of its own: batches hold many, and a key goes on over batches."""
    from tempest.operators import blockfold

    def refused(*a, **k):
        raise AssertionError("a call per group")

    monkeypatch.setattr(blockfold, "each_block", refused)
    rows = [("hot" if i % 2 else f"k{i % 5000}" if i % 8 else None, i, float(i * 31 % 97)) for i in range(24_000)]
    df = spark.createDataFrame(rows, "id string, seq long, v double").repartition(3)
    want, now = {}, {}
    for k, s, v in rows:
        now[k] = now.get(k, 0.0) + v
        want[k, s] = now[k]
    for block in (1 << 16, 512):
        out, state = UserReduce(lambda a, b: {"v": a["v"] + b["v"]}, ("v",)).both(df, block=block)
        assert {(r.id, r.seq): r.v for r in out.collect()} == want
        assert {r.id: r.acc.v for r in state.collect()} == now


def test_rise_alarm_hands_on_a_row_per_block_and_not_per_record(spark, monkeypatch):
    """What is written between the steps are rows of blocks; records are shuffled once and small groups share Arrow batches."""
    from tempest.operators import alarms

    r = random.Random(3)
    rows, t = [], 0
    for i in range(12_000):
        t += r.randint(-1, 2)
        k = "hot" if i % 2 else f"k{i % 400}" if i % 16 else None
        rows.append((i, k, t if i % 101 else None, float(i if i % 7 else r.randint(0, i)) if i % 97 else None))
    df = spark.createDataFrame(rows, "seq long, id string, timestamp long, temperature double").repartition(3)
    written, plain = {}, alarms.materialize

    def spied(d, name):
        out = plain(d, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(alarms, "materialize", spied)
    op = alarms.RiseAlarm(40, rows=2048)
    out, state = op.both(df)
    blocks = len({(k, i // 2048) for i, k, _, _ in rows})
    assert max(written.values()) <= blocks < len(rows) / 4
    want, left = [], {}
    for i, k, x, v in rows:
        last, fire = left.get(k, (alarms.RISE_INITIAL_LAST, None))
        if fire is not None and x is not None and x > fire:
            want.append((str(k), i, fire))
            fire = None
        if None not in (last, v) and v > last:
            fire = x + 40 if fire is None and x is not None else fire
        elif None not in (last, v) and v < last:
            fire = None
        left[k] = v, fire
    assert sorted((str(x.id), x.seq, x.fire_ts) for x in out.collect()) == sorted(want) and len(want) > 50
    assert {x.id: (x.last, x.fire) for x in state.collect()} == left


@pytest.mark.parametrize("seed", range(12))
def test_blocks_of_a_batch_are_looked_at_together(seed, monkeypatch):
    """First looks give what a replay of each block by itself gives, without a Python call for each block with a fall."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    from tempest.operators import alarms
    from tempest.operators.blockfold import whole_groups

    r = random.Random(seed)
    rows, seq = [], 0
    for g in range(300):
        t, kinds = 0, "rrrrrf=" if seed % 3 else "rf="
        for _ in range(r.choice([1, 3, 40, 200]) if g % 50 else 2_000):
            seq, t = seq + 1, t + r.randint(-2, 6)
            kind = r.choice(kinds if g % 9 else "rrr=")
            rows.append((None if g == 3 else f"k{g // 2}", g % 2, seq, None if r.random() < 0.02 else t, None if r.random() < 0.02 else kind == "r", kind == "f"))
    t = pa.table(list(zip(*rows)), names=["id", "_blk", "seq", "_t", "_rise", "_fall"])
    schema = to_arrow_schema(StructType.fromDDL("id string, _blk long, always boolean, idle long, bounds array<long>, outs array<long>, _seq array<long>, "
                                                "_t array<long>, _rise array<boolean>, _falls boolean, _at array<long>, _fired array<long>"))
    calls, plain = [], alarms.replay
    monkeypatch.setattr(alarms, "replay", lambda *a: calls.append(1) or plain(*a))
    got, batches = [], 0
    for rb, starts in whole_groups(iter(t.to_batches(max_chunksize=1_000)), ["id", "_blk"]):
        got += alarms._first_look(rb, starts, "id", "seq", 9, schema).to_pylist()
        batches += 1
    whole = len({(x[0], x[1]) for x in rows if x[5]})
    assert len(calls) <= batches * alarms.FEW_RUNS and whole > 100
    monkeypatch.undo()
    groups = {}
    for x in rows:
        groups.setdefault(x[:2], []).append(x[2:])
    assert [(x["id"], x["_blk"]) for x in got] == list(groups)
    for x, own in zip(got, groups.values()):
        at, ts, rise, fall = (list(c) for c in zip(*own))
        cut = fall.index(True) + 1 if True in fall else len(at)
        fired, left = plain(ts, rise, fall, 9, None, cut) if True in fall else ([], None)
        assert (x["_seq"], x["_t"], x["_rise"], x["_falls"]) == (at[:cut], ts[:cut], [bool(v) for v in rise[:cut]], True in fall)
        assert (x["_at"], x["_fired"]) == ([at[i] for i, _ in fired], [f for _, f in fired])
        m = alarms.TimerMap.of(ts, rise, fall, 9)
        assert (x["always"], x["idle"], x["bounds"], x["outs"]) == (m.always, m.idle, m.bounds, m.outs)
        assert True not in fall or x["idle"] == left
