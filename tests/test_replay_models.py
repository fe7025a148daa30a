"""P10 and W6 batch replays against a per-record Python simulation on random short inputs with
out-of-order times, repeated temperatures and tiny blocks (so keys span several blocks)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tempest.operators import alarms, late_windows

INIT = 4.9e-324


def rise_model(rows, interval):
    state, out = {}, []
    for seq, k, t, v in sorted(rows):
        last, fire = state.get(k, (INIT, None))
        if fire is not None and t > fire:
            out.append((k, fire))
            fire = None
        if v > last and fire is None:
            fire = t + interval
        elif v < last and fire is not None:
            fire = None
        state[k] = (v, fire)
    gmax = max(t for _, _, t, _ in rows)
    out += [(k, f) for k, (_, f) in state.items() if f is not None and f <= gmax]
    return sorted(out)


def late_model(rows, size, delay, lateness):
    maxts, best, late = None, {}, []
    for seq, k, t, v, a in sorted(rows, key=lambda r: (r[4], r[0])):
        end = (t // size) * size + size
        if maxts is not None and maxts >= end + lateness + delay:
            late.append(seq)
        else:
            cand = (v, a, seq)
            best[(k, end)] = min(best.get((k, end), cand), cand)
        maxts = t if maxts is None else max(maxts, t)
    return sorted((k, e, b[2]) for (k, e), b in best.items()), sorted(late)


@st.composite
def readings(draw):
    n = draw(st.integers(5, 40))
    t, rows = 100, []
    for seq in range(n):
        t += draw(st.integers(-6, 9))
        rows.append((seq, draw(st.sampled_from(["a", "b", "c"])), t, float(draw(st.integers(-2, 3)))))
    return rows


@settings(max_examples=6, deadline=None)
@given(readings(), st.integers(1, 12))
def test_rise_alarm_matches_state_machine(spark, rows, interval):
    df = spark.createDataFrame(rows, "seq long, id string, timestamp long, temperature double")
    got = sorted((r.id, r.fire_ts) for r in alarms.rise_alarm(df, interval, block=4).collect())
    assert got == rise_model(rows, interval)


@settings(max_examples=6, deadline=None)
@given(readings(), st.integers(2, 10), st.integers(0, 5), st.integers(0, 10))
def test_late_windows_match_simulation(spark, rows, size, delay, lateness):
    arr = [(s, k, t, v, s + (7 if s % 5 == 0 else 0)) for s, k, t, v in rows]
    df = spark.createDataFrame(arr, "seq long, id string, timestamp long, temperature double, arrival long")
    main, late = late_windows.late_window_min_by(df, size, delay, lateness, block=4)
    want_main, want_late = late_model(arr, size, delay, lateness)
    assert sorted((r.id, r.window_end, r.seq) for r in main.collect()) == want_main
    assert sorted(r.seq for r in late.collect()) == want_late


def emissions_model(rows, size, delay, lateness):
    maxts, state, out = None, {}, []
    for seq, k, t, v, a in sorted(rows, key=lambda r: (r[4], r[0])):
        end = (t // size) * size + size
        if not (maxts is not None and maxts >= end + lateness + delay):
            best, fired = state.get((k, end), (None, False))
            best = min(best, (v, a, seq)) if best else (v, a, seq)
            if fired or (maxts is not None and maxts - delay >= end):
                out.append((seq, k, end, best[2]))
                fired = True
            state[(k, end)] = (best, fired)
        maxts = t if maxts is None else max(maxts, t)
        for (kk, e), (b, f) in list(state.items()):
            if not f and e <= maxts - delay:
                out.append((seq, kk, e, b[2]))
                state[(kk, e)] = (b, True)
    return sorted(out)


@settings(max_examples=6, deadline=None)
@given(readings(), st.integers(2, 10), st.integers(0, 5), st.integers(0, 10))
def test_late_window_emissions_match_simulation(spark, rows, size, delay, lateness):
    arr = [(s, k, t, v, s + (7 if s % 5 == 0 else 0)) for s, k, t, v in rows]
    df = spark.createDataFrame(arr, "seq long, id string, timestamp long, temperature double, arrival long")
    got = late_windows.late_window_emissions(df, size, delay, lateness, block=4)
    assert sorted((r.emitted_after, r.id, r.window_end, r.seq) for r in got.collect()) == emissions_model(arr, size, delay, lateness)


def test_rise_alarm_long_segments_match_state_machine(spark):
    import random

    rnd = random.Random(7)
    rows, t, v = [], 1000, 0.0
    for seq in range(600):
        t += rnd.choice([1, 2, 3, 5, -2])                        # times mostly forward, some backward steps
        v += rnd.choice([0.5, 0.5, 1.0, 0.0]) if seq % 211 else -50.0  # long rising runs, rare falls
        rows.append((seq, "s", t, v))
    df = spark.createDataFrame(rows, "seq long, id string, timestamp long, temperature double")
    for interval in (3, 17):
        got = sorted((r.id, r.fire_ts) for r in alarms.rise_alarm(df, interval, block=64).collect())
        assert got == rise_model(rows, interval)


def rolling_models(rows):
    """Per record, in seq order per key: count, sum (nulls ignored), max (nulls ignored), and the
    max-by row (nulls lowest, earliest row on ties)."""
    out, state = {}, {}
    for seq, k, v in sorted(rows):
        n, s, m, best = state.get(k, (0, None, None, None))
        n += 1
        s = s if v is None else (v if s is None else s + v)
        m = m if v is None else (v if m is None else max(m, v))
        rank = (v is not None, v if v is not None else 0.0)
        if best is None or rank > best[0]:
            best = (rank, seq)
        state[k] = (n, s, m, best)
        out[seq] = (n, s, m, best[1])
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(-3, 3).map(float))), min_size=1, max_size=40),
       st.integers(1, 6))
def test_rolling_ops_match_python_model(spark, items, block):
    from tempest.operators import rolling

    rows = [(i, k, v) for i, (k, v) in enumerate(items)]
    df = spark.createDataFrame([(i, k, 100 + i, v) for i, k, v in rows], "seq long, id string, timestamp long, temperature double")
    want = rolling_models(rows)
    cnt = {r.seq: r.cnt for r in rolling.keyed_count(df, block=block).collect()}
    sm = {r.seq: r.temperature for r in rolling.rolling_sum(df, block=block).collect()}
    mx = {r.seq: r.temperature for r in rolling.rolling_reduce_max(df, block=block).collect()}
    mb = {r.seq: r.max_seq for r in rolling.rolling_max_by(df, block=block).collect()}
    for seq, (n, s, m, b) in want.items():
        assert cnt[seq] == n
        assert (sm[seq] is None and s is None) or abs(sm[seq] - s) < 1e-9
        assert mx[seq] == m
        assert mb[seq] == b
