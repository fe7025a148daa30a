from tempest.operators import alarms, count_windows, rolling

from .conftest import rel


def by_seq(df):
    return {r.seq: r for r in df.collect()}


def test_rolling_max_by_first_wins(sensor_df):
    got = by_seq(rolling.rolling_max_by(sensor_df))
    assert [got[s].max_seq for s in range(13)] == [0, 1, 2, 3, 4, 4, 6, 6, 1, 6, 2, 6, 12]


def test_rolling_reduce(sensor_df):
    got = by_seq(rolling.rolling_reduce_max(sensor_df))
    assert [(got[s].id, rel(got[s].timestamp), got[s].temperature) for s in (5, 9, 11, 12)] == [
        ("sensor_1", 209, 36.3), ("sensor_1", 204, 37.1), ("sensor_1", 206, 37.1), ("sensor_10", 291, 48.1)]


def test_keyed_count(sensor_df):
    got = by_seq(rolling.keyed_count(sensor_df))
    assert [got[s].cnt for s in range(13)] == [1, 1, 1, 1, 2, 3, 4, 5, 2, 6, 2, 7, 2]


def test_rolling_sum_keeps_first_record_fields(sensor_df):
    got = by_seq(rolling.rolling_sum(sensor_df))
    assert rel(got[4].timestamp) == 199 and abs(got[4].temperature - 72.1) < 1e-9


def test_jump_alarm_inclusive_threshold(sensor_df):
    got = sorted((r.id, r.last_temp, r.temperature) for r in alarms.jump_alarm(sensor_df, 10.0).collect())
    assert got == [("sensor_1", 29.0, 10.0), ("sensor_10", 38.1, 48.1)]


def test_count_window_slide(sensor_df):
    got = {r.seq: round(r.avg_temp, 6) for r in count_windows.count_window_slide(sensor_df, 10, 2).collect()}
    assert got == {4: 36.05, 6: 35.5, 8: 15.4, 9: 33.5, 10: 1.85, 12: 43.1}


def test_count_window_tumble_needs_full_block(sensor_df):
    assert count_windows.count_window_tumble(sensor_df, 10).count() == 0
    got = count_windows.count_window_tumble(sensor_df, 2).collect()
    assert sorted((r.id, r.block, round(r.avg_temp, 6)) for r in got)[:2] == [("sensor_1", 0, 36.05), ("sensor_1", 1, 34.95)]


def test_rise_alarm_fixture(rise_df):
    got = sorted((r.id, r.fire_ts) for r in alarms.rise_alarm(rise_df, 10).collect())
    assert got == [("sensor_1", 10), ("sensor_1", 37), ("sensor_2", 12)]
    msg = alarms.rise_alarm(rise_df, 10).where("fire_ts = 10").first().message
    assert msg == "传感器sensor_1温度值连续10s上升"


def test_count_window_slide_larger_than_size(sensor_df):
    # sensor_1 readings in order: 35.8, 36.3, 32.8, 37.1, 30.0, 29.0, 10.0 -> fire at the 3rd and 6th
    got = sorted((r.seq, round(r.avg_temp, 6)) for r in count_windows.count_window_slide(sensor_df, 2, 3).where("id = 'sensor_1'").collect())
    assert got == [(5, round((36.3 + 32.8) / 2, 6)), (9, round((30.0 + 29.0) / 2, 6))]
