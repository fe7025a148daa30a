"""Oracle SQL (DuckDB dialect) for the registered queries: the straightforward formulation, per-key
windows and a recursive replay, written independently of the Spark plans."""

from __future__ import annotations

from tempest.plans.registry import (
    DAY,
    HIGH_THRESHOLD,
    JUMP_THRESHOLD,
    LATE_DELAY,
    LATE_EVERY,
    LATE_LATENESS,
    LATE_SHIFT,
    LATE_SIZE,
    RISE_INTERVAL,
    SLIDE,
)

SENSOR = """sensor AS (
  SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
         value AS temperature,
         event_id AS seq
  FROM events)"""

LINES = """lines AS (
  SELECT seq, id || ',' || CAST("timestamp" AS VARCHAR) || ',' || CAST(temperature AS VARCHAR) AS line FROM sensor)"""

W_SEQ = "(PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["word_count"] = """
WITH lines AS (
  SELECT regexp_replace(unnest(string_split(regexp_replace(text, chr(10) || '$', ''), chr(10))), chr(13) || '$', '') AS line
  FROM documents WHERE text IS NOT NULL AND text <> ''),
words AS (
  SELECT unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN CAST([] AS VARCHAR[])
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines)
SELECT word, count(*) AS cnt FROM words GROUP BY word"""

ORACLE["running_word_count"] = """
WITH docs AS (
  SELECT doc_id, flatten(list_transform(
           string_split(regexp_replace(text, chr(10) || '$', ''), chr(10)),
           lambda l: CASE WHEN regexp_replace(l, chr(13) || '$', '') = '' THEN ['']
                          WHEN rtrim(regexp_replace(l, chr(13) || '$', ''), ' ') = '' THEN CAST([] AS VARCHAR[])
                          ELSE string_split(rtrim(regexp_replace(l, chr(13) || '$', ''), ' '), ' ') END)) AS words
  FROM documents WHERE text IS NOT NULL AND text <> ''),
occ AS (
  SELECT doc_id, CAST(generate_subscripts(words, 1) - 1 AS INTEGER) AS pos, unnest(words) AS word FROM docs)
SELECT doc_id, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM occ"""

ORACLE["text_file_lines"] = _with(SENSOR, LINES) + "SELECT line FROM lines"
ORACLE["csv_table_roundtrip"] = _with(SENSOR) + "SELECT id, temperature FROM sensor"
ORACLE["csv_payload_roundtrip"] = _with(SENSOR) + 'SELECT id, "timestamp", temperature AS temp FROM sensor'

ORACLE["line_lengths"] = _with(SENSOR, LINES) + "SELECT seq, CAST(length(line) AS INTEGER) AS len FROM lines"

ORACLE["line_fields"] = _with(SENSOR, LINES) + """
SELECT seq, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS pos, unnest(parts) AS field
FROM (SELECT seq, string_split(line, ',') AS parts FROM lines)"""

ORACLE["prefix_filter"] = _with(SENSOR, LINES) + "SELECT seq, line FROM lines WHERE starts_with(line, 'sensor_1')"

ORACLE["parse_lines"] = _with(SENSOR, LINES) + """
SELECT seq, split_part(line, ',', 1) AS id, CAST(split_part(line, ',', 2) AS BIGINT) AS "timestamp",
       CAST(split_part(line, ',', 3) AS DOUBLE) AS temperature
FROM lines"""

ORACLE["reading_text"] = _with(SENSOR) + """
SELECT seq, 'SensorReading{id=''' || id || ''', timestamp=' || CAST("timestamp" AS VARCHAR)
            || ', temperature=' || CAST(temperature AS VARCHAR) || '}' AS text
FROM sensor"""

ORACLE["select_where"] = _with(SENSOR) + "SELECT id, temperature FROM sensor WHERE id = 'sensor_1'"
ORACLE["select_where_sql"] = ORACLE["select_where"]

ORACLE["split_high"] = _with(SENSOR) + f'SELECT seq, id, "timestamp", temperature FROM sensor WHERE temperature > {HIGH_THRESHOLD}'
ORACLE["split_low"] = _with(SENSOR) + f"""
SELECT seq, id, "timestamp", temperature FROM sensor WHERE NOT coalesce(temperature > {HIGH_THRESHOLD}, false)"""
ORACLE["union_all"] = _with(SENSOR) + """
SELECT seq, id, "timestamp", temperature FROM sensor
UNION ALL
SELECT seq, id, "timestamp", temperature FROM sensor"""

ORACLE["connect_map"] = _with(SENSOR) + f"""
SELECT seq, id, CASE WHEN temperature > {HIGH_THRESHOLD} THEN temperature END AS temperature,
       CASE WHEN temperature > {HIGH_THRESHOLD} THEN 'high temp warning' ELSE 'normal' END AS status
FROM sensor"""

ORACLE["side_outputs"] = _with(SENSOR) + f"""
SELECT seq, id, "timestamp", temperature,
       CASE WHEN temperature > {HIGH_THRESHOLD} THEN 'main' ELSE 'lowTemp' END AS tag
FROM sensor"""

ORACLE["rolling_sum"] = _with(SENSOR) + f"""
SELECT seq, id, first_value("timestamp") OVER w AS "timestamp", round(sum(temperature) OVER w, 6) AS temperature
FROM sensor WINDOW w AS {W_SEQ}"""

ORACLE["rolling_max_by"] = _with(SENSOR) + f"""
SELECT seq, id, -b.ns AS max_seq, b.t AS "timestamp", b.v AS temperature
FROM (SELECT seq, id, max({{'v': temperature, 'ns': -seq, 't': "timestamp"}}) OVER w AS b FROM sensor WINDOW w AS {W_SEQ})"""

ORACLE["rolling_reduce"] = _with(SENSOR) + f"""
SELECT seq, id, "timestamp", max(temperature) OVER w AS temperature FROM sensor WINDOW w AS {W_SEQ}"""

ORACLE["keyed_count"] = _with(SENSOR) + f"SELECT seq, id, count(*) OVER w AS cnt FROM sensor WINDOW w AS {W_SEQ}"

ORACLE["shard_count"] = _with(SENSOR) + """
SELECT seq, seq % 4 AS shard,
       count(*) OVER (PARTITION BY seq % 4 ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM sensor"""

ORACLE["group_count_avg"] = _with(SENSOR) + "SELECT id, count(id) AS cnt, round(avg(temperature), 6) AS avg_temp FROM sensor GROUP BY id"
ORACLE["group_count_avg_sql"] = ORACLE["group_count_avg"]
ORACLE["avg_temp_udaf"] = _with(SENSOR) + "SELECT id, round(sum(temperature) / count(temperature), 6) AS avg_temp FROM sensor GROUP BY id"

ORACLE["retract_changelog"] = _with(SENSOR) + f"""
, r AS (
  SELECT seq, id, count(*) OVER w AS n, round(sum(temperature) OVER w, 6) AS s,
         round(sum(temperature) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS s_prev
  FROM sensor WINDOW w AS {W_SEQ})
SELECT true AS flag, seq, id, n AS cnt, s AS sum_temp, round(s / n, 6) AS avg_temp FROM r
UNION ALL
SELECT false AS flag, seq, id, n - 1 AS cnt, s_prev AS sum_temp, round(s_prev / (n - 1), 6) AS avg_temp FROM r WHERE n > 1"""

ORACLE["retract_avg_temp"] = _with(SENSOR) + f"""
, r AS (
  SELECT seq, id, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn, round(round(sum(temperature) OVER w, 6) / count(temperature) OVER w, 6) AS a,
         round(round(sum(temperature) OVER v, 6) / count(temperature) OVER v, 6) AS a_prev
  FROM sensor WINDOW w AS {W_SEQ}, v AS (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT true AS flag, seq, id, a AS avg_temp FROM r
UNION ALL
SELECT false AS flag, seq, id, a_prev AS avg_temp FROM r WHERE rn > 1"""

ORACLE["user_accumulator"] = _with(SENSOR) + f"""
SELECT id, ("timestamp" // {DAY}) * {DAY} + {DAY} AS window_end, count(temperature) AS cnt,
       round(round(sum(temperature), 6) / count(temperature), 6) AS avg_temp, round(max(temperature) - min(temperature), 6) AS spread
FROM sensor GROUP BY id, window_end"""

ORACLE["tumble_count"] = _with(SENSOR) + f"""
SELECT id, ("timestamp" // {DAY}) * {DAY} + {DAY} AS window_end, count(*) AS cnt FROM sensor GROUP BY ALL"""

ORACLE["tumble_sum_first"] = _with(SENSOR) + f"""
SELECT id, window_end, min(seq) AS first_seq, arg_min("timestamp", seq) AS "timestamp", round(sum(temperature), 6) AS temperature
FROM (SELECT *, ("timestamp" // {DAY}) * {DAY} + {DAY} AS window_end FROM sensor) GROUP BY id, window_end"""

ORACLE["tumble_count_avg"] = _with(SENSOR) + f"""
SELECT id, count(id) AS cnt, round(avg(temperature), 6) AS avg_temp, ("timestamp" // {DAY}) * {DAY} + {DAY} AS window_end
FROM sensor GROUP BY id, window_end"""
ORACLE["tumble_count_avg_sql"] = ORACLE["tumble_count_avg"]

ORACLE["slide_count"] = _with(SENSOR) + f"""
SELECT id, ("timestamp" // {SLIDE} - j) * {SLIDE} + {DAY} AS window_end, count(*) AS cnt
FROM sensor, range(0, {DAY // SLIDE}) AS r(j) GROUP BY ALL"""

ORACLE["count_window_tumble"] = _with(SENSOR) + """
SELECT id, (rn - 1) // 10 AS block, round(avg(temperature), 6) AS avg_temp
FROM (SELECT id, temperature, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM sensor)
GROUP BY id, block HAVING count(*) = 10"""

ORACLE["count_window_slide"] = _with(SENSOR) + """
SELECT id, seq, avg_temp FROM (
  SELECT id, seq, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn,
         round(avg(temperature) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS avg_temp
  FROM sensor)
WHERE rn % 2 = 0"""

ORACLE["over_rows"] = _with(SENSOR) + """
SELECT id, "timestamp" AS ts, seq, count(id) OVER ow AS cnt, round(avg(temperature) OVER ow, 6) AS avg_temp
FROM sensor WINDOW ow AS (PARTITION BY id ORDER BY "timestamp", seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
ORACLE["over_rows_sql"] = ORACLE["over_rows"]

ORACLE["jump_alarm"] = _with(SENSOR) + f"""
SELECT id, seq, last_temp, temperature FROM (
  SELECT id, seq, lag(temperature) OVER (PARTITION BY id ORDER BY seq) AS last_temp, temperature FROM sensor)
WHERE last_temp IS NOT NULL AND abs(temperature - last_temp) >= {JUMP_THRESHOLD}"""

ORACLE["rise_alarm"] = "WITH RECURSIVE " + SENSOR + f""",
s AS (SELECT id, "timestamp" AS t, temperature AS v, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM sensor),
st(id, rn, last, fire, alarm) AS (
  SELECT id, CAST(0 AS BIGINT), CAST('4.9e-324' AS DOUBLE), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM (SELECT DISTINCT id FROM s)
  UNION ALL
  SELECT s.id, s.rn, s.v,
         CASE WHEN st.fire IS NULL OR s.t > st.fire
              THEN (CASE WHEN s.v > st.last THEN s.t + {RISE_INTERVAL} END)
              ELSE (CASE WHEN s.v < st.last THEN NULL ELSE st.fire END) END,
         CASE WHEN st.fire IS NOT NULL AND s.t > st.fire THEN st.fire END
  FROM st JOIN s ON s.id = st.id AND s.rn = st.rn + 1),
fired AS (
  SELECT id, alarm AS fire_ts FROM st WHERE alarm IS NOT NULL
  UNION ALL
  SELECT st.id, st.fire AS fire_ts
  FROM st JOIN (SELECT id, max(rn) AS m FROM st GROUP BY id) e ON st.id = e.id AND st.rn = e.m
  WHERE st.fire IS NOT NULL AND st.fire <= (SELECT max("timestamp") FROM sensor))
SELECT id, fire_ts, '传感器' || id || '温度值连续' || '{RISE_INTERVAL}' || 's上升' AS message FROM fired"""

_LATE = _with(SENSOR) + f""", a AS (
  SELECT *, CASE WHEN seq % {LATE_EVERY} = 0 THEN seq + {LATE_SHIFT} ELSE seq END AS arrival FROM sensor),
f AS (
  SELECT *, ("timestamp" // {LATE_SIZE}) * {LATE_SIZE} + {LATE_SIZE} AS window_end,
         max("timestamp") OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_before
  FROM a),
l AS (SELECT *, coalesce(max_before >= window_end + {LATE_LATENESS + LATE_DELAY}, false) AS is_late FROM f)
"""

ORACLE["late_window_main"] = _LATE + """
SELECT id, window_end, seq, "timestamp", temperature FROM (
  SELECT *, row_number() OVER (PARTITION BY id, window_end ORDER BY temperature, arrival, seq) AS rk
  FROM l WHERE NOT is_late)
WHERE rk = 1"""

ORACLE["late_window_late"] = _LATE + 'SELECT seq, id, "timestamp", temperature FROM l WHERE is_late'

ORACLE["late_window_emissions"] = _LATE + f""",
kept AS (SELECT *, greatest(max_before, "timestamp") AS max_incl FROM l WHERE NOT is_late),
ends AS (SELECT DISTINCT window_end FROM kept WHERE window_end + {LATE_DELAY} <= (SELECT max("timestamp") FROM sensor)),
crossing AS (
  SELECT e.window_end, arg_min(f.seq, f.arrival * 4294967296 + f.seq) AS emitted_after
  FROM ends e JOIN f ON greatest(f.max_before, f."timestamp") >= e.window_end + {LATE_DELAY}
  GROUP BY e.window_end),
timer AS (
  SELECT k.id, k.window_end,
         min({{'v': k.temperature, 'a': k.arrival, 's': k.seq, 't': k."timestamp"}}) AS b
  FROM kept k JOIN ends USING (window_end)
  WHERE k.max_incl < k.window_end + {LATE_DELAY}
  GROUP BY k.id, k.window_end),
refire AS (
  SELECT id, window_end, seq AS emitted_after, due,
         min({{'v': temperature, 'a': arrival, 's': seq, 't': "timestamp"}})
           OVER (PARTITION BY id, window_end ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b
  FROM (SELECT *, coalesce(max_before >= window_end + {LATE_DELAY}, false) AS due FROM kept))
SELECT t.id, t.window_end, t.b.s AS seq, t.b.t AS "timestamp", t.b.v AS temperature, c.emitted_after
FROM timer t JOIN crossing c USING (window_end)
UNION ALL
SELECT id, window_end, b.s AS seq, b.t AS "timestamp", b.v AS temperature, emitted_after FROM refire WHERE due"""

ORACLE["late_window_flushed"] = ORACLE["late_window_emissions"] + f"""
UNION ALL
SELECT id, window_end, arg_min(seq, (temperature, arrival, seq)) AS seq, arg_min("timestamp", (temperature, arrival, seq)) AS "timestamp",
       min(temperature) AS temperature, CAST(NULL AS BIGINT) AS emitted_after
FROM kept WHERE window_end + {LATE_DELAY} > (SELECT max("timestamp") FROM sensor) GROUP BY id, window_end"""

ORACLE["hash_code"] = _with(SENSOR) + """
SELECT seq, id, "timestamp" AS ts,
       CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS hash_code
FROM (SELECT *, list_reduce(list_transform(string_split(id, ''), lambda c: CAST(unicode(c) AS BIGINT)),
                            lambda acc, x: (acc * 31 + x) % 4294967296) AS h FROM sensor)"""

ORACLE["split_lateral"] = _with(SENSOR) + """
SELECT seq, id, ts, word, CAST(length(word) AS INTEGER) AS length
FROM (SELECT seq, id, "timestamp" AS ts, unnest(string_split(id, '_')) AS word FROM sensor)"""
ORACLE["split_lateral_sql"] = ORACLE["split_lateral"]

ORACLE["hash_code_sql"] = ORACLE["hash_code"]
ORACLE["split_udtf_sql"] = ORACLE["split_lateral"]
ORACLE["avg_temp_sql"] = _with(SENSOR) + "SELECT id, count(temperature) AS cnt, round(sum(temperature), 4) AS sum_temp FROM sensor GROUP BY id"
ORACLE["rich_map"] = _with(SENSOR) + "SELECT seq, id, true AS in_range, CAST(1 AS INTEGER) AS opened FROM sensor"

# Streaming twins read the same input and must give the batch twin's answer.
ORACLE["stream_word_count"] = ORACLE["running_word_count"]
for _name in ("keyed_count", "shard_count", "jump_alarm", "rolling_max_by", "rolling_reduce", "retract_changelog", "count_window_slide",
              "rise_alarm", "over_rows", "tumble_count", "slide_count", "tumble_sum_first", "tumble_count_avg", "side_outputs"):
    ORACLE[f"stream_{_name}"] = ORACLE[_name]

# firings and late rows of the per-record replay, however the readings are cut into runs
ORACLE["stream_late_window"] = f"""
SELECT 'main' AS tag, id, window_end, seq, "timestamp", temperature, emitted_after FROM ({ORACLE["late_window_flushed"]})
UNION ALL
SELECT 'late' AS tag, id, CAST(NULL AS BIGINT) AS window_end, seq, "timestamp", temperature, CAST(NULL AS BIGINT) AS emitted_after
FROM ({ORACLE["late_window_late"]})"""
ORACLE["stream_reordered"] = ORACLE["retract_changelog"]
ORACLE["stream_last_by_type"] = """
SELECT event_id AS seq, 'sensor_' || user_id AS id, event_type, value,
       lag(value) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS last_value FROM events"""
ORACLE["stream_recent_values"] = """
SELECT event_id AS seq, 'sensor_' || user_id AS id, count(value) OVER w AS cnt, min(value) OVER w AS lo, max(value) OVER w AS hi
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
ORACLE["window_median"] = _with(SENSOR) + f"""
SELECT id, ("timestamp" // {DAY}) * {DAY} + {DAY} AS window_end, count(temperature) AS rows, round(median(temperature), 6) AS median
FROM sensor WHERE temperature IS NOT NULL GROUP BY ALL"""
ORACLE["user_reduce"] = ORACLE["stream_user_reduce"] = ORACLE["rolling_reduce"]

_LANDED = _with(SENSOR, LINES) + """, placed AS (
  SELECT row_number() OVER (ORDER BY seq % 7, seq) - 1 AS arrival, seq % 7 AS part,
         row_number() OVER (PARTITION BY seq % 7 ORDER BY seq) - 1 AS line_no, line FROM lines)
"""
ORACLE["lines_with_arrival"] = _LANDED + "SELECT arrival, part, line_no, line FROM placed"
ORACLE["stream_lines"] = _LANDED + "SELECT part, line_no, line, line_no AS from_first, true AS dense FROM placed"

# countWindow(10) on a stream: each full block of 10 readings of a key, reported at its 10th reading
ORACLE["stream_count_window_tumble"] = _with(SENSOR) + """
SELECT id, seq, avg_temp FROM (
  SELECT id, seq, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn,
         round(avg(temperature) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS avg_temp
  FROM sensor)
WHERE rn % 10 = 0"""
