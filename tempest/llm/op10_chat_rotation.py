"""Multi-party perspective rotation: every participant's view of a dialogue, rendered with loss masks.

For each conversation and each participant (each distinct speaker that is not the system), all turns are
rendered in order: the participant's own turns as assistant (target text), others as named users, system turns
as they are. The mask is the character spans of the participant's texts.

A view is a run of segments with a running character offset. The offset is a two-level prefix sum (blocks of
turns, then the blocks' totals), so one conversation with a third of all turns is spread over tasks; views are
cut into parts of about ``part_chars`` at segment ends, so no part collects more than that and one segment.
Only DataFrame operations are used.

Edge cases: null text is empty, a null speaker is named ``unknown``, a null turn comes first; a null conversation
id is a conversation of its own; repeated turns are all rendered (ties by speaker and text); a conversation with
system turns only has no views; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.operators.scan import keyed_running

PART_CHARS = 16_384
BLOCK_TURNS = 4_096
#: Fixed values of the rendered form.
SYSTEM = "system"
HEAD_SYSTEM = "<|system|>\n"
HEAD_ASSISTANT = "<|assistant|>\n"
END = "\n<|end|>\n"


def segments(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """One row per (conversation, perspective, turn): conv_id, perspective, turn, speaker, text, head (text before
    it), start (offset of the head in the view), size, target (is the text to be learned?)."""
    t = turns.select(
        turns[conv_col].alias("conv_id"), F.coalesce(turns[turn_col].cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(turns[speaker_col].cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(turns[text_col].cast("string"), F.lit("")).alias("text"))
    who = t.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("_c"), F.col("speaker").alias("perspective")).distinct()
    v = t.join(who, t["conv_id"].eqNullSafe(who["_c"])).drop("_c")
    target = F.col("speaker") == F.col("perspective")
    head = F.when(F.col("speaker") == SYSTEM, F.lit(HEAD_SYSTEM)).when(target, F.lit(HEAD_ASSISTANT)).otherwise(
        F.concat(F.lit("<|user name="), F.col("speaker"), F.lit("|>\n")))
    v = v.withColumns({"head": head, "target": target}).withColumn("size", F.length("head") + F.length("text") + len(END))
    v = keyed_running(v, ["conv_id", "perspective"], {"start": ("sum", F.col("size").cast("long"))}, "turn",
                      ["turn", "speaker", "text"], inclusive=False, block=BLOCK_TURNS)
    return v.withColumn("start", F.coalesce("start", F.lit(0).cast("long")))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """One row per (conversation, perspective, part): the rendered text, its turns, and the target spans
    (array of start, end: character places in the part's text)."""
    s = segments(turns, conv_col, turn_col, speaker_col, text_col).withColumn("part", F.floor(F.col("start") / part_chars))
    begin = F.col("s")[0]["start"]
    own = F.transform(F.filter("s", lambda x: x["target"]), lambda x: F.struct(
        (x["start"] - begin + F.length(x["head"])).alias("start"),
        (x["start"] - begin + F.length(x["head"]) + F.length(x["text"])).alias("end")))
    g = s.groupBy("conv_id", "perspective", "part").agg(
        F.array_sort(F.collect_list(F.struct("start", "turn", "speaker", "head", "text", "target"))).alias("s"))
    return g.select("conv_id", "perspective", "part", F.size("s").cast("long").alias("n_turns"),
                    F.concat_ws("", F.transform("s", lambda x: F.concat(x["head"], x["text"], F.lit(END)))).alias("text"),
                    own.alias("targets"))


def op10_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    spans = F.array_join(F.transform("targets", lambda x: F.concat_ws("-", x["start"], x["end"])), ",")
    return r.select("conv_id", "perspective", "part", "n_turns", F.length("text").cast("long").alias("n_chars"),
                    spans.alias("targets"), "text")


ORACLE_SQL = r"""
WITH t AS (SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
who AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM t WHERE speaker <> 'system'),
v AS (SELECT t.*, perspective, CASE WHEN speaker = 'system' THEN '<|system|>' || chr(10) WHEN speaker = perspective THEN '<|assistant|>' || chr(10)
             ELSE '<|user name=' || speaker || '|>' || chr(10) END AS head
      FROM t JOIN who ON t.conv_id IS NOT DISTINCT FROM who.c),
o AS (SELECT *, row_number() OVER w AS rn, coalesce(sum(length(head) + length(text) + 9) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM v WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn, speaker, text)),
p AS (SELECT *, CAST(floor(start / 16384) AS BIGINT) AS part FROM o),
q AS (SELECT *, start - min(start) OVER (PARTITION BY conv_id, perspective, part) + length(head) AS a FROM p)
SELECT conv_id, perspective, part, count(*) AS n_turns, CAST(sum(length(head) + length(text) + 9) AS BIGINT) AS n_chars,
       coalesce(string_agg(CASE WHEN speaker = perspective THEN CAST(a AS VARCHAR) || '-' || CAST(a + length(text) AS VARCHAR) END, ',' ORDER BY rn), '') AS targets,
       string_agg(head || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY rn) AS text
FROM q GROUP BY conv_id, perspective, part
"""
