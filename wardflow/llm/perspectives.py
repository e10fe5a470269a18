"""Multi-party perspective rotation of conversations, with DataFrame functions only.

For every participant (each distinct role but ``system``) the dialogue is rendered with that speaker as the assistant,
all others as named users and system turns as they are; the mask holds the character spans of the speaker's own turns.

A conversation is rendered in parts of ``PART`` turn numbers; where turn numbers repeat, such a part is cut by the rank of
its rows again and later parts move up, so that no row holds more than ``PART`` turns.  The parts in order give the whole.  Null roles are the participant ``unknown``, null texts are empty, null turns come first (part 0).
Rows repeated in full count once; rows with one turn number go by role and text.  A conversation of system turns only has
no participant and no row.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.picks import placed
from ..session import materialise

PART = 512


def _head(role: Column, speaker: Column) -> Column:
    return F.when(role == "system", F.lit("<|system|>\n")).when(role == speaker, F.lit("<|assistant|>\n")).otherwise(
        F.concat(F.lit("<|user name="), role, F.lit("|>\n")))


def _before(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows before each row of its key: inside even range blocks, then over the blocks."""
    def until(*by):
        return W.rowsBetween(W.unboundedPreceding, -1).partitionBy(*by)

    line = placed(df, [*keys, *order], "turns")
    inside = line.withColumn("_in", F.coalesce(F.sum(value).over(until(*keys, "_block").orderBy(*order)), F.lit(0)))
    ends = line.groupBy(*keys, "_block").agg(F.sum(value).alias("_all"))
    ends = ends.withColumn("_to", F.coalesce(F.sum("_all").over(until(*keys).orderBy("_block")), F.lit(0)))
    ends = ends.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_block").alias("_k_block"), "_to")
    at = F.col("_block") == F.col("_k_block")
    for k in keys:
        at = at & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return inside.join(ends, at).select(*df.columns, (F.col("_in") + F.col("_to")).alias(name))


def _in_parts(rows: DataFrame, part_turns: int) -> DataFrame:
    """Rows with the number of their part: the block of turn numbers, blocks of too many rows cut by rank."""
    spark = rows.sparkSession
    rows = materialise(spark, rows.withColumn("part", F.floor(F.greatest("turn", F.lit(0)) / part_turns).cast("long")), "turns")
    groups = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("m")).withColumn("more", F.ceil(F.col("m") / part_turns) - 1)
    cut = materialise(spark, groups.where("more > 0").select(F.col("conv_id").alias("_conv")).distinct(), "cut")
    if cut.isEmpty():
        return rows
    moved = _before(groups.join(cut, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi"), ["conv_id"], ["part"], "more", "up")
    moved = materialise(spark, moved.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "more", "up"), "cut")
    named = rows.join(moved, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")), "left")
    whole = named.where("coalesce(more, 0) = 0").withColumn("part", F.col("part") + F.coalesce("up", F.lit(0)))
    large = named.where("more > 0").select(*rows.columns, "up", F.lit(1).alias("one"))
    large = _before(large, ["conv_id", "part"], ["turn", "role", "text"], "one", "rank")
    large = large.withColumn("part", F.col("part") + F.col("up") + F.floor(F.col("rank") / part_turns))
    return whole.select(*rows.columns).unionByName(large.select(*rows.columns))


def rotate(turns: DataFrame, part_turns: int = PART) -> DataFrame:
    """conv_id, part, speaker, n_turns, n_own, messages (role, name, content), rendered, mask (start, end) in characters."""
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-1).cast("long"))
    rows = turns.select("conv_id", turn.alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    speakers = rows.where("role <> 'system'").groupBy(F.col("conv_id").alias("_conv")).agg(F.array_sort(F.collect_set("role")).alias("speakers"))
    parts = _in_parts(rows, part_turns).groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    each = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).select("conv_id", "part", "t", F.explode("speakers").alias("speaker"))
    speaker = F.col("speaker")
    each = each.withColumn("_seg", F.transform("t", lambda m: F.struct(
        _head(m["role"], speaker).alias("head"), m["text"].alias("text"), (m["role"] == speaker).alias("own"))))

    def span(acc: Column, s: Column) -> Column:
        start = acc["at"] + F.length(s["head"])
        end = start + F.length(s["text"])
        return F.struct((end + 1).alias("at"), F.when(s["own"], F.concat(acc["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    message = lambda m: F.struct(
        F.when(m["role"] == "system", "system").when(m["role"] == speaker, "assistant").otherwise("user").alias("role"),
        F.when((m["role"] != "system") & (m["role"] != speaker), m["role"]).alias("name"), m["text"].alias("content"))
    return each.select(
        "conv_id", "part", "speaker", F.size("t").cast("long").alias("n_turns"),
        F.size(F.filter("_seg", lambda s: s["own"])).cast("long").alias("n_own"), F.transform("t", message).alias("messages"),
        F.array_join(F.transform("_seg", lambda s: F.concat(s["head"], s["text"], F.lit("\n"))), "").alias("rendered"),
        F.aggregate("_seg", start, span, lambda a: a["spans"]).alias("mask"))


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
s AS (SELECT t.conv_id, greatest(turn, 0) // 512 AS part, speaker, turn, role, text,
  CASE WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>' ELSE '<|user name=' || role || '|>' END || chr(10) || text || chr(10) AS seg
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (SELECT *, sum(length(seg)) OVER (PARTITION BY conv_id, part, speaker ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS e FROM s)
SELECT conv_id, part, speaker, count(*) AS n_turns, count(*) FILTER (role = speaker) AS n_own,
  string_agg(seg, '' ORDER BY turn, role, text) AS rendered,
  coalesce(string_agg(CASE WHEN role = speaker THEN (e - length(text) - 1)::BIGINT::VARCHAR || ':' || (e - 1)::BIGINT::VARCHAR END, ',' ORDER BY turn, role, text), '') AS mask
FROM o GROUP BY conv_id, part, speaker
"""
