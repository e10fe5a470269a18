"""Several as-of questions about one table of events, answered in one placement.

Probes of all questions and the ids of the events are sent together, once, by key; a key of very many rows is cut by time into parts of
even size, and each part gets the last id of every category before it and the first one after it.  One window in each direction of time
then carries ids only.  The picks of a probe leave the windows as a short list, and the columns of the picked events are joined to them
where they lie, so that neither wide rows nor picks are sent.  Equal instants are settled by the order of the ids in the windows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

BACK, FORWARD = "backward", "forward"
#: Rows of a key from which on it is cut, and rows of a part; also the rows of a task, so that none has to spill.
PART_ROWS = 1 << 18


@dataclass(frozen=True)
class Ask:
    """The event of each category nearest to ``time`` in one direction: at or before it, or at or after it."""
    name: str
    time: str
    direction: str
    categories: tuple[str, ...]


def placed(df: DataFrame, order: list[str], label: str) -> DataFrame | None:
    """Key and time of the rows of keys that are too large for one task, range-partitioned into blocks of even size, with the
    number of the block; None where there is no such key."""
    counts = df.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > PART_ROWS)
    large = materialise(df.sparkSession, counts, f"{label}-large")
    total = large.agg(F.sum("_n")).first()[0]
    if not total:
        return None
    rows = df.select(*order).join(large.select("_k"), "_k", "left_semi")
    return rows.repartitionByRange(ceil(total / PART_ROWS) + 1, *[F.col(c).asc_nulls_first() for c in order]).withColumn("_block", F.spark_partition_id())


class _Parts:
    """The part of each (key, time): numbered from 1 in the order of time for keys that were cut."""

    def __init__(self, line: DataFrame | None):
        self.starts, self.by = None, ["_k"]
        if line is not None:
            first = line.groupBy("_k", "_block").agg(F.min("_t").alias("_from"))
            starts = first.groupBy("_k").agg(F.sort_array(F.collect_list("_from")).alias("_starts")).where(F.size("_starts") > 1)
            self.starts, self.by = materialise(line.sparkSession, starts, "sweep-starts"), ["_k", "_part"]

    def of(self, df: DataFrame, how: str = "left") -> DataFrame:
        if self.starts is None:
            return df
        part = F.size(F.filter("_starts", lambda s: s <= F.col("_t")))
        return df.join(self.starts, "_k", how).withColumn("_part", F.when(F.col("_starts").isNull(), 0).otherwise(part)).drop("_starts")

    def handed(self, met: DataFrame, codes: list[int]) -> DataFrame:
        """(key, part, category, the last id before the part, the first id after it)."""
        ends = self.of(met.where("_low IS NOT NULL"), "inner").groupBy("_k", "_part", "_cat").agg(
            F.max(F.struct("_t", "_low")).alias("_last"), F.min(F.struct("_t", "_low")).alias("_first"))
        grid = self.starts.select("_k", F.explode(F.sequence(F.lit(1), F.size("_starts"))).alias("_part")).withColumn(
            "_cat", F.explode(F.array(*[F.lit(c) for c in codes])))
        w = Window.partitionBy("_k", "_cat").orderBy("_part")
        before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
        rows = grid.join(ends, ["_k", "_part", "_cat"], "left").select(
            "_k", "_part", "_cat", F.last("_last._low", True).over(before).alias("_high"), F.first("_first._low", True).over(after).alias("_low"))
        return materialise(met.sparkSession, rows.where("_high IS NOT NULL OR _low IS NOT NULL"), "sweep-handed")


def sweep(probes: DataFrame, events: DataFrame, asks: list[Ask], *, probe: str, key: str, event_time: str, event: str, category: str,
          carry: list[str] | None = None) -> DataFrame:
    """(probe, ask, category, event): the id of the event picked for each probe row, question and category; none, no row.

    ``event`` orders events of one instant and category: the largest is taken looking back, the smallest looking forward.
    With ``carry``, the key and these columns of the event follow; an id names events of its key.
    """
    wanted = sorted({c for a in asks for c in a.categories})
    names = list(dict.fromkeys(a.time for a in asks))
    code = F.create_map(*[x for i, c in enumerate(wanted) for x in (F.lit(c), F.lit(i))])
    usable = events.where(F.col(key).isNotNull() & F.col(event_time).isNotNull() & F.col(category).isin(wanted)).select(
        F.col(key).alias("_k"), F.col(event_time).cast("timestamp_ntz").alias("_t"), code[F.col(category)].alias("_cat"),
        F.col(event).alias("_low"), *(carry or []))
    met = usable.select("_k", "_t", "_cat", "_low", F.lit(None).cast(events.schema[event].dataType).alias("_high"), F.lit(0).alias("_rank"))
    asked = probes.where(F.col(key).isNotNull()).select(F.col(probe).alias("_probe"), F.col(key).alias("_k"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("_time"), F.col(n).cast("timestamp_ntz").alias("_t")) for i, n in enumerate(names)]))).where("_t IS NOT NULL")
    asked = asked.withColumn("_rank", F.lit(1))
    parts = _Parts(placed(met.unionByName(asked.select("_k", "_t", "_rank"), allowMissingColumns=True), ["_k", "_t"], "sweep"))
    line = parts.of(met.unionByName(asked, allowMissingColumns=True))
    handed = None
    if parts.starts is not None:
        handed = parts.handed(met, list(range(len(wanted))))
        # They come first in both directions, as their time is NULL.
        line = line.unionByName(handed.withColumn("_rank", F.lit(0)), allowMissingColumns=True)
    spark = probes.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, ceil((met.count() + asked.count()) / PART_ROWS))
    line = line.repartition(tasks, *parts.by)

    def running(df: DataFrame, direction: str, value: Column, way: str) -> tuple[DataFrame, Column]:
        """Rows with the list of (cell, id) that a probe finds in this direction."""
        cells = [(n, a, c) for n, a in enumerate(asks) if a.direction == direction for c in a.categories]
        kept = df.columns
        for c in sorted({c for _, _, c in cells}):
            df = df.withColumn(f"_v{wanted.index(c)}", F.when(F.col("_cat") == wanted.index(c), value))
        over = f"PARTITION BY {', '.join(parts.by)} ORDER BY _t {way} NULLS FIRST, _rank, _cat, _low {way} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
        df = df.selectExpr(*kept, *[f"last({c}, true) OVER ({over}) AS {c}" for c in df.columns if c not in kept])
        found = None
        for i, name in enumerate(names):
            mine = [F.struct(F.lit(n).alias("_ask"), F.lit(wanted.index(c)).alias("_cat"), F.col(f"_v{wanted.index(c)}").alias("event")) for n, a, c in cells if a.time == name]
            if mine:
                hit = F.filter(F.array(*mine), lambda x: x["event"].isNotNull())
                found = F.when(F.col("_time") == i, hit) if found is None else found.when(F.col("_time") == i, hit)
        # Only a probe has a time of a question: the rows of events get an empty list.
        return df, F.coalesce(found, F.array().cast(f"array<struct<_ask:int,_cat:int,event:{events.schema[event].dataType.simpleString()}>>"))

    lists = []
    for direction, value, way in ((FORWARD, F.col("_low"), "DESC"), (BACK, F.when(F.col("_t").isNull(), F.col("_high")).otherwise(F.col("_low")), "ASC")):
        if any(a.direction == direction for a in asks):
            kept = line.columns
            line, found = running(line, direction, value, way)
            line = line.select(*kept, found.alias(f"_found_{direction}"))
            lists.append(f"_found_{direction}")
    picked = line.where("_rank = 1").select("_probe", *parts.by, F.inline(F.concat(*lists)))
    out = [F.col("_probe").alias("probe"), F.element_at(F.array(*[F.lit(a.name) for a in asks]), F.col("_ask") + 1).alias("ask"),
           F.element_at(F.array(*[F.lit(c) for c in wanted]), F.col("_cat") + 1).alias("category"), F.col("event")]
    if not carry:
        return picked.select(*out)
    texts = parts.of(usable.withColumnRenamed("_low", "event"))
    if handed is not None:
        far = handed.select("_k", F.col("_part").alias("_to"), "_cat", F.explode(F.array("_low", "_high")).alias("event")).where("event IS NOT NULL").distinct()
        held = parts.of(usable.withColumnRenamed("_low", "event"), "inner").join(far, ["_k", "_cat", "event"]).where("_part <> _to")
        texts = texts.unionByName(held.withColumn("_part", F.col("_to")).drop("_to"))
    texts = texts.select(*parts.by, "_cat", "event", *carry).repartition(tasks, *parts.by)
    # Picks stream past the events of their partition; run ``in_place``, nothing is sent again.
    return picked.join(texts.hint("shuffle_hash"), [*parts.by, "_cat", "event"]).select(*out, F.col("_k").alias(key), *carry)
