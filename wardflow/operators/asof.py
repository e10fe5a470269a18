"""As-of and nearest-in-time matching without pairing every probe with every event.

Equal instants are first reduced to one event per category and one probe, limited before the exchange.  Events and
probes together are range-partitioned by (key, time) into blocks of even size, whatever the keys; a running window picks
inside each (key, block), and one row per (key, block) hands the pick on to the key's later blocks.  So no task holds a
hot key, and nothing is counted or cut by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .picks import first_per, placed


class _Pick:
    """One direction of time; a prefix names its columns."""

    def __init__(self, back: bool, prefix: str = ""):
        self.back, self.prefix = back, prefix

    def running(self, cols: list[str], by: str, order: str, end: str = "CURRENT ROW") -> list[str]:
        frame = f"PARTITION BY {by} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND {end}"
        return [f"last(`{c}`, true) OVER ({frame}) AS `{self.prefix}{c}`" for c in cols]


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _picked(line: DataFrame, cols: list[str], p: _Pick, rank: int) -> DataFrame:
    """The pick at every probe instant: inside the block, else handed on from the key's blocks before."""
    way = "ASC" if p.back else "DESC"
    mine = [f"{p.prefix}{c}" for c in cols]
    inside = line.selectExpr("_k", "_t", "_rank", "_cat", "_block", *p.running(cols, "_k, _block", f"_t {way}, _rank, _cat"))
    time = F.col("_t").desc() if p.back else F.col("_t").asc()
    ends = first_per(inside, ["_k", "_block"], [time, F.col("_rank").desc(), F.col("_cat").desc_nulls_last()])
    order = "_block " + way
    handed = ends.selectExpr("_k", "_block", *[
        f"last(`{c}`, true) OVER (PARTITION BY _k ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS `_h_{c}`" for c in mine])
    asked = inside.where(f"_rank = {rank}").join(handed, ["_k", "_block"], "left")
    return asked.select("_k", "_t", *[F.coalesce(c, f"_h_{c}").alias(c) for c in mine])


def _match(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str],
           tiebreak: list[str], outs: dict, category: str | None, picks: list[_Pick], inclusive: bool, tie_max: bool) -> DataFrame:
    def struct(names):
        return f"struct({', '.join(f'`{n}`' for n in names)})"

    keep = f"`{key}` IS NOT NULL AND `{right_time}` IS NOT NULL"
    if category:
        keep += f" AND `{category}` IN ({', '.join(_quoted(v) for v in outs)})"
    row = ", ".join([f"`{right_time}` AS time", *[f"`{v}`" for v in values]])
    events = right.where(keep).selectExpr(
        f"`{key}` AS _k", f"`{right_time}` AS _t", f"{struct(tiebreak)} AS _tie", f"struct({row}) AS _row",
        f"{f'`{category}`' if category else 'CAST(NULL AS STRING)'} AS _cat")
    tie = F.col("_tie").desc_nulls_last() if tie_max else F.col("_tie").asc_nulls_first()
    cols, rank = list(outs.values()), 1 if inclusive else -1
    events = first_per(events, ["_k", "_t", "_cat"], [tie]).selectExpr("_k", "_t", "_cat", "0 AS _rank", *[
        f"_row AS `{c}`" if v is None else f"CASE WHEN _cat = {_quoted(v)} THEN _row END AS `{c}`" for v, c in outs.items()])
    usable = f"`{key}` IS NOT NULL AND `{left_time}` IS NOT NULL"
    probes = left.selectExpr(f"CASE WHEN {usable} THEN `{key}` END AS _k", f"`{left_time}` AS _t", f"{struct(left.columns)} AS _left")
    asked = probes.where("_k IS NOT NULL").select("_k", "_t").distinct().selectExpr("*", f"{rank} AS _rank")
    line = placed(events.unionByName(asked, allowMissingColumns=True), ["_k", "_t"], "asof")
    out = probes
    for p in picks:
        out = out.join(_picked(line, cols, p, rank), ["_k", "_t"], "left")
    return out.select("_left.*", *[f"{p.prefix}{c}" for p in picks for c in cols])


def asof(left: DataFrame, right: DataFrame, *, key: str, left_time: str, right_time: str,
         values: list[str], tiebreak: list[str], direction: str = "backward", inclusive: bool = True,
         category: str | None = None, categories: dict[str, str] | None = None,
         name: str = "pick") -> DataFrame:
    """Add to every left row the right row nearest in one direction of time, per category.

    ``direction='backward'`` takes the latest right row at or before the left time,
    ``'forward'`` the earliest at or after it; ``inclusive=False`` leaves out equal times.
    With ``categories`` (value -> output column) each category gives one struct column
    ``{time, *values}``, NULL where there is no match; without, the one column is ``name``.
    Equal right times are settled by ``tiebreak`` (largest for backward, smallest for forward).
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}")
    back = direction == "backward"
    outs = categories if categories else {None: name}
    return _match(left, right, key, left_time, right_time, values, tiebreak, outs, category if categories else None,
                  [_Pick(back)], inclusive, back)


def nearest(left: DataFrame, right: DataFrame, *, key: str, left_time: str, right_time: str,
            values: list[str], tiebreak: list[str], name: str = "near") -> DataFrame:
    """Right row with the smallest time distance; on equal distance the earlier one, then ``tiebreak``.

    ``key`` may stand for (encounter, day) to search inside one day only.
    """
    both = _match(left, right, key, left_time, right_time, values, tiebreak, {None: "pick"}, None,
                  [_Pick(True, "_b_"), _Pick(False, "_f_")], True, False)
    before, after = F.col("_b_pick"), F.col("_f_pick")
    closer = (F.col(left_time) - before["time"]) <= (after["time"] - F.col(left_time))
    picked = F.when(before.isNotNull() & (after.isNull() | closer), before).otherwise(after)
    return both.withColumn(name, picked).drop("_b_pick", "_f_pick")
