"""Pivots, lists and record streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .picks import first_per, placed


def eav_pivot(df: DataFrame, keys: list[str], name: str, value: str, columns: dict[str, str]) -> DataFrame:
    """Key/value rows to one wide row per key; ``columns`` maps name -> output column.

    The value list is always given, so no extra job looks for it, and MAX combines before the exchange.
    """
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(name) == k, F.col(value))).alias(c) for k, c in columns.items()])


def slot_pivot(df: DataFrame, keys: list[str], line: str, tiebreak: list[str],
               values: dict[str, str], slots: dict[int, str]) -> DataFrame:
    """Line-numbered child rows to one row per key with ``<slot>_<value>`` columns.

    One pass over the children instead of one join per slot; ranks are limited per slot before the exchange.
    """
    rows = first_per(df.where(F.col(line).isin(list(slots))), [*keys, line], [F.col(c).asc_nulls_first() for c in tiebreak])
    item = F.struct(F.col(line).alias("line"), *[F.col(src).alias(v) for v, src in values.items()])
    picked = rows.groupBy(*keys).agg(F.collect_list(item).alias("_rows"))  # at most one for each slot
    cell = lambda n: F.get(F.filter("_rows", lambda r: r["line"] == n), F.lit(0))
    return picked.select(*keys, *[cell(n)[v].alias(f"{s}_{v}") for n, s in slots.items() for v in values])


def list_ordered(df: DataFrame, keys: list[str], value: str, order: list[str], out: str,
                 sep: str = ",", descending: bool = False, empty: str | None = None) -> DataFrame:
    """Ordered text list that keeps repeats; NULL values are left out.

    Equal (order, value) rows are counted before the exchange and written out again at the end, so
    the work of a group grows with its distinct rows.  A group of NULLs only gives ``empty``.
    """
    counted = df.groupBy(*keys, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                         F.col(value).alias("_v")).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    item = F.struct(*[f"_o{i}" for i in range(len(order))], "_v", "_n")
    grouped = counted.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("_v").isNotNull(), item)), asc=not descending).alias("_items"))
    spread = F.flatten(F.transform("_items", lambda x: F.array_repeat(x["_v"].cast("string"), x["_n"])))
    text = F.when(F.size("_items") > 0, F.array_join(spread, sep)).otherwise(F.lit(empty))
    return grouped.select(*keys, text.alias(out))


def list_ordered_blocks(df: DataFrame, keys: list[str], value: str, order: list[str], out: str,
                        sep: str = ",", descending: bool = False, empty: str | None = None) -> DataFrame:
    """``list_ordered`` for keys of any size, in two levels.

    Rows are range-partitioned by (key, order, value) into blocks of even size; each (key, block) becomes one text, and a key's texts are
    joined in the order of their blocks.  So no task holds the rows of a hot key, only the text that is asked for.
    """
    names = [f"_o{i}" for i in range(len(order))]
    counted = df.groupBy(*keys, *[F.col(c).alias(n) for n, c in zip(names, order)],
                         F.col(value).alias("_v")).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    line = placed(counted, [*keys, *names, "_v"], "list")
    item = F.struct(*names, "_v", "_n")
    items = F.sort_array(F.collect_list(F.when(F.col("_v").isNotNull(), item)), asc=not descending)
    spread = F.flatten(F.transform("_items", lambda x: F.array_repeat(x["_v"].cast("string"), x["_n"])))
    texts = (line.groupBy(*keys, "_block").agg(items.alias("_items"))
             .select(*keys, F.struct(F.when(F.size("_items") > 0, F.col("_block")).alias("at"), F.array_join(spread, sep).alias("text")).alias("_t")))
    held = F.sort_array(F.collect_list(F.when(F.col("_t.at").isNotNull(), F.col("_t"))), asc=not descending)  # one for each block of the key
    joined = texts.groupBy(*keys).agg(held.alias("_t"))
    return joined.select(*keys, F.when(F.size("_t") > 0, F.array_join(F.col("_t.text"), sep)).otherwise(F.lit(empty)).alias(out))


def list_distinct(df: DataFrame, keys: list[str], lists: dict[str, Column | str], sep: str = " || ",
                  empty: str | None = None, more: list[Column] = ()) -> DataFrame:
    """Text lists of distinct values in value order, one column per entry of ``lists``, and ``more`` aggregates of the group.

    Sets are built before the exchange, so repeats of a hot group are not sent.
    """
    aggs = []
    for out, c in lists.items():
        values = F.sort_array(F.collect_set((F.col(c) if isinstance(c, str) else c).cast("string")))
        aggs.append(F.when(F.size(values) > 0, F.array_join(values, sep)).otherwise(F.lit(empty)).alias(out))
    return df.groupBy(*keys).agg(*aggs, *more)


def header_detail_trailer(detail: DataFrame, members: DataFrame, stamp: str, columns: list[str]) -> DataFrame:
    """Header, detail and trailer rows in one text schema with an explicit ``record_order``.

    The header appears only when there is detail; the trailer whenever any member matched, even with
    no detail rows.  The first three columns are the record tag or id, the run stamp or first name, and
    the row count or last name.
    """
    first, second, third, *rest = columns
    blanks = [F.lit("").alias(c) for c in rest]
    # Details and the presence of any member are counted together, down to one row.
    marks = detail.select(F.lit(1).alias("_d")).unionByName(members.limit(1).select(F.lit(0).alias("_d")))
    total = marks.agg(F.sum("_d").alias("_n"), F.count(F.when(F.col("_d") == 0, 1)).alias("_any"))
    header = total.where("_n > 0").select(
        F.lit(1).alias("record_order"), F.lit("HR").alias(first), F.lit(stamp).alias(second), F.lit("").alias(third), *blanks)
    body = detail.select(F.lit(2).alias("record_order"), *[F.col(c).cast("string") for c in columns])
    trailer = total.where("_any > 0").select(
        F.lit(3).alias("record_order"), F.lit("TR").alias(first), F.lit(stamp).alias(second),
        F.col("_n").cast("string").alias(third), *blanks)
    return header.unionByName(body).unionByName(trailer)
