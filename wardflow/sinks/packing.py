"""Exact packing of rows into parts of bounded size, for one output or for many at once.

A part takes rows up to and including the limit and closes before the first that does not fit; a larger row stands alone.  So
where a part opens depends on the one before, along the whole output.  Three passes make that chain short:

1. Rows are range-partitioned by (name, order) into blocks of even size, whatever the names, and written once.
2. Inside each (name, block) the chain is followed for every row that can open the block's first part.  The part before it began in
   an earlier block, so only rows that start within the first ``capacity`` bytes can.  Each gives one link: where its last part in the
   block ends its reach, and from there the first row of a later block that does not fit.
3. The links of a name are followed from its first row by doubling (rounds: the logarithm of its number of blocks), which tells for
   every (name, block) the part it starts in and its first opening row.  One pass over the blocks then numbers all rows.

Neither a task nor the driver holds more than the sizes of one block; nothing depends on the number of partitions.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators.asof import asof
from ..session import materialise, workers_import

_BLOCK = "shiftright(_at, 33)"


def _segments(batches, columns: list[str]):
    """(name, block, arrays of the columns) of each run of rows of one (name, block)."""
    held, group = [], None

    def joined():
        return (*group, *[np.concatenate(c) for c in zip(*held)])

    for batch in batches:
        names, at = batch.column("_name"), np.asarray(batch.column("_at"))
        block = at >> 33
        coded = np.asarray(names.dictionary_encode().indices)
        edge = np.flatnonzero((coded[1:] != coded[:-1]) | (block[1:] != block[:-1])) + 1
        cuts = [0, *edge.tolist(), len(at)]
        arrays = [np.asarray(batch.column(c)) for c in columns]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            own = (names[a].as_py(), int(block[a]))
            if held and own != group:
                yield joined()
                held = []
            group = own
            held.append([x[a:b] for x in arrays])
    if held:
        yield joined()


def _reach(start: np.ndarray, end: np.ndarray, capacity: int) -> np.ndarray:
    """Largest end that still fits the part that a row opens."""
    return np.maximum(start + capacity, end)


def links(size: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """For each row that can open the first part of a block: start, end, reach of the last part, parts opened."""
    end = np.cumsum(size)
    start, n = end - size, len(size)
    reach = _reach(start, end, capacity)
    after = np.append(np.searchsorted(end, reach, "right"), n)  # the row that opens the next part; n: none in this block
    last, opened = np.arange(n + 1), np.append(np.ones(n, np.int64), 0)
    first = np.searchsorted(start, capacity, "right")
    while (after[:first] < n).any():  # pointer doubling over the rows of the block
        last = np.where(after < n, last[after], last)
        opened, after = opened + opened[after], after[after]
    return start[:first], end[:first], reach[last[:first]], opened[:first]


def _link_rows(narrow: DataFrame, capacity: int) -> DataFrame:
    names = ["name", "block", "start", "end", "reach", "opened", "total"]
    types = [pa.string(), *[pa.int64()] * 6]

    def run(batches):
        for name, block, size in _segments(batches, ["_size"]):
            start, end, reach, opened = links(size, capacity)
            n = len(start)
            values = [[name] * n, np.full(n, block), start, end, reach, opened, np.full(n, size.sum())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

    return narrow.mapInArrow(run, "name string, block long, start long, end long, reach long, opened long, total long")


def _followed(chain: DataFrame, blocks: int) -> DataFrame:
    """(name, start) of the first opening row of each block that has one, from the links of all candidates."""
    spark = chain.sparkSession
    reached = chain.where("start = 0").select("name", "start")
    if blocks < 2:
        return reached
    asked = chain.select("name", "start", "reach")
    ends = chain.select("name", F.col("start").alias("next"), "end")
    hops = asof(asked, ends, key="name", left_time="reach", right_time="end", values=["next"], tiebreak=["next"], direction="forward",
                inclusive=False, name="hit").where("hit IS NOT NULL").select("name", "start", F.col("hit.next").alias("next"))
    rounds = math.ceil(math.log2(blocks))
    for k in range(rounds):
        hops = materialise(spark, hops, "hops")
        reached = reached.join(hops, ["name", "start"], "left").select("name", F.explode(F.array_compact(F.array("start", "next"))).alias("start"))
        if k + 1 < rounds:
            reached = materialise(spark, reached, "reached")
            onward = hops.select("name", F.col("start").alias("next"), F.col("next").alias("far"))
            hops = hops.join(onward, ["name", "next"]).select("name", "start", F.col("far").alias("next"))
    return reached


def pack(df: DataFrame, size: Column, order: list[str], capacity: int, by: str | None = None) -> DataFrame:
    """``df`` with ``part`` (1, 2, ... within each ``by``), ``line_bytes`` and ``line_offset`` (bytes before the row in its output).

    ``size`` are the bytes of a row; ``order`` must be total within ``by``.  A null name is an output of its own.
    """
    spark = df.sparkSession
    workers_import(spark)
    name = F.lit("") if by is None else F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("-"))
    named = df.withColumn("_name", name).withColumn("_size", size.cast("long"))
    placed = materialise(spark, named.repartitionByRange("_name", *order).sortWithinPartitions("_name", *order)
                         .withColumn("_at", F.monotonically_increasing_id()), "pack")
    narrow = placed.select("_name", "_size", "_at").repartition(F.expr(_BLOCK)).sortWithinPartitions("_at")
    found = materialise(spark, _link_rows(narrow, capacity), "links")
    by_name = Window.partitionBy("name").orderBy("block")  # one row for each block that holds a part of the name
    heads = found.where("start = 0").groupBy("name", "block").agg(F.max("total").alias("total"))
    bases = heads.select("name", "block", (F.sum("total").over(by_name) - F.col("total")).alias("base"))
    chain = materialise(spark, found.join(bases, ["name", "block"]).select(
        "name", "block", "base", *[(F.col(c) + F.col("base")).alias(c) for c in ("start", "end", "reach")], "opened"), "links")
    blocks = heads.groupBy("name").count().agg(F.max("count")).first()[0] or 1
    opening = chain.join(_followed(chain, blocks), ["name", "start"]).select("name", "block", F.col("start").alias("first"), "opened")
    entry = (bases.join(opening, ["name", "block"], "left")
             .select(F.col("name").alias("_name"), F.col("block").alias("_block"), F.col("base").alias("_base"), F.col("first").alias("_first"),
                     (F.coalesce(F.sum("opened").over(by_name), F.lit(0)) - F.coalesce("opened", F.lit(0))).alias("_before")))
    rows = (placed.withColumn("_block", F.expr(_BLOCK)).repartition("_name", "_block").join(entry, ["_name", "_block"])
            .sortWithinPartitions("_name", "_at"))
    schema = StructType([*df.schema.fields, StructField("part", IntegerType()), StructField("line_bytes", LongType()), StructField("line_offset", LongType())])

    own_names, all_names = df.columns, schema.names

    def number(batches):
        group, offset, part, reach = None, 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            size, block = np.asarray(batch.column("_size")), np.asarray(batch.column("_block"))
            names = np.asarray(batch.column("_name").dictionary_encode().indices)
            edge = np.flatnonzero((names[1:] != names[:-1]) | (block[1:] != block[:-1])) + 1
            cuts = [0, *edge.tolist(), len(size)]
            parts, offsets = np.empty(len(size), np.int32), np.empty(len(size), np.int64)
            for a, b in zip(cuts, cuts[1:]):
                own = (batch.column("_name")[a].as_py(), int(block[a]))
                if own != group:
                    group, offset, part = own, batch.column("_base")[a].as_py(), batch.column("_before")[a].as_py()
                    first = batch.column("_first")[a].as_py()
                    # Up to the first opening row everything fits the part that came in.
                    reach = first if first is not None else np.iinfo(np.int64).max
                end = offset + np.cumsum(size[a:b])
                start = end - size[a:b]
                i = 0
                while i < b - a:
                    j = int(np.searchsorted(end, reach, "right"))
                    parts[a + i : a + j] = part
                    if j < b - a:
                        part, reach = part + 1, max(int(start[j]) + capacity, int(end[j]))
                    i = j
                offsets[a:b], offset = start, int(end[-1])
            keep = [batch.column(c) for c in own_names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(parts), pa.array(size), pa.array(offsets)], all_names)

    return rows.mapInArrow(number, schema)
