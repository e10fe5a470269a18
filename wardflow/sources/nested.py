"""Nested records to flat typed columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_START = r"^\d{4}-\d{2}-\d{2}T"

# Column type -> type in the loaded table (anything else is text).
LOAD_TYPES = {
    T.BooleanType: T.BooleanType(), T.ByteType: T.LongType(), T.ShortType: T.LongType(), T.IntegerType: T.LongType(),
    T.LongType: T.LongType(), T.FloatType: T.DoubleType(), T.DoubleType: T.DoubleType(),
    T.TimestampType: T.TimestampType(), T.TimestampNTZType: T.TimestampNTZType(), T.DateType: T.TimestampNTZType(),
}


def json_schema(df: DataFrame, column: str) -> str:
    """Schema of a JSON text column, merged over all rows by one aggregation."""
    merged = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first()["s"]
    # Names with other characters than letters and digits are quoted; only type names are changed.
    return re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m.group() == "OBJECT<" else m.group(), merged)


def parse_json(df: DataFrame, column: str, schema: str | None = None) -> DataFrame:
    return df.withColumn(column, F.from_json(column, schema or json_schema(df, column)))


def flat_columns(schema: T.StructType, sep: str = "__", path: tuple[str, ...] = ()) -> list[Column]:
    """A column per leaf, named by its joined path; arrays stay one column."""
    out = []
    for f in schema.fields:
        here = (*path, f.name)
        if isinstance(f.dataType, T.StructType):
            out += flat_columns(f.dataType, sep, here)
        else:
            out.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))
    return out


def flatten(df: DataFrame, sep: str = "__") -> DataFrame:
    return df.select(*flat_columns(df.schema, sep))


def timestamp_columns(df: DataFrame, null_columns_too: bool = False) -> list[str]:
    """Text columns of which every non-NULL value is an ISO timestamp; a mixed column stays text.

    One aggregation over all rows and all text columns.  The original rule also accepts columns
    without any value; ``null_columns_too=True`` repeats that.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return []
    cols = [F.col(f"`{n}`") for n in names]
    hits = df.agg(*[F.bool_and(F.when(c.isNotNull(), c.rlike(ISO_START) & F.try_to_timestamp(c).isNotNull())).alias(f"c{i}")
                    for i, c in enumerate(cols)]).first()
    return [n for n, hit in zip(names, hits) if hit or (hit is None and null_columns_too)]


def load_types(df: DataFrame, timestamps: list[str]) -> DataFrame:
    """Apply the load type map."""
    cols = []
    for f in df.schema.fields:
        if f.name in timestamps:
            cols.append(F.try_to_timestamp(f.name).alias(f.name))
            continue
        target = next((t for k, t in LOAD_TYPES.items() if isinstance(f.dataType, k)), None)
        if target is None and isinstance(f.dataType, (T.ArrayType, T.MapType)):
            cols.append(F.to_json(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(target or T.StringType()).alias(f.name))
    return df.select(*cols)


def call_records(df: DataFrame) -> DataFrame:
    """Nested call records to a flat typed table."""
    flat = flatten(df)
    return load_types(flat, timestamp_columns(flat))
