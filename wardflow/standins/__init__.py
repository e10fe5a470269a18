"""Every operator and report run on the driver's tables.

The warehouse tables are not shipped, so customers stand for patients, orders for surgical cases, visits
and accounts, line items for results, diagnoses, charges and images, parts for codes and components,
suppliers for plans, events for visits and flowsheets.  Each entry reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Lazily read parquet tables of one folder, each opened once: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, df)
        return df


class LazyTables(Mapping):
    """Frames by name, each built when first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self):
        return len(self._makers)


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text, so that two engines print them alike."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates}) if dates else df


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its oracle SQL."""
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(Tables(tune(spark), sf_dir)))
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def load_all() -> None:
    from . import basics, clinical, exports, matching, outputs, revenue  # noqa: F401
