"""Registration of queries and their reference SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The run dates of the test tables.
AS_OF = "2001-12-01"
EVENTS_AS_OF = "2024-01-31"

MODULES = ("io", "clean", "filters", "joins", "aggregates", "latest", "scalars", "cohorts", "linkage", "streams")

_QUERIES: dict[str, Callable[["Tables"], DataFrame]] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The test tables of one folder, read when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """SQL with ``{table}`` markers."""
        names = [n for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                             "documents", "labels") if "{" + n + "}" in text]
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, the SQL with the same result."""

    def add(func: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = func
        if sql is not None:
            _SQL[name] = sql
        return func

    return add


#: All orders; those of every third customer belong to nobody, so some customers have none.
MOVED_ORDERS = "(SELECT * REPLACE (CASE WHEN o_custkey % 3 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey) FROM orders)"


def moved_orders(t: Tables) -> DataFrame:
    key = F.col("o_custkey")
    return t.orders.withColumn("o_custkey", F.when(key % 3 == 0, -key).otherwise(key))


def portable(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, for comparison across engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"{__package__}.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(func):
        return lambda spark, folder: portable(func(Tables(spark, folder)))

    return {name: bind(func) for name, func in sorted(_QUERIES.items())}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(sorted(_SQL.items()))
