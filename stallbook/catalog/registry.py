"""Registry of queries and their SQL texts, and the table loader."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The supplied Parquet tables by attribute name, each opened once per query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def query(name: str, sql: str):
    """Register a function of the tables under a name, with the SQL that must agree with it."""

    def register(build: Callable[[Tables], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(tune(spark), folder))

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        ORACLES[name] = sql.strip()
        return build

    return register


def money(c: Column | str) -> Column:
    """Exact amounts, so that sums do not depend on the order of addition."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def total(c: Column) -> Column:
    return F.sum(c).cast("double")


def second_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def day_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")
