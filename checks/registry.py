"""Collects the check queries and their comparison SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query; `sql` is left out where SQL cannot express the result."""

    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, folder)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because engines add them up in different orders."""
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])


def times_as_text(df: DataFrame) -> DataFrame:
    kinds = dict(df.dtypes)
    text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in df.columns if kinds[c].startswith("timestamp")}
    return df.withColumns(text) if text else df


def time_text(column: str) -> str:
    """The same form in DuckDB."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
