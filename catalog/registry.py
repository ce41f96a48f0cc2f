"""Registration of queries, and the derived columns several of them share.

The given tables hold no nulls, so queries make some with ``nullif`` on ordinary values; every
query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register the function under its name or the one given, with its SQL counterpart."""

    def register(function):
        QUERIES[name or function.__name__] = function
        if sql is not None:
            ORACLES[name or function.__name__] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(prefix: str, number: Column, digits: int) -> Column:
    """``numbered("GO:", 12, 7)`` is ``GO:0000012``; longer numbers are kept whole."""
    text = number.cast("string")
    width = F.greatest(F.length(text), F.lit(digits))
    return F.concat(F.lit(prefix), F.repeat(F.lit("0"), width - F.length(text)), text)


def numbered_sql(prefix: str, number: str, digits: int) -> str:
    text = f"({number})::VARCHAR"
    return f"'{prefix}' || repeat('0', greatest({digits} - length({text}), 0)) || {text}"


def listed(items: Column) -> Column:
    """A sorted list as one text, null when there is none."""
    return F.when(items.isNotNull(), F.array_join(items, ", "))
