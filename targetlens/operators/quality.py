"""Summary counts and quality checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted


def summary_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """``(measure, count)``: all rows as ``rows``, then the true rows of each flag."""
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(quoted(flag)).alias(flag) for flag in flags],
    )
    return totals.unpivot([], ["rows", *flags], "measure", "count")


def count_true(df: DataFrame, flag: str) -> DataFrame:
    """number of rows whose flag is true."""
    return df.where(quoted(flag)).agg(F.count(F.lit(1)).alias("count"))


def count_removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """A8's report: rows before, after, and removed."""
    sizes = [
        table.agg(F.count(F.lit(1)).alias(name))
        for name, table in (("before", before), ("after", after))
    ]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sizes)
    return both.agg(F.sum("before").alias("before"), F.sum("after").alias("after")).withColumn(
        "removed", F.col("before") - F.col("after")
    )


def expect_unique(df: DataFrame, *keys: str) -> DataFrame:
    """A10: one report row; ``observed`` counts the keys that occur more than once."""
    sizes = df.groupBy(*[quoted(key) for key in keys]).agg(F.count(F.lit(1)).alias("_size"))
    return sizes.agg(F.count_if(F.col("_size") > 1).alias("observed")).select(
        F.lit(f"unique {', '.join(keys)}").alias("check"),
        "observed",
        (F.col("observed") == 0).alias("passed"),
    )


def expect_min_rows(df: DataFrame, least: int) -> DataFrame:
    """A10: one report row; ``observed`` counts the rows."""
    return df.agg(F.count(F.lit(1)).alias("observed")).select(
        F.lit(f"at least {least} rows").alias("check"),
        "observed",
        (F.col("observed") >= least).alias("passed"),
    )


def quality_report(df: DataFrame, key: str, least: int) -> DataFrame:
    """A10: both checks from one grouping by the key."""
    sizes = df.groupBy(quoted(key)).count()
    totals = sizes.agg(
        F.count_if(F.col("count") > 1).alias("repeated"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
    )
    checks = F.array(
        F.struct(
            F.lit(f"unique {key}").alias("check"),
            F.col("repeated").alias("observed"),
            (F.col("repeated") == 0).alias("passed"),
        ),
        F.struct(
            F.lit(f"at least {least} rows").alias("check"),
            F.col("rows").alias("observed"),
            (F.col("rows") >= least).alias("passed"),
        ),
    )
    return totals.select(F.inline(checks))


def require(report: DataFrame) -> None:
    """Raise when a check of the report did not pass."""
    failed = [row["check"] for row in report.where(~F.col("passed")).collect()]
    if failed:
        raise AssertionError(f"quality checks failed: {failed}")
