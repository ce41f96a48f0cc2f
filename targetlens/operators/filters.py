"""Row filters and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from targetlens.functions.flags import any_missing, has_column, is_missing, quoted
from targetlens.functions.text import keyword_match


def require_column(df: DataFrame, name: str) -> None:
    """P5: fail early when the exact column is absent."""
    if not has_column(df, name):
        raise ValueError(f"column {name!r} not found; there are {df.columns}")


def keyword_filter(df: DataFrame, column: str, keyword: str) -> DataFrame:
    """rows whose text holds the pattern in any letter case."""
    require_column(df, column)
    return df.where(keyword_match(quoted(column), keyword))


def null_lookup(df: DataFrame, column: str, id_column: str | None = None) -> DataFrame:
    """rows missing the column, or only their ids when ``id_column`` is given."""
    require_column(df, column)
    rows = df.where(is_missing(df, column))
    return rows if id_column is None else rows.select(quoted(id_column))


def threshold_lookup(
    df: DataFrame, column: str, threshold: float, greater_than: bool, keys: Sequence[str]
) -> DataFrame:
    """keys of the rows strictly beyond the threshold, with the column's name."""
    require_column(df, column)
    value = quoted(column)
    beyond = value > F.lit(threshold) if greater_than else value < F.lit(threshold)
    return df.where(~is_missing(df, column) & beyond).select(
        *[quoted(key) for key in keys], F.lit(column).alias("column_name")
    )


def required_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """rows that have all the named columns; an absent column leaves no row."""
    if not all(has_column(df, name) for name in columns):
        return df.where(F.lit(False))
    return df.where(~any_missing(df, columns))
