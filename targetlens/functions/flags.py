"""Boolean expressions over several columns of one row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """Column by its exact name, which may hold blanks, dots or parentheses."""
    return F.col("`" + name.replace("`", "``") + "`")


def has_column(df: DataFrame, name: str) -> bool:
    """Exact, case-sensitive presence test."""
    return name in df.columns


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, and for floating-point columns also NaN."""
    column = quoted(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def any_missing(df: DataFrame, names: Sequence[str]) -> Column:
    """True where one of the named columns is missing in the row."""
    return reduce(or_, [is_missing(df, name) for name in names], F.lit(False))


def any_true(names: Sequence[str]) -> Column:
    """True where one of the flags is true; a null flag counts as false."""
    return reduce(or_, [F.coalesce(quoted(name), F.lit(False)) for name in names], F.lit(False))


def true_names(names: Sequence[str], separator: str = ", ") -> Column:
    """Names of the true flags, in the given order."""
    return F.concat_ws(separator, *[F.when(quoted(name), F.lit(name)) for name in names])
