"""Column names, row ids, unions and missing values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from targetlens import fixed_values as fixed
from targetlens.functions.flags import quoted
from targetlens.functions.text import sanitize_name


def export_keys(names: Sequence[str]) -> list[str]:
    """The export key of every column name; two names with one key are an error."""
    keys = [sanitize_name(name) for name in names]
    clashes = sorted({key for key in keys if keys.count(key) > 1})
    if clashes:
        raise ValueError(f"several columns share the export key {clashes}")
    return keys


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Every column under its export key."""
    return df.toDF(*export_keys(df.columns))


def with_row_id(df: DataFrame, keys: Sequence[str], name: str = "id") -> DataFrame:
    """An id that depends only on the key columns, so a recomputed row keeps it."""
    parts = [F.coalesce(quoted(key).cast("string"), F.lit("\x00")) for key in keys]
    return df.withColumn(name, F.sha2(F.concat_ws("\x1f", *parts), 256))


def stack_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of tables with the same columns, all rows kept."""
    return reduce(lambda above, below: above.unionByName(below), tables)


def stack_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column a table lacks is null there."""
    return reduce(
        lambda above, below: above.unionByName(below, allowMissingColumns=True), tables
    )


def clean_missing(df: DataFrame, missing: Sequence[str] = fixed.MISSING_CELLS) -> DataFrame:
    """One notion of missing: listed texts and NaN become null."""

    def cleaned(field: T.StructField):
        column = quoted(field.name)
        if isinstance(field.dataType, T.StringType):
            column = F.when(~column.isin(list(missing)), column)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.nanvl(column, F.lit(None).cast(field.dataType))
        return column.alias(field.name)

    return df.select(*[cleaned(field) for field in df.schema.fields])
