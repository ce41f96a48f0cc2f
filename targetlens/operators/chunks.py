"""Global row positions and chunk numbers without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.operators.joins import fits_broadcast
from targetlens.operators.quality import expect_unique, require
from targetlens.storage import fresh_path, is_plain_scan, written


def row_positions(df: DataFrame, order_by: Sequence[str], name: str = "position") -> DataFrame:
    """Rows with their 0-based place in the order of ``order_by``, which must identify a row.

    The table is computed and written once, unless it only has to be read, checked, and range-sorted
    into files. A row's place is its index in its file plus the rows of the files before, which are summed in Spark: one row per
    sorted file, and files are as large as the tasks that sort.
    """
    spark = df.sparkSession
    if not is_plain_scan(df):
        df = written(df, "unsorted").table
    require(expect_unique(df, *order_by))
    path = fresh_path(spark, "sorted")
    df.orderBy(*[quoted(column).asc_nulls_first() for column in order_by]).write.parquet(path)
    file = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-.*-c(\d+)\.", 1)
    piece = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-.*-c(\d+)\.", 2)
    rows = spark.read.schema(df.schema).parquet(path)
    placed = rows.select(
        "*",
        file.cast("int").alias("_part"),
        piece.cast("int").alias("_part_piece"),
        F.col("_metadata.row_index").alias("_part_row"),
    )
    sizes = placed.groupBy("_part", "_part_piece").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part", "_part_piece").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_size").over(before), F.lit(0))
    starts = written(sizes.withColumn("_part_start", start).drop("_size"), "starts")
    starts = F.broadcast(starts.table) if fits_broadcast(starts) else starts.table
    return placed.join(starts, ["_part", "_part_piece"]).select(
        *[quoted(column) for column in df.columns],
        (F.col("_part_start") + F.col("_part_row")).alias(name),
    )


def chunk_numbers(df: DataFrame, order_by: Sequence[str], size: int) -> DataFrame:
    """Rows with ``position`` and 1-based ``chunk`` of at most ``size`` rows each."""
    if size < 1:
        raise ValueError("chunk size must be at least 1")
    chunk = F.floor(F.col("position") / F.lit(size)) + 1
    return row_positions(df, order_by).withColumn("chunk", chunk.cast("bigint"))
