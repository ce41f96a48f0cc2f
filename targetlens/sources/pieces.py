"""Records put together from the pieces that a text scan cuts files into.

Spark splits a large file into blocks wherever it likes and reads each block's pieces (lines, say)
in a task of its own. What a piece means depends on what stands before it: it may continue a quoted
cell. So each block is first summed up, the few sums of a file are carried forward from block to
block, and only then are the pieces of a block judged. All of it is windows over a block's pieces or
a file's blocks; no task holds a file. Blocks are also cut after so many pieces, and dealt to as many
tasks as their files' bytes ask for, so that what a task sorts does not grow with the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.storage import plan_bytes

# A block holds as many pieces at most, a task about as many bytes of text.
RUN_PIECES = 32_768
TASK_BYTES = 8 << 20

BLOCK = ["_file", "_block", "_run"]
PLACE = [*BLOCK, "_order"]


def in_block():
    """The pieces of a block in order."""
    return Window.partitionBy(*BLOCK).orderBy("_order")


def in_file():
    """The blocks of a file in order."""
    return Window.partitionBy("_file").orderBy("_block", "_run")


def scan(spark: SparkSession, path: str | Sequence[str], separator: str) -> DataFrame:
    """``value``: what stands between separators; its :data:`PLACE`; partition columns of the path."""
    pieces = _text(spark, path, separator)
    return pieces.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_order"),
    ).withColumn("_run", F.expr(f"_order div {RUN_PIECES}"))


def _text(spark: SparkSession, path: str | Sequence[str], separator: str) -> DataFrame:
    return spark.read.option("lineSep", separator).text(
        path if isinstance(path, str) else list(path)
    )


def dealt(spark: SparkSession, path: str | Sequence[str], pieces: DataFrame) -> DataFrame:
    """The pieces of a scan with those of a block in one task, by the bytes of the scanned files.

    The number of tasks is set here: adaptive execution would put partitions together by their
    compressed size, which says little about texts that repeat themselves.
    """
    tasks = plan_bytes(_text(spark, path, "\n")) // TASK_BYTES + 1
    return pieces.repartition(tasks, *BLOCK)


def before(total: Column, window, default) -> Column:
    """What a running value was at the row before, ``default`` at the first one."""
    return F.coalesce(F.lag(total).over(window), default)


def carried(columns: Sequence[str]) -> list[str]:
    """Partition columns among the columns of a scan."""
    return [name for name in columns if name != "value" and not name.startswith("_")]


def assembled(
    pieces: DataFrame, glue: str, keep: Sequence[str], marks: Sequence[str] = ()
) -> DataFrame:
    """Records of pieces: ``value`` (pieces joined by ``glue``), :data:`PLACE` of the first, ``keep``.

    The flags ``marks`` hold for a record that has a piece for which they hold. ``_starts`` tells
    which pieces begin a record, ``_leaves`` whether the piece's block ends inside one. Records within a block are put together in the block's task. Only the two fragments at
    most that a block shares with its neighbours meet across blocks.
    """
    kept = [quoted(name) for name in keep]
    number = F.sum(F.col("_starts").cast("long")).over(in_block())
    numbered = pieces.withColumn("_number", number)
    numbered = numbered.withColumn("_last", F.max("_number").over(Window.partitionBy(*BLOCK)))
    numbered = numbered.withColumn(
        "_shared",
        (F.col("_number") == 0) | (F.col("_leaves") & (F.col("_number") == F.col("_last"))),
    )

    def joined(rows: DataFrame, by: Sequence[str], at: Sequence[str]) -> DataFrame:
        place = F.struct(*at, "value")
        values = F.transform(F.array_sort(F.collect_list(place)), lambda x: x["value"])
        return rows.groupBy(*by, *kept).agg(
            F.array_join(values, glue).alias("value"),
            F.min(F.struct(*at)).alias("_place"),
            *[F.bool_or(mark).alias(mark) for mark in marks],
        )

    def within(rows: DataFrame) -> DataFrame:
        found = joined(rows, [*BLOCK, "_number"], ["_order"])
        return found.select("value", *BLOCK, "_place.*", "_number", *kept, *marks)

    whole = within(numbered.where("not _shared")).drop("_number")
    parts = within(numbered.where("_shared"))
    opened = F.sum((F.col("_number") > 0).cast("long")).over(
        Window.partitionBy("_file").orderBy("_block", "_order")
    )
    at = [name for name in PLACE if name != "_file"]
    across = joined(parts.withColumn("_record", opened), ["_file", "_record"], at)
    return whole.unionByName(across.select("value", "_file", "_place.*", *kept, *marks))
