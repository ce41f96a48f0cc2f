"""Delimited text with a header line."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from targetlens import fixed_values as fixed
from targetlens.functions.flags import quoted
from targetlens.operators.shape import clean_missing, stack_by_name
from targetlens.sources import pieces
from targetlens.sources.schemas import column_types
from targetlens.storage import written

# Place of a row in its input: number of the path, file, block of the file, order in the block.
ORDER_COLUMNS = ["_file_number", "_file", "_block", "_row"]


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    types: StructType | Mapping[str, str] | None = None,
    separator: str = "\t",
    missing: Sequence[str] = fixed.MISSING_CELLS,
    file_number: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Columns by the names of the header line, missing cells null.

    ``types`` (a schema or type names) types the columns that are not text; a cell that does not
    fit its type becomes null. A line with another number of cells than the header, such as one
    half of a quoted cell with a line break, is an error. ``multi_line`` reads such cells, see
    :func:`_records`. Several paths must share one header, else reading fails; see
    :func:`read_stacked`.
    With ``file_number`` the :data:`ORDER_COLUMNS` are added, so that "first in the file" has a
    meaning after a shuffle.
    """
    paths = path if isinstance(path, str) else list(path)
    if multi_line:
        rows = _records(spark, paths, separator)
    else:
        rows = _placed(_reader(spark, separator, False).option("header", True).csv(paths))
    if file_number is None:
        rows = rows.drop("_file", "_block", "_row")
    else:
        names = [name for name in rows.columns if name not in ORDER_COLUMNS]
        number = F.lit(file_number).alias("_file_number")
        rows = rows.select(*map(quoted, names), number, "_file", "_block", "_row")
    cleaned = clean_missing(rows, missing)
    types = column_types(types)
    typed = cleaned.select(
        *[
            quoted(name).try_cast(types[name]).alias(name) if name in types else quoted(name)
            for name in cleaned.columns
        ]
    )
    return clean_missing(typed, [])


def _reader(spark: SparkSession, separator: str, multi_line: bool):
    options = {"sep": separator, "escape": '"', "enforceSchema": False, "mode": "FAILFAST"}
    return spark.read.options(**options, multiLine=multi_line, columnPruning=False)


def _placed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def _records(spark: SparkSession, paths: str | Sequence[str], separator: str) -> DataFrame:
    """Text columns by the header's names and where each record starts; cells may hold line breaks.

    A file is read by many tasks. Whether a line begins within a quoted cell follows from the lines
    before it: each line is summed up as what it makes of either case, the sums are combined within
    blocks, and the blocks' sums are carried through the file. The lines of a record are put
    together and parsed on their own. A quote opens a cell only at its beginning; a quoted cell that
    is still open at the end of its file is an error. Lines end at a line feed, with or without a
    carriage return; breaks inside cells stay as they are. Blank lines outside cells are no records.
    The files are read once when this is called and again for the result; where no cell is found to
    hold a break, as the lines they are, without a shuffle.
    """
    reader = _reader(spark, separator, True)
    lines = _marked(pieces.scan(spark, paths, "\n"), separator)
    lines = pieces.dealt(spark, paths, lines)
    kept = pieces.carried(lines.columns)
    names = [n for n in reader.option("header", True).csv(paths).columns if n not in kept]
    if not names:
        return _placed(reader.csv(paths))
    blocks = written(_carried(lines), "quoted-blocks").table
    open_at = blocks.where("_unclosed").first()
    if open_at is not None:
        raise ValueError(f"a quoted cell is not closed in {open_at['_file']}")
    if blocks.where("_breaks").isEmpty():
        return _placed(_reader(spark, separator, False).option("header", True).csv(paths))

    judged = _with_state(lines.join(blocks, pieces.BLOCK), pieces.in_block())
    after = F.when(F.col("_inside"), F.col("_from_in")).otherwise(F.col("_from_out"))
    judged = judged.withColumn("_after", after)
    within = pieces.before(F.col("_after"), pieces.in_block(), F.col("_inside"))
    judged = judged.withColumn("_starts", ~within)
    judged = judged.withColumn("_is_header", F.col("_order").eqNullSafe(F.col("_header")))
    found = pieces.assembled(judged, "\n", kept, ["_is_header"])

    found = found.withColumn("value", F.regexp_replace("value", r"\r$", ""))
    options = {"sep": separator, "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    inner = [f"_{i}" for i in range(len(names))]
    parsed = F.from_csv("value", ", ".join(f"{name} string" for name in inner), options)
    found = found.where(F.trim("value") != "").withColumn("_cells", parsed)
    first = reader.option("header", False).csv(paths).head()
    same = F.array(*[F.col("_cells")[name] for name in inner]).eqNullSafe(
        F.array(*[F.lit(cell).cast("string") for cell in first[: len(names)]])
    )
    error = F.raise_error(F.lit("the files of one scan do not share their header"))
    is_header = F.when(F.col("_is_header"), F.when(same, F.lit(True)).otherwise(error))
    return found.where(~F.coalesce(is_header, F.lit(False))).select(
        *[F.col("_cells")[old].alias(new) for old, new in zip(inner, names, strict=True)],
        *map(quoted, kept),
        "_file",
        "_block",
        F.col("_order").alias("_row"),
    )


def _marked(lines: DataFrame, separator: str) -> DataFrame:
    """Lines with ``_out`` and ``_in``: whether a quoted cell is open at the end of a line that
    begins outside or inside one."""
    no = f"[^{re.escape(separator)}]*+"
    rest = rf'(?s)(?:[^"]++|"")*+"{no}'
    cell = rf'(?:"(?:[^"]++|"")*+"{no}|(?!"){no})'
    more = f"(?:{re.escape(separator)}{cell})*+"
    value = F.col("value")
    plain = ~F.contains(value, F.lit('"'))
    return lines.withColumns({
        "_out": ~plain & ~value.rlike(f"(?s)^{cell}{more}$"),
        "_in": plain | ~value.rlike(f"^{rest}{more}$"),
        "_blank": F.trim(F.regexp_replace(value, r"\r$", "")) == "",
        "_returns": value.rlike(r"\r(?!$)"),
    })


def _with_state(rows: DataFrame, window) -> DataFrame:
    """``_from_out``, ``_from_in``: whether a cell is open behind each row where the window's first
    row begins outside or inside one.

    A row either sets the state, turns it, or leaves it: the last row that sets it counts, and how
    often it was turned since.
    """
    opens, keeps = F.col("_out"), F.col("_in")
    turns = F.sum((opens & ~keeps).cast("long")).over(window)
    rows = rows.withColumn("_turns", turns)
    setting = F.when(opens == keeps, F.struct(opens.alias("state"), F.col("_turns").alias("at")))
    rows = rows.withColumn("_set", F.last(setting, ignorenulls=True).over(window))
    since = F.col("_turns") - F.coalesce(F.col("_set.at"), F.lit(0))
    turned = since % 2 == 1
    for name, start in (("_from_out", False), ("_from_in", True)):
        rows = rows.withColumn(name, F.coalesce(F.col("_set.state"), F.lit(start)) != turned)
    return rows.drop("_turns", "_set")


def _carried(lines: DataFrame) -> DataFrame:
    """For each block whether it begins ``_inside`` a quoted cell and ``_leaves`` in one, the place
    of its file's ``_header`` if that is in it, whether the file ends ``_unclosed``, and whether any
    line ``_breaks`` off within a cell, so far as the block shows."""
    ends = F.max_by(F.struct("_from_out", "_from_in"), "_order")
    ended = _with_state(lines, pieces.in_block()).groupBy(*pieces.BLOCK).agg(
        ends.alias("_end"), F.min(F.when(~F.col("_blank"), F.col("_order"))).alias("_filled"),
        F.bool_or(F.col("_from_out") | F.col("_returns")).alias("_breaks"),
    )
    blocks = ended.select(
        *pieces.BLOCK, "_filled", "_breaks",
        F.col("_end._from_out").alias("_out"), F.col("_end._from_in").alias("_in"),
    )
    leaves = F.col("_from_out")
    seen = F.count("_filled").over(pieces.in_file())
    following = F.lead("_block").over(pieces.in_file())
    return _with_state(blocks, pieces.in_file()).select(
        *pieces.BLOCK,
        pieces.before(leaves, pieces.in_file(), F.lit(False)).alias("_inside"),
        leaves.alias("_leaves"),
        F.when(seen == 1, F.col("_filled")).alias("_header"),
        (leaves & following.isNull()).alias("_unclosed"),
        "_breaks",
    )


def read_csv(
    spark: SparkSession,
    path: str,
    types: StructType | Mapping[str, str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Comma-separated, otherwise as :func:`read_delimited`."""
    return read_delimited(spark, path, types, separator=",", multi_line=multi_line)


def read_stacked(
    spark: SparkSession,
    paths: Sequence[str],
    types: StructType | Mapping[str, str] | None = None,
    separator: str = "\t",
    multi_line: bool = False,
) -> DataFrame:
    """S3: several files by column name, with :data:`ORDER_COLUMNS` in the order of ``paths``.

    A file that does not exist is an error. ``multi_line`` reads quoted cells with line breaks.
    """
    tables = [
        read_delimited(
            spark, path, types, separator, file_number=number, multi_line=multi_line
        )
        for number, path in enumerate(paths)
    ]
    return stack_by_name(tables)
