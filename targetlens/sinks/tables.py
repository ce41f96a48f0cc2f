"""K1-K4: CSV, JSON records, clean export and chunked export.

``mode`` is what happens when the folder exists, as in Spark's writer; nothing is replaced unless
asked for.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from targetlens import fixed_values as fixed
from targetlens.functions.flags import has_column, is_missing, quoted
from targetlens.functions.text import gene_uri, sanitize_text
from targetlens.operators.chunks import chunk_numbers
from targetlens.operators.shape import export_keys


def write_csv(
    df: DataFrame, path: str, separator: str = ",", mode: str = "errorifexists"
) -> None:
    """K1: delimited text with a header; flags are spelled True and False, nulls are empty.

    White space at the ends of a cell stays.
    """

    def cell(field: T.StructField) -> Column:
        column = quoted(field.name)
        if isinstance(field.dataType, T.BooleanType):
            column = F.when(column, F.lit("True")).when(~column, F.lit("False"))
        return column.alias(field.name)

    cells = df.select(*[cell(field) for field in df.schema.fields])
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    options |= {"header": True, "sep": separator, "escape": '"', "emptyValue": ""}
    cells.write.options(**options).csv(path, mode)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K2: one JSON object per line, nulls included."""
    df.write.option("ignoreNullFields", False).json(path, mode)


def clean_records(
    df: DataFrame,
    keep_id: bool,
    with_uri: bool = False,
    typed: bool = False,
    id_column: str = "id",
    genome: str = fixed.GENOME,
    gene: str = fixed.GENE,
    base_url: str = fixed.GENE_PAGE_BASE,
    project_prefixes: Sequence[str] = fixed.PROJECT_PREFIXES,
    missing_slug: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """K3: rows ready for export: export keys as names, ``NaN`` for every missing value.

    A list with a gap counts as missing. The id is dropped or stands first; the page address
    stands last. A column that may be missing becomes text, or with ``typed`` a variant, in which
    present numbers, flags and lists keep their type. The ``carry`` columns, such as a row's place
    in its file, follow unchanged.
    """

    def cell(field: T.StructField) -> Column:
        column, gap = quoted(field.name), is_missing(df, field.name)
        listed = isinstance(field.dataType, T.ArrayType)
        if listed:
            gap = gap | F.exists(column, lambda item: item.isNull())
        elif not field.nullable and not isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return column.alias(field.name)
        missing = F.lit(fixed.MISSING_TEXT)
        if typed:
            value, missing = column.cast("variant"), missing.cast("variant")
        else:
            value = F.to_json(column) if listed else column.cast("string")
        return F.when(F.coalesce(gap, F.lit(True)), missing).otherwise(value).alias(field.name)

    fields = [field for field in df.schema.fields if field.name not in (id_column, *carry)]
    names, columns = [field.name for field in fields], [cell(field) for field in fields]
    if keep_id:
        names.insert(0, id_column)
        columns.insert(0, sanitize_text(quoted(id_column)).alias(id_column))
    keys = export_keys(names)
    if with_uri:
        uri = F.lit(None).cast("string")
        if has_column(df, genome) and has_column(df, gene):
            uri = gene_uri(quoted(genome), quoted(gene), base_url, project_prefixes, missing_slug)
        keys.append("URI")
        columns.append(F.coalesce(uri, F.lit(fixed.MISSING_TEXT)).alias("URI"))
    carried = [quoted(name) for name in carry]
    return df.select(*columns, *carried).toDF(*keys, *carry)


def write_clean_json(
    df: DataFrame, path: str, keep_id: bool, mode: str = "errorifexists", **options
) -> None:
    """K3: clean records as JSON lines, present values keeping their JSON type."""
    write_json(clean_records(df, keep_id, typed=True, **options), path, mode)


def write_bounded(
    df: DataFrame, path: str, most_rows: int, mode: str = "errorifexists"
) -> None:
    """K4: JSON lines in files of at most ``most_rows`` rows, without chunk numbers."""
    df.write.options(maxRecordsPerFile=most_rows, ignoreNullFields=False).json(path, mode)


def _written_by_chunk(numbered: DataFrame) -> DataFrame:
    """One task per chunk, its rows in order; a chunk is never larger than its size."""
    return numbered.repartition("chunk").sortWithinPartitions("chunk", "position")


def write_array_chunks(
    df: DataFrame,
    path: str,
    order_by: Sequence[str],
    size: int = fixed.CHUNK_RECORDS,
    leave_out: Sequence[str] = (),
    mode: str = "errorifexists",
    names: str | None = None,
) -> None:
    """K4 with one JSON array per chunk file, one record per line inside it.

    ``order_by`` must identify a row; the ``leave_out`` columns are not written. Chunks are folders
    with one file each. With ``names``, such as ``output_{}.json``, the folder holds the files
    themselves under these names, by number from 1: they take them when all are written, so a task
    that runs again leaves none behind.
    """
    numbered = chunk_numbers(df, order_by, size)
    total = numbered.agg(F.count(F.lit(1)).alias("rows")).first()["rows"]
    place = F.col("position")
    shown = [quoted(name) for name in df.columns if name not in leave_out]
    record = F.to_json(F.struct(*shown), {"ignoreNullFields": "false"})
    opens = F.when(place % size == 0, "[\n").otherwise("")
    ends = (place % size == size - 1) | (place == total - 1)
    line = F.concat(opens, record, F.when(ends, "\n]").otherwise(","))
    lines = _written_by_chunk(numbered.select("chunk", "position", line.alias("value")))
    lines = lines.drop("position")
    if names is None:
        lines.write.mode(mode).partitionBy("chunk").text(path)
    else:
        _write_named(lines, path, names, mode)


def _write_named(lines: DataFrame, path: str, names: str, mode: str) -> None:
    """Chunk files moved to their names in ``path``, which appears with all of them or not at all."""
    spark = lines.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs
    target = jvm.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError("named chunks are written with errorifexists or overwrite")
    if mode == "errorifexists" and files.exists(target):
        raise ValueError(f"{path} exists")
    draft, ready = (f"{path.rstrip('/')}._{step}-{uuid.uuid4().hex}" for step in ("draft", "ready"))
    lines.write.partitionBy("chunk").text(draft)
    files.mkdirs(jvm.Path(ready))
    for folder in files.globStatus(jvm.Path(f"{draft}/chunk=*")) or ():
        number = folder.getPath().getName().removeprefix("chunk=")
        (part,) = files.globStatus(jvm.Path(folder.getPath(), "part-*"))
        moved = files.rename(part.getPath(), jvm.Path(ready, names.format(number)))
        if not moved:
            raise OSError(f"chunk {number} could not be moved to {path}")
    if files.exists(target):
        files.delete(target, True)
    if not files.rename(jvm.Path(ready), target):
        raise OSError(f"{path} could not be written")
    files.delete(jvm.Path(draft), True)


def write_chunks(
    df: DataFrame,
    path: str,
    order_by: Sequence[str],
    size: int = fixed.CHUNK_RECORDS,
    leave_out: Sequence[str] = (),
    mode: str = "errorifexists",
) -> None:
    """K4: folders ``chunk=1`` to ``chunk=k`` with ``size`` rows each, the last one the rest.

    Order is kept within and across chunks; ``order_by`` must identify a row. The ``leave_out``
    columns are not written.
    """
    rows = _written_by_chunk(chunk_numbers(df, order_by, size)).drop("position", *leave_out)
    rows.write.partitionBy("chunk").option("ignoreNullFields", False).json(path, mode)
