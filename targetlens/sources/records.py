"""JSON record files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from targetlens.functions.flags import quoted
from targetlens.sources import pieces
from targetlens.storage import written

_NO_ARRAY = "no JSON array at the root of the file, from its first to its last byte"
_NO_RECORD = "text between the records of a JSON array"
_STRICT = {"mode": "FAILFAST", "allowSingleQuotes": "false"}
_SPACE = "[ \\t\\r\\n]*"
_OPENS, _CLOSES = rf"^{_SPACE}\[", rf"\]{_SPACE}$"
# Files that Spark inflates as it reads them; no block of them can be read by itself.
_COMPRESSED = r"(?i)\.(gz|bz2|lz4|snappy|deflate|zst|zstd)$"


def _checked(text: Column, good: Column, error: str = _NO_ARRAY) -> Column:
    return F.when(good, text).otherwise(F.raise_error(F.lit(error)))


def read_json_array(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    indent: int | None = None,
    whole_file: bool = False,
) -> DataFrame:
    """Records of files that each hold one JSON array of objects.

    A large file is read by many tasks, whatever its layout. Where the first lines of the largest
    show that each record begins a line behind a comma, files are cut there: a raw line break cannot
    occur inside a JSON text, so the cut is exact, and nothing is shuffled. ``indent`` gives the
    margin of those lines instead. Every piece is parsed as an array to its end, so all its records
    count however they are separated. Files of any other layout, one line included, are cut at every
    closing brace; whether a cut lies inside a string, and how deep, follows from the quotes and
    brackets before it, which are summed up per block and carried from block to block. Cuts outside
    strings at depth one end a record. ``whole_file`` reads each file by one task, and so are
    compressed ones of the latter kind.

    A file must be an array from its first to its last byte: one that is cut off anywhere, that has
    another root or an element that is no object, or that goes on behind the array, is an error, as
    is an empty file. To prove it, the files are read once when this is called, and again for the
    result. Partition columns of the path stay.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    files = spark.read.format("binaryFile").load(path)
    listed = len(files.inputFiles())
    files = files.select("_metadata.file_path", "_metadata.file_size")
    if files.count() < listed:
        raise ValueError(f"{_NO_ARRAY}: an empty file in {path}")
    cut = None if whole_file else _separator(spark, path, files, indent)
    if cut is not None:
        return _of_lines(spark, path, cut, schema)
    if whole_file or not files.where(F.col("file_path").rlike(_COMPRESSED)).isEmpty():
        texts = spark.read.text(path, wholetext=True)
        return _parsed(texts, _checked(F.col("value"), F.col("value").rlike(_OPENS)), schema)
    return _of_blocks(spark, path, files, schema)


def _separator(
    spark: SparkSession, path: str, files: DataFrame, indent: int | None
) -> str | None:
    """What stands between two records where the first lines show that each begins a line.

    They are those of the largest file: others may hold an empty array, which shows nothing.
    """
    largest = files.orderBy(F.desc("file_size"), "file_path").first()
    if largest is None:
        return None
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.where(F.col("_metadata.file_path") == largest["file_path"])
    first = [row[0] for row in lines.select(F.substring("value", 1, 1_000)).head(2)]
    opening, record = (first + ["", ""])[:2]
    margin = record[: len(record) - len(record.lstrip())]
    if indent is not None:
        margin = " " * indent
    elif opening.strip() != "[" or not record.lstrip().startswith("{"):
        return None
    return f",{'\r' if opening.endswith('\r') else ''}\n{margin}{{"


def _of_lines(spark: SparkSession, path: str, cut: str, schema: T.StructType) -> DataFrame:
    """Records of files cut between lines; the first piece alone opens the array, the last closes it.

    Behind a cut, which takes the opening brace, a name or the closing brace follows.
    """
    found = pieces.scan(spark, path, cut)
    value = F.col("value")
    opens, closes = value.rlike(_OPENS), value.rlike(_CLOSES)
    # By block first, where the order is a number: no task sorts its pieces for it.
    blocks = found.groupBy(*pieces.BLOCK).agg(
        F.count_if(opens).alias("_opened"),
        F.count_if(closes).alias("_closed"),
        F.min_by(opens, "_order").alias("_first"),
        F.max_by(closes, "_order").alias("_last"),
    )
    place = F.struct("_block", "_run")
    proof = blocks.groupBy("_file").agg(
        (F.sum("_opened") == 1).alias("_opened"),
        (F.sum("_closed") == 1).alias("_closed"),
        F.min_by("_first", place).alias("_first"),
        F.max_by("_last", place).alias("_last"),
    )
    wrong = proof.where("not (_opened and _closed and _first and _last)").first()
    if wrong is not None:
        raise ValueError(f"{_NO_ARRAY}: {wrong['_file']}")
    array = F.concat(
        F.when(opens, "").otherwise("[{"), value, F.when(closes, "").otherwise("]")
    )
    array = _checked(array, value.rlike(r'^\s*[\["}]') & value.rlike(r"[}\]]\s*$"))
    return _parsed(found.drop(*pieces.PLACE), array, schema)


def _parsed(texts: DataFrame, array: Column, schema: T.StructType) -> DataFrame:
    """The records of each array; ``from_json`` stops at the end of a value, so a mark follows it."""
    kind = T.StructType().add("records", T.ArrayType(schema)).add("whole", T.BooleanType())
    text = F.concat(F.lit('{"records":'), array, F.lit(',"whole":true}'))
    kept = [quoted(name) for name in texts.columns if name != "value"]
    parsed = texts.select(F.from_json(text, kind, _STRICT).alias("_text"), *kept)
    whole = F.coalesce(F.col("_text.whole"), F.lit(False))
    found = F.explode(_checked(F.col("_text.records"), whole))
    return parsed.select(found.alias("_record"), *kept).select("_record.*", *kept)


def _count(text: Column, sign: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))


def _deeper(plain: Column, odd: Column, inside: bool) -> Column:
    """How much deeper the text is behind a piece and its closing brace than before the piece.

    ``plain`` is the piece without escapes, ``odd`` whether it has an odd number of quotes,
    ``inside`` whether it begins within a string.
    """
    text = F.concat(F.lit('"'), plain) if inside else plain
    bare = F.regexp_replace(text, '"[^"]*+"?', "")
    brace = odd if inside else ~odd
    return _count(bare, "{") + _count(bare, "[") - _count(bare, "]") - brace.cast("int")


def _measured(found: DataFrame) -> DataFrame:
    """Pieces with ``_odd`` (they begin and end on different sides of a quote), ``_out`` and ``_in``
    (how much deeper they lead where they begin outside or inside a string) and ``_bytes``."""
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    odd = _count(F.col("_plain"), '"') % 2 == 1
    found = found.withColumn("_plain", plain).withColumn("_odd", odd)
    for name, inside in (("_out", False), ("_in", True)):
        found = found.withColumn(name, _deeper(F.col("_plain"), F.col("_odd"), inside))
    return found.drop("_plain").withColumn("_bytes", F.octet_length("value").cast("long") + 1)


def _with_turns(measured: DataFrame) -> DataFrame:
    """``_turned``: whether a piece begins on the other side of a quote than its block."""
    turns = F.sum(F.col("_odd").cast("long")).over(pieces.in_block())
    return measured.withColumn("_turned", (turns - F.col("_odd").cast("long")) % 2 == 1)


def _blocks(measured: DataFrame) -> DataFrame:
    """For each block whether it begins ``_inside`` a string, at which ``_depth``, whether it
    ``_leaves`` in the middle of a record, and whether it is its file's ``_final`` one."""
    turned = F.col("_turned")
    sums = _with_turns(measured).groupBy(*pieces.BLOCK).agg(
        F.sum(F.col("_odd").cast("long")).alias("_quotes"),
        F.sum(F.when(turned, F.col("_in")).otherwise(F.col("_out"))).alias("_from_out"),
        F.sum(F.when(turned, F.col("_out")).otherwise(F.col("_in"))).alias("_from_in"),
        F.sum("_bytes").alias("_bytes"),
    )
    quotes = F.sum("_quotes").over(pieces.in_file())
    sums = sums.withColumn("_inside", (quotes - F.col("_quotes")) % 2 == 1)
    sums = sums.withColumn("_ends_inside", quotes % 2 == 1)
    deeper = F.when(F.col("_inside"), F.col("_from_in")).otherwise(F.col("_from_out"))
    depth = F.sum(deeper).over(pieces.in_file())
    following = F.lead("_block").over(pieces.in_file())
    return sums.select(
        *pieces.BLOCK,
        "_bytes",
        "_inside",
        (depth - deeper).alias("_depth"),
        (F.col("_ends_inside") | (depth != 1)).alias("_leaves"),
        following.isNull().alias("_final"),
    )


def _of_blocks(
    spark: SparkSession, path: str, files: DataFrame, schema: T.StructType
) -> DataFrame:
    measured = pieces.dealt(spark, path, _measured(pieces.scan(spark, path, "}")))
    blocks = written(_blocks(measured), "json-blocks").table
    # The last piece has no brace behind it, so the pieces with one each are a byte longer.
    read = blocks.groupBy("_file").agg(F.sum("_bytes").alias("_bytes"))
    ended = F.coalesce(F.col("_bytes") == F.col("file_size") + 1, F.lit(False))
    wrong = files.join(read, F.col("file_path") == F.col("_file"), "left").where(~ended).first()
    if wrong is not None:
        raise ValueError(f"{_NO_ARRAY}: {wrong['file_path']}")

    kept = pieces.carried(measured.columns)
    judged = _with_turns(measured.drop("_bytes").join(blocks.drop("_bytes"), pieces.BLOCK))
    inside = F.col("_inside") != F.col("_turned")
    deeper = F.when(inside, F.col("_in")).otherwise(F.col("_out"))
    depth = F.col("_depth") + F.sum(deeper).over(pieces.in_block())
    ends = (inside == F.col("_odd")) & (depth == 1)
    judged = judged.withColumn("_ends", ends)
    begins = ~F.col("_inside") & (F.col("_depth") <= 1)
    judged = judged.withColumn("_starts", pieces.before(F.col("_ends"), pieces.in_block(), begins))

    # The last piece of a file closes the array; it may also be all of an empty one.
    last = F.col("_final") & F.lead("_order").over(pieces.in_block()).isNull()
    first = (F.col("_depth") == 0) & F.lag("_order").over(pieces.in_block()).isNull()
    judged = judged.withColumn("_last", last).withColumn("_first", first)
    value = F.col("value")
    closes = F.when(F.col("_first"), value.rlike(rf"^{_SPACE}\[{_SPACE}\]{_SPACE}$"))
    closes = closes.otherwise(F.col("_starts") & value.rlike(rf"^{_SPACE}\]{_SPACE}$"))
    judged = judged.where(F.when(F.col("_last"), ~_checked(closes, closes)).otherwise(True))

    leaves = F.col("_leaves") & ~F.col("_final")
    found = pieces.assembled(judged.withColumn("_leaves", leaves), "}", kept)
    opening = rf"^{_SPACE}[\[,]{_SPACE}\{{"
    text = F.concat(F.regexp_replace("value", opening, "{"), F.lit("}"))
    text = _checked(text, value.rlike(opening), _NO_RECORD)
    columns = [quoted(name) for name in kept]
    parsed = found.select(F.from_json(text, schema, _STRICT).alias("_record"), *columns)
    return parsed.select("_record.*", *columns)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Records written one per line, as the sinks write them."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
