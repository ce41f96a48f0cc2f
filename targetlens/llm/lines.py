"""Lines that repeat across documents, dropped but where they stand last. Built-in functions only.

Hashes of the lines are range-partitioned and sorted by document and position, so that the first
occurrences of each line are seen as its rows stream by. What comes back is a bitmap per document of
the lines to keep, not text. Lines that are very frequent are counted before anything moves and
looked up instead of sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.llm.common import let, lower_ascii, saved
from targetlens.operators.joins import find_hot_keys, left_join

LEAST_CHARACTERS = 20
LEAST_DOCUMENTS = 3
# A line with fewer rows is never counted apart.
FEWEST_HOT_ROWS = 1_000
SPACE = " \t\n\x0b\x0c\r"
WORD_BITS = 64
HASH = ["hash", "check"]


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A to Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def row_key(id_column: Column, text: Column) -> Column:
    """What rows of equal id and text have in common: 128 bits as text."""
    return F.concat(F.hex(F.xxhash64(id_column, text)), F.hex(F.xxhash64(text, id_column)))


def _long_lines(docs: DataFrame, least_characters: int) -> DataFrame:
    """``row``, ``id``, ``place``, and 128 bits of each line that is long enough."""
    lines = docs.select("row", "id", F.posexplode(lines_of(F.col("text"))).alias("place", "line"))
    lines = lines.where(F.octet_length("line") >= least_characters)
    lines = lines.select("row", "id", "place", line_key(F.col("line")).alias("key"))
    lines = lines.where(F.char_length("key") >= least_characters)
    return lines.select(
        "row",
        "id",
        "place",
        F.xxhash64("key").alias("hash"),
        F.xxhash64(F.lit(LEAST_DOCUMENTS), "key").alias("check"),
    )


def _frequent(lines: DataFrame, least_documents: int):
    """Hashes with very many rows: ``hash``, ``check``, ``last`` id, whether they are ``common``.

    At most one per shuffle partition. Rows are summed up per document and then per line, partly
    before they move.
    """
    hot = [key for key, _ in find_hot_keys(lines, "hash", FEWEST_HOT_ROWS).pieces]
    if not hot:
        return None
    spark = lines.sparkSession
    keys = F.broadcast(spark.createDataFrame([(key,) for key in hot], "hash long"))
    some = lines.join(keys, "hash", "left_semi").groupBy(*HASH, "id").count()
    found = some.groupBy(*HASH).agg(
        F.max("id").alias("last"), (F.count(F.lit(1)) >= least_documents).alias("common")
    )
    return saved(found, "frequent-lines")


def _streamed(lines: DataFrame, least_documents: int) -> DataFrame:
    """Dropped lines among those whose rows are few enough to be sorted together.

    Documents that hold a line are numbered from the largest id down as they stream by; the line
    stays in the first, and elsewhere if they are too few.
    """
    count = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = lines.repartitionByRange(count, *HASH)
    ranged = ranged.sortWithinPartitions(*HASH, F.desc_nulls_last("id"), "place")
    stream = Window.partitionBy(*HASH).orderBy(F.desc_nulls_last("id"))
    number = F.dense_rank().over(stream)
    total = F.max("number").over(Window.partitionBy(*HASH))
    seen = ranged.withColumn("number", number).withColumn("total", total)
    return seen.where((F.col("total") >= least_documents) & (F.col("number") > 1))


def dropped_bitmaps(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_characters: int = LEAST_CHARACTERS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """``row``, ``dropped``: a compressed bitmap of the lines that each document loses.

    ``dropped`` lists the words of 64 lines that lose any, as ``word`` (its number) and ``bits``;
    words that are not listed, and documents that are not, keep all their lines. ``row`` is
    :func:`row_key`. See :func:`kept_lines` for what is dropped.
    """
    rows = docs.select(
        row_key(quoted(id_column), quoted(text_column)).alias("row"),
        quoted(id_column).alias("id"),
        quoted(text_column).alias("text"),
    )
    lines = saved(_long_lines(rows, least_characters), "lines")
    frequent = _frequent(lines, least_documents)
    if frequent is None:
        dropped = _streamed(lines, least_documents).select("row", "place")
    else:
        frequent = F.broadcast(frequent)
        others = lines.join(frequent.select(*HASH), HASH, "left_anti")
        looked_up = lines.join(frequent.where("common"), HASH)
        looked_up = looked_up.where(~F.col("id").eqNullSafe(F.col("last")))
        dropped = _streamed(others, least_documents).select("row", "place")
        dropped = dropped.unionByName(looked_up.select("row", "place"))
    word = F.expr(f"place div {WORD_BITS}").cast("int").alias("word")
    bit = F.expr(f"shiftleft(1L, place % {WORD_BITS})").alias("bit")
    words = dropped.select("row", word, bit).groupBy("row", "word")
    words = words.agg(F.bit_or("bit").alias("bits"))
    return words.groupBy("row").agg(F.collect_list(F.struct("word", "bits")).alias("dropped"))


def kept_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_characters: int = LEAST_CHARACTERS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """``document`` (all columns of ``docs``), ``lines``, and the ``dropped`` bitmap or null.

    Lines are compared without ASCII white space at their ends, A to Z in lower case. A line of at
    least ``least_characters`` that ``least_documents`` hold is dropped wherever it stands but in
    the one of the largest id among them. Rows of one id are one document, and so are rows without
    id, whose id is smaller than any other; equal rows have equal results. Null and empty texts are
    one empty line, which is too short to be dropped. An empty table gives an empty one. Further
    columns stay in ``document``, so no name can clash.
    """
    bitmaps = dropped_bitmaps(docs, id_column, text_column, least_characters, least_documents)
    bitmaps = saved(bitmaps, "line-bitmaps")
    whole = F.struct(*[quoted(name) for name in docs.columns]).alias("document")
    key = row_key(quoted(id_column), quoted(text_column)).alias("row")
    found = left_join(docs.select(whole, key), bitmaps, "row")
    text = F.col("document").getField(text_column)
    return found.select("document", lines_of(text).alias("lines"), "dropped")


def unpacked(dropped: Column) -> Column:
    """A bitmap with all its words in their places, as far as the last one listed."""

    def with_gap(marks: Column) -> Column:
        def filled(mark: Column, i: Column) -> Column:
            before = F.coalesce(F.get(marks, i - 1)["word"], F.lit(-1))
            gap = F.array_repeat(F.lit(0).cast("long"), mark["word"] - before - 1)
            return F.concat(gap, F.array(mark["bits"]))

        return F.flatten(F.transform(marks, filled))

    return let(F.array_sort(dropped), with_gap)


def is_kept(place: Column, words: Column) -> Column:
    """Whether the line of that place stays by an unpacked bitmap."""
    bits = F.coalesce(F.get(words, F.floor(place / WORD_BITS).cast("int")), F.lit(0).cast("long"))
    return F.getbit(bits, place % WORD_BITS) == 0


def n_dropped() -> Column:
    """How many lines the bitmap of :func:`kept_lines` drops."""
    bits = F.transform("dropped", lambda x: F.bit_count(x["bits"]))
    total = F.aggregate(bits, F.lit(0), lambda total, some: total + some)
    return F.coalesce(total, F.lit(0)).cast("long")


def kept_text() -> Column:
    """The text that the bitmap of :func:`kept_lines` leaves."""
    kept = let(
        unpacked(F.col("dropped")),
        lambda words: F.filter("lines", lambda line, place: is_kept(place, words)),
    )
    lines = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(kept)
    return F.array_join(lines, "\n")


def without_repeated_lines(docs: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """``docs`` without the lines that :func:`kept_lines` drops; a null text stays null."""
    found = kept_lines(docs, text_column=text_column, **options)
    before = F.col("document").getField(text_column)
    text = F.when(before.isNotNull(), kept_text()).alias(text_column)
    return found.select(
        *[
            text if name == text_column else F.col("document").getField(name).alias(name)
            for name in docs.columns
        ]
    )
