"""Benchmark passages in documents: word windows against a hash set of the benchmark's, hits
verified on the words. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.llm.common import lower_ascii, plainly_named, saved

WINDOW = 13
MOST_BROADCAST_BYTES = 64_000_000
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of ASCII letters, digits and all non-ASCII characters, A to Z in lower case."""
    return F.regexp_extract_all(
        lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0)
    )


def benchmark_windows(
    benchmark: DataFrame, id_column: str, text_column: str, window: int
) -> DataFrame:
    """``hash``, ``length``, ``window``, ``items``: the distinct windows with their items.

    An item of fewer than ``window`` words is one window of all its words; without words, none.
    Items without id count as hits and are not listed.
    """
    split = benchmark.select(
        quoted(id_column).cast("string").alias("item"),
        words_of(quoted(text_column)).alias("words"),
    ).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, F.lit(window))
    )
    split = split.select("item", F.explode(windows).alias("window"))
    grouped = split.groupBy("window").agg(F.collect_set("item").alias("items"))
    return grouped.select(
        F.xxhash64("window").alias("hash"), F.size("window").alias("length"), "window", "items"
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """All columns of ``docs`` and a struct ``_hits``: ``n_words``, ``n_hit``, ``items``, ``spans``.

    A document word is hit if it lies in an occurrence of a benchmark window; ``items`` are the
    sorted ids, as text, of items with an occurring window; ``spans`` the word ranges hit, sorted.

    The windows' hash set is broadcast where it is known to be small, and joined by a shuffle
    otherwise; either way each hit is verified on the words of its own row. ``docs`` has no columns
    ``_key``, ``_found``, ``_words``, ``_hits`` of its own; the functions below take any. Null or empty texts
    have no words and no hits. Rows with a null or repeated id are matched like any other. An empty
    benchmark hits nothing.
    """
    windows = saved(
        benchmark_windows(benchmark, item_column, item_text_column, window), "windows"
    )
    size = windows.agg(
        F.sum(F.length(F.array_join("window", " ")) * 2 + 24 * F.size("items") + 64).alias("bytes"),
        F.collect_set("length").alias("lengths"),
    ).first()
    if (size["bytes"] or 0) <= MOST_BROADCAST_BYTES:
        windows = F.broadcast(windows)

    # The narrow side: a hash per window of each document, without its text.
    # Rows meet only with equal id and text, so the hits of one key are those of one text.
    key = F.xxhash64(quoted(id_column), quoted(text_column))
    split = docs.select(key.alias("_key"), words_of(quoted(text_column)).alias("words"))

    def hashes(length: int) -> DataFrame:
        starts = F.sequence(F.lit(0), F.size("words") - length)
        each = F.transform(starts, lambda i: F.xxhash64(F.slice("words", i + 1, F.lit(length))))
        long_enough = split.where(F.size("words") >= length)
        places = long_enough.select("_key", F.posexplode(each).alias("start", "hash"))
        return places.withColumn("length", F.lit(length))

    hits = None
    for length in sorted(size["lengths"]):
        found = hashes(length).join(windows, ["hash", "length"])
        found = found.select("_key", F.struct("start", "window", "items").alias("hit"))
        hits = found if hits is None else hits.unionAll(found)
    if hits is None:
        found = F.lit(None).cast(
            "array<struct<start:int,window:array<string>,items:array<string>>>"
        )
        joined = docs.withColumn("_found", found)
    else:
        hits = hits.groupBy("_key").agg(F.collect_set("hit").alias("_found"))
        joined = docs.join(hits, key == F.col("_key"), "left").drop("_key")
    return joined.withColumn("_words", words_of(quoted(text_column))).select(
        *[quoted(name) for name in docs.columns], _measured().alias("_hits")
    )


def _measured() -> Column:
    words = F.col("_words")
    verified = F.filter(
        F.coalesce("_found", F.array()),
        lambda x: F.slice(words, x["start"] + 1, F.size(x["window"])) == x["window"],
    )
    spans = F.array_sort(
        F.array_distinct(
            F.transform(
                verified,
                lambda x: F.struct(
                    x["start"].alias("start"), (x["start"] + F.size(x["window"])).alias("end")
                ),
            )
        )
    )
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("hit"))
    covered = F.aggregate(
        spans,
        start,
        lambda seen, x: F.struct(
            F.greatest(seen["reach"], x["end"]).alias("reach"),
            (
                seen["hit"] + F.greatest(x["end"] - F.greatest(seen["reach"], x["start"]), F.lit(0))
            ).alias("hit"),
        ),
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.transform(verified, lambda x: x["items"]))))
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        covered["hit"].alias("n_hit"),
        items.alias("items"),
        spans.alias("spans"),
    )


def is_contaminated(percent: int = 5) -> Column:
    """At least a word is hit, and ``percent`` of all words."""
    hit, words = F.col("_hits")["n_hit"], F.col("_hits")["n_words"]
    return (hit > 0) & (100 * hit >= percent * words)


def without_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    percent: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
    **options,
) -> DataFrame:
    """``docs`` without the contaminated ones; columns as given, whatever their names."""
    plain, names = plainly_named(docs)
    found = contamination(plain, benchmark, names[id_column], names[text_column], **options)
    kept = found.where(~is_contaminated(percent))
    return kept.select(*names.values()).toDF(*names)


def without_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    **options,
) -> DataFrame:
    """``docs`` with every hit word, and what stands between it and the next, cut from the text.

    Columns are as given, whatever their names.
    """
    plain, names = plainly_named(docs)
    found = contamination(plain, benchmark, names[id_column], names[text_column], **options)
    text, spans = F.col(names[text_column]), F.col("_hits")["spans"]
    gaps = F.split(text, WORD, -1)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    kept = F.transform(
        F.arrays_zip(words.alias("word"), F.slice(gaps, F.lit(2), F.size(words)).alias("gap")),
        lambda x, i: F.when(
            F.exists(spans, lambda s: (i >= s["start"]) & (i < s["end"])), F.lit("")
        ).otherwise(F.concat(x["word"], x["gap"])),
    )
    cut = F.concat(F.get(gaps, F.lit(0)), F.array_join(kept, ""))
    cut = F.when(F.size(spans) > 0, cut).otherwise(text)
    return found.withColumn(names[text_column], cut).select(*names.values()).toDF(*names)
