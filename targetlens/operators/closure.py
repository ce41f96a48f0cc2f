"""G1: descendants of ontology terms, for all roots of interest in one run.

What a term has above it is found by doubling: round k knows every root that a term reaches in fewer
than 2^k steps, and every term it reaches in exactly 2^k. Both follow for k + 1 by one join each, so
the number of rounds is the logarithm of the depth. The roots that a term reaches are bits of a
number, so a term is one row for each 63 roots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from targetlens.operators.joins import find_hot_keys, fits_broadcast, spread_join
from targetlens.storage import Written, written

# Bits of a positive long.
ROOTS_PER_WORD = 63


def descendants(
    edges: DataFrame,
    roots: Sequence[str],
    terms: DataFrame | None = None,
    alternates: DataFrame | None = None,
) -> DataFrame:
    """Pairs ``(root, term)``: each root with itself and every term below it, once.

    ``edges`` holds ``(child, parent)``. ``terms`` with a ``go_id`` column, when given, must know
    every root. A root that is an alternate id (``alternates``: ``alt_id``, ``go_id``) stands for
    its primary term: it gets that term's descendants, and itself in the term's place. Loops are
    allowed; edges with a missing end lead nowhere.

    The pairs that are exactly 2^k steps apart are one table; in an ontology, where a term has few
    terms above it, it is of the size of the edges times the terms at that distance.
    """
    spark = edges.sparkSession
    primary = {root: root for root in roots}
    if alternates is not None:
        named = alternates.where(F.col("alt_id").isin(list(roots))).distinct().collect()
        primary.update({row["alt_id"]: row["go_id"] for row in named})
    if terms is not None:
        asked = terms.where(F.col("go_id").isin(list(primary.values()))).select("go_id").distinct()
        known = {row["go_id"] for row in asked.collect()}
        unknown = sorted(root for root, term in primary.items() if term not in known)
        if unknown:
            raise ValueError(f"unknown ontology terms {unknown}")

    kind = edges.schema["parent"].dataType.simpleString()
    places = [(root, term, i // ROOTS_PER_WORD, i % ROOTS_PER_WORD)
              for i, (root, term) in enumerate(primary.items())]
    starts = spark.createDataFrame(places, "root string, term string, word int, bit int")
    starts = starts.withColumns({name: F.col(name).cast(kind) for name in ("root", "term")})
    mask = F.expr("shiftleft(1L, bit)").alias("mask")
    reached = _summed(starts.select("term", "word", mask))
    steps = edges.select(F.col("child").alias("term"), F.col("parent").alias("above"))
    jumps = written(steps.where("term is not null and above is not null").distinct(), "jumps")
    bits, more = _bits(reached), True
    while more and not jumps.table.isEmpty():
        further = _met(jumps, reached).select("term", "word", "mask")
        reached = _summed(reached.table.unionByName(further))
        # What one round does not change, no later one does.
        before, bits = bits, _bits(reached)
        more = bits > before
        doubled = _met(jumps, jumps).select("term", F.col("far").alias("above"))
        jumps = written(doubled.distinct(), "jumps")

    named = F.broadcast(starts.withColumnRenamed("term", "primary"))
    is_set = F.expr("getbit(mask, bit) = 1")
    pairs = reached.table.join(named, "word").where(is_set)
    own = F.when(F.col("term") == F.col("primary"), F.col("root")).otherwise(F.col("term"))
    return pairs.select("root", own.alias("term"))


def _summed(marks: DataFrame) -> Written:
    """Each term's bits in one row per word."""
    return written(marks.groupBy("term", "word").agg(F.bit_or("mask").alias("mask")), "reached")


def _bits(reached: Written) -> int:
    return reached.table.agg(F.sum(F.bit_count("mask"))).first()[0] or 0


def _met(jumps: Written, side: Written) -> DataFrame:
    """``term`` of each jump with what ``side`` has of the term it leads to."""
    left = jumps.table.withColumnRenamed("above", "_over")
    right = side.table.withColumnsRenamed({"term": "_over", "above": "far"})
    if fits_broadcast(side):
        return left.join(F.broadcast(right), "_over")
    return spread_join(left, right, "_over", find_hot_keys(left, "_over"), "inner")
