"""Near-duplicate documents by min-max hashing, with every link confirmed on the full sets.

Each of ``PERMUTATIONS`` permutations of the shingle hashes gives two signature values, its minimum
and its maximum, so half as many are evaluated as there are values. A band hashes ``ROWS`` of them;
bands share values, which costs no further evaluation. Documents that agree in a band are one
bucket. A pair of similarity 0.8 shares no band of 80 with a probability below 1e-4, one of 0.85
below 1e-6; documents that only share a passage (similarity 0.25) meet with less than 0.2 %.

Buckets are never expanded into all pairs. In each round, every bucket compares some members with
its others of a different component: first the one with most bucket mates, then those of small
components. What they link becomes one component, compared members leave, and a bucket whose members
are all in one component is done. The number of compared members grows each round, so a bucket that
links badly is still compared in full, and a large group of copies ends after one or two rounds.
After the first round, pairs are compared by what they do not share with their bucket's first
member, which is little among copies; only those that can be linked are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.llm.common import WordHashes, ascii_words, columns, lists, pieces, saved
from targetlens.llm.components import components

SHINGLE = 5
PERMUTATIONS = 64
ROWS = 8
BANDS = 80
ROWS_AT_ONCE = 8_192
CARRIED = 8
NONE = np.empty(0, np.int64)
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words; fewer words are one run."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    count = len(hashes) - size + 1
    runs = np.full(count, size, np.uint64)
    for place in range(size):
        runs = runs * ODD + hashes[place : place + count]
    return np.unique(mixed(runs))


def _picked(bands: int) -> np.ndarray:
    """For each band, which of the signature values it hashes; each in about as many bands."""
    order = np.random.default_rng(1)
    values = 2 * PERMUTATIONS
    rounds = -(-bands * ROWS // values)
    picked = np.concatenate([order.permutation(values) for _ in range(rounds)])
    return picked[: bands * ROWS].reshape(bands, ROWS)


SEEDS = mixed(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * ODD)
FLIPS, FACTORS = SEEDS[:PERMUTATIONS], SEEDS[PERMUTATIONS:] | np.uint64(1)


def min_max_bands(shingles: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """One hash per band, of the minima and maxima that it picks."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for start in range(0, len(shingles), ROWS_AT_ONCE):
        part = shingles[start : start + ROWS_AT_ONCE, None]
        permuted = (part ^ FLIPS) * FACTORS
        np.minimum(low, permuted.min(axis=0), out=low)
        np.maximum(high, permuted.max(axis=0), out=high)
    values = mixed(np.concatenate([low, high]))[picked]
    keys = np.arange(1, len(picked) + 1, dtype=np.uint64)
    for row in values.T:
        keys = keys * ODD + row
    return mixed(keys)


def _signatures(shingle: int, bands: int):
    picked = _picked(bands)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for piece, texts in pieces(batches):
            sizes, high, low, keys = [], [], [], []
            for text in texts:
                found = shingle_set(words.of(ascii_words(text)), shingle)
                digest = xxhash.xxh3_128_intdigest(found.tobytes())
                sizes.append(len(found))
                high.append((digest >> 64) - 2**63)
                low.append((digest & (2**64 - 1)) - 2**63)
                keys.append(min_max_bands(found, picked).view(np.int64) if len(found) else NONE)
            keys = lists(keys, pa.int64())
            yield columns(id=piece["id"], n_shingles=sizes, high=high, low=low, bands=keys)

    return sign


def _sets(shingle: int):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for piece, texts in pieces(batches):
            found = [shingle_set(words.of(ascii_words(t)), shingle).view(np.int64) for t in texts]
            yield columns(id=piece["id"], shingles=lists(found, pa.int64()))

    return collect


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    percent: int = 80,
    bands: int = BANDS,
) -> DataFrame:
    """``id_column``, ``n_shingles``, ``component_id``, ``kept``: one row per row of ``docs``.

    Words lie between ASCII white space, A to Z in lower case; a document's set holds its distinct
    runs of ``shingle`` words (all its words as one run when it has fewer). Documents are linked
    when their sets' Jaccard similarity is at least ``percent`` / 100. ``component_id`` is the
    smallest id reachable over links, ``kept`` says that it is the document's own. Documents with
    equal sets are one class with its smallest id as node; only classes are compared.

    Null or empty texts, or texts without words, have an empty set and are linked with nothing. A
    row without id is linked with nothing, has no ``component_id`` and is kept. Rows of one id are
    decided row by row; equal rows give equal results. Extra columns are ignored. An empty table
    gives an empty one.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    narrow = docs.select(
        quoted(id_column).alias("id"), quoted(text_column).cast("string").alias("text")
    )
    signed = narrow.mapInArrow(
        _signatures(shingle, bands),
        f"id {kind}, n_shingles long, high long, low long, bands array<long>",
    )
    signed = saved(signed, "signatures")
    linked = _class_components(narrow, signed, shingle, percent, kind)
    # The class of each document, and the component of its class.
    classes = _classes(signed)
    classes = classes.join(linked, classes["rep"] == linked["node"], "left")
    classes = classes.select("high", "low", F.coalesce("component", "rep").alias("component_id"))
    usable = (F.col("n_shingles") > 0) & F.col("id").isNotNull()
    found = signed.select("id", "n_shingles", F.when(usable, F.col("high")).alias("high"), "low")
    found = found.join(classes, ["high", "low"], "left")
    component = F.coalesce("component_id", "id")
    return found.select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def _classes(signed: DataFrame) -> DataFrame:
    """Documents of equal sets as one row with their smallest id."""
    usable = signed.where("n_shingles > 0 and id is not null")
    return usable.groupBy("high", "low").agg(F.min("id").alias("rep"))


def _class_components(
    narrow: DataFrame, signed: DataFrame, shingle: int, percent: int, kind: str
) -> DataFrame:
    """``node``, ``component`` for the classes that have a link."""
    usable = signed.where("n_shingles > 0 and id is not null")
    reps = usable.groupBy("high", "low").agg(
        F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n_shingles", "bands")]
    )
    reps = saved(reps.drop("high", "low"), "classes")
    rows = reps.select(F.explode("bands").alias("key"), "id")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1")
    members = saved(rows.join(sizes, "key"), "members")
    central = members.groupBy("id").agg(F.sum("mates").alias("central"))
    known = central.join(reps.select("id", "n_shingles").distinct(), "id")
    active = members.select("key", "id").distinct().join(known, "id")
    active = active.withColumns({"component": F.col("id"), "many": F.lit(1).cast("long")})
    active = saved(active, "active")
    wanted = central.select("id")
    sets = narrow.join(wanted, "id", "left_semi").mapInArrow(
        _sets(shingle), f"id {kind}, shingles array<long>"
    )
    sets = saved(sets, "sets")

    links = tested = None
    labels = members.sparkSession.createDataFrame([], f"node {kind}, component {kind}")
    compared = 1
    while not active.isEmpty():
        order = Window.partitionBy("key").orderBy("many", F.desc("central"), "id", "n_shingles")
        ranked = active.withColumn("rank", F.row_number().over(order))
        pivots = saved(ranked.where(F.col("rank") <= compared).drop("rank"), "pivots")
        if tested is None:
            pairs = saved(_first_pairs(active, pivots, percent), "candidates")
            found = saved(_compared(pairs, sets, percent, keep=True), "compared")
            rests = saved(_rests(pivots, found), "rests")
            first = pivots.select("key", F.col("id").alias("first"))
            active = active.join(first, "key")
            pivots = pivots.join(first, "key")
            tested = pairs
        else:
            pairs = saved(_pairs(active, pivots, rests, tested, percent), "candidates")
            found = saved(_compared(pairs, sets, percent), "compared")
            tested = tested.union(pairs)
        found = found.where("linked").select("a", "b")
        links = found if links is None else links.union(found)
        if not found.isEmpty():
            labels = components(links)
        active = saved(_left_over(active, pivots, labels), "active")
        compared *= 16
    return labels


def _first_pairs(active: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket's first member and another, unless their sizes are too different."""
    pivots = pivots.select(
        "key", F.col("id").alias("pivot_id"), F.col("n_shingles").alias("pivot_size")
    )
    small, large = (f("n_shingles", "pivot_size") for f in (F.least, F.greatest))
    pairs = active.join(pivots, "key").where(
        (F.col("id") != F.col("pivot_id")) & (100 * small >= percent * large)
    )
    return _ordered(pairs).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.least("id", "pivot_id").alias("a"), F.greatest("id", "pivot_id").alias("b")
    )


def _rests(pivots: DataFrame, found: DataFrame) -> DataFrame:
    """For a member and the first member it was compared with: how much they share, and the rest.

    An id with several texts is left out: nothing is ruled out for it.
    """
    once = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")).where("times = 1")
    found = found.join(once, ["a", "b"], "left_semi")
    firsts = pivots.select(F.col("id").alias("first")).distinct()
    sides = [("a", "b", "only_a"), ("b", "a", "only_b")]
    both = [
        found.select(F.col(x).alias("id"), F.col(y).alias("first"), "shared", F.col(o).alias("rest"))
        for x, y, o in sides
    ]
    return both[0].unionAll(both[1]).join(firsts, "first", "left_semi")


def _pairs(
    active: DataFrame, pivots: DataFrame, rests: DataFrame, tested: DataFrame, percent: int
) -> DataFrame:
    """Pairs of a compared member and another of its bucket that can be linked, not yet tested.

    Not those of one component, or of too different sizes, or that share too little: at most what
    either shares with the bucket's first member, and what their rests have in common. A pair
    comes from its first bucket, and from a further one only if both carry no earlier one.
    """
    active = active.join(_keys(active), "id").join(rests, ["id", "first"], "left")
    pivots = pivots.join(_keys(pivots), "id").join(rests, ["id", "first"], "left")
    names = [c for c in pivots.columns if c not in ("key", "first")]
    pivots = pivots.select("key", *[F.col(c).alias(f"pivot_{c}") for c in names])
    small, large = (f("n_shingles", "pivot_n_shingles") for f in (F.least, F.greatest))
    most = F.least("shared", "pivot_shared") + F.size(F.array_intersect("rest", "pivot_rest"))
    most = F.when(F.col("rest").isNotNull() & F.col("pivot_rest").isNotNull(), most)
    most = F.coalesce(most, small)
    before = F.array_min(F.array_intersect("keys", "pivot_keys")) < F.col("key")
    pairs = active.join(pivots, "key").where(
        (F.col("component") != F.col("pivot_component"))
        & (100 * small >= percent * large)
        & ~F.coalesce(before, F.lit(False))
        & (100 * most >= percent * (small + large - most))
    )
    return _ordered(pairs).distinct().join(tested, ["a", "b"], "left_anti")


def _keys(members: DataFrame) -> DataFrame:
    """The smallest ``CARRIED`` buckets of each id.

    All of them, at every bucket, would be most of what a join of buckets moves. Members that share
    many buckets nearly always share the first of these among them.
    """
    keys = F.slice(F.sort_array(F.collect_set("key")), 1, CARRIED)
    return members.groupBy("id").agg(keys.alias("keys"))


def _compared(pairs: DataFrame, sets: DataFrame, percent: int, keep: bool = False) -> DataFrame:
    """Whether the full sets of the pairs are similar enough; ``keep`` what they do not share."""
    first = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(first, "a").join(second, "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    rests = [
        F.array_except("of_a", "of_b").alias("only_a"), F.array_except("of_b", "of_a").alias("only_b")
    ]
    both = both.select(
        "a", "b", shared.alias("shared"), (F.size("of_a") + F.size("of_b")).alias("total"),
        *(rests if keep else []),
    )
    either = F.col("total") - F.col("shared")
    return both.withColumn("linked", 100 * F.col("shared") >= percent * either)


def _left_over(active: DataFrame, pivots: DataFrame, labels: DataFrame) -> DataFrame:
    """Members not yet compared, of buckets that still hold more than one component."""
    many = labels.groupBy("component").agg(F.count(F.lit(1)).alias("many"))
    labels = labels.join(many, "component")
    left = active.join(pivots.select("key", "id"), ["key", "id"], "left_anti")
    left = left.drop("component", "many").join(labels, F.col("id") == F.col("node"), "left")
    left = left.withColumns(
        {"component": F.coalesce("component", "id"), "many": F.coalesce("many", F.lit(1))}
    ).select(active.columns)
    left = saved(left, "left")
    spread = left.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    )
    return left.join(spread.where("least <> most").select("key"), "key", "left_semi")
