"""Exact top-k by integer inner product: tiles of queries times tiles of candidates, the best of each
tile, and a tree that merges them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.llm.common import saved

QUERY_BLOCK = 4_096
TILE = 2_048
FAN_IN = 16
SCALE = 1024
EXACT = float(2**53)


def integer_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id``, ``vector`` (floor of ``SCALE`` times each component, as double) of the usable rows.

    A row takes part when its id is set and its vector is neither null nor empty and holds only
    finite components.
    """
    vector = quoted(vector_column).cast("array<double>")
    scaled = F.transform(vector, lambda x: x * F.lit(float(SCALE)))
    rows = df.select(quoted(id_column).alias("id"), scaled.alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & (F.size("vector") > 0))
    # The rounding is left to the tasks: components may be too large for a long.
    return rows.where(
        F.forall(
            "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
        )
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.reshape(len(column), -1)) if len(column) else np.empty((0, 0))


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and integer vectors of the rows of each vector length."""
    sizes = np.diff(batch["vector"].offsets.to_numpy())
    ids = batch["id"].to_numpy()
    for size in set(sizes.tolist()):
        places = np.flatnonzero(sizes == size)
        yield ids[places], _matrix(batch["vector"].take(pa.array(places)))


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as integers; Python integers where doubles or longs would not be exact."""
    largest = np.abs(queries).max() * np.abs(rows).max() * queries.shape[1]
    if largest < EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(queries).dot(whole(rows).T)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int):
    """For each row of ``scores``, the places of its k best; ties to the smaller id, own id out."""
    for row, query in enumerate(own):
        line = scores[row]
        usable = np.flatnonzero(ids != query)
        if len(usable) > k:
            # Keep all that tie with the k-th, then decide by id.
            bound = np.partition(line[usable], len(usable) - k)[len(usable) - k]
            usable = usable[line[usable] >= bound]
        order = np.lexsort((ids[usable], -line[usable].astype(object)))[:k]
        yield row, usable[order]


def _tile_scan(blocks, k: int, tile: int):
    """Best of every tile of candidates for one block of queries."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, tile):
                out = ([], [], [])
                for ids, rows in _by_size(batch.slice(start, tile)):
                    own, queries = blocks.value.get(rows.shape[1], (None, None))
                    if own is None:
                        continue
                    scores = _scores(queries, rows)
                    for row, places in _best(scores, ids, own, k):
                        out[0].append(np.full(len(places), own[row]))
                        out[1].append(ids[places])
                        out[2].append(scores[row, places])
                flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]
                yield pa.RecordBatch.from_pydict(
                    dict(zip(("query_id", "vec_id", "score"), map(pa.array, flat), strict=True))
                )

    return scan


def _merged(best: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block: int = QUERY_BLOCK,
    tile: int = TILE,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's k highest products.

    ``is_query`` is a condition on ``id``. Queries are taken in blocks of at most about ``block``
    vectors, which every task holds; each block is one pass over the candidates, in tiles of
    ``tile`` rows, and only the k best of a tile leave its task. They are merged in a tree.

    Candidates are all rows of the same vector length but those of the query's own id; ties go to
    the smaller id. Rows with a null id, a null or empty vector, or null or non-finite components
    take no part. Equal rows are candidates each; a query id that is repeated with equal vectors is
    one query, and with different vectors it has the best of all of them. Scores beyond a long are
    cut to it. Fewer than k candidates give all of them; an empty table gives an empty one.
    """
    rows = saved(integer_vectors(df, id_column, vector_column), "vectors")
    queries = rows.where(is_query).distinct()
    number = queries.count()
    blocks = max(1, -(-number // block))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)))
    queries = saved(queries, "queries")
    best = None
    for at in range(blocks):
        some = queries.where(F.col("block") == at).select("id", "vector").toArrow()
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in some.combine_chunks().to_batches():
            held |= {vectors.shape[1]: (ids, vectors) for ids, vectors in _by_size(batch)}
        shared = rows.sparkSession.sparkContext.broadcast(held)
        found = rows.mapInArrow(
            _tile_scan(shared, k, tile), "query_id long, vec_id long, score long"
        )
        found = saved(found, "tiles")
        shared.unpersist()
        best = found if best is None else best.unionAll(found)
    # The tree: groups of tiles first, so that no merge sees all tiles of a large table.
    groups = -(-rows.count() // (tile * FAN_IN))
    while groups > 1:
        best = best.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(groups)))
        best = _merged(best, ["query_id", "part"], k).select("query_id", "vec_id", "score")
        groups //= FAN_IN
    best = _merged(best, ["query_id"], k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
