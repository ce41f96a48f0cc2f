"""Exact top-k against all products, in one block and in many."""

import math
import random

import pytest
from pyspark.sql import functions as F

from targetlens.llm.topk import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, score string"


def usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector)


def brute_force(rows, k, step):
    vectors = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows if i is not None and usable(v)]
    found = []
    queries = {(i, tuple(v)) for i, v in vectors if i % step == 0}
    for query in {i for i, _ in queries}:
        scores = [
            (-sum(a * b for a, b in zip(v, w)), j)
            for i, v in queries if i == query
            for j, w in vectors if j != query and len(v) == len(w)
        ]
        found += [(query, r, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def cases():
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], "x") for i in range(120)]
    rows = [(i, [float(f"{x:.3f}") for x in v], s) for i, v, s in rows]
    import numpy as np

    rows = [(i, [float(np.float32(x)) for x in v], s) for i, v, s in rows]
    same = rows[7][1]
    rows += [(200 + i, same, "x") for i in range(40)] + [(7, same, "x"), (20, rows[20][1], "x")]
    rows += [(300, None, "x"), (310, [], "x"), (320, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x")]
    rows += [(330, [float("nan")] * 6, "x"), (340, [float("inf")] * 6, "x"), (None, same, "x")]
    return rows + [(350, [1.0, 2.0], "x"), (351, [-1.0, 0.5], "x"), (352, [0.5, 0.5], "x")]


@pytest.mark.parametrize(("block", "tile"), [(4_096, 2_048), (3, 2)])
def test_agrees_with_all_products(spark, block, tile):
    df = spark.createDataFrame(cases(), SCHEMA)
    rows = exact_top_k(df, F.col("id") % 10 == 0, k=5, block=block, tile=tile).collect()
    assert sorted(map(tuple, rows)) == brute_force(cases(), 5, 10)


def test_large_components_stay_exact(spark):
    rows = [(0, [1e6, 3.0, 1e6]), (1, [1e6, 1.0, -1e6]), (2, [1e6 + 1, 1.0, -1e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = exact_top_k(df, F.col("id") == 0).collect()
    assert [(r.vec_id, r.score) for r in found] == [
        (2, 1024**2 * (1_000_000 + 3)), (1, 1024**2 * 3),
    ]


def test_fewer_rows_than_k_and_none(spark):
    df = spark.createDataFrame([(0, [1.0], "x"), (1, [2.0], "x")], SCHEMA)
    assert [tuple(r) for r in exact_top_k(df, F.col("id") == 0).collect()] == [(0, 1, 1, 2 * 1024**2)]
    assert exact_top_k(df.where("false"), F.col("id") == 0).collect() == []
    assert exact_top_k(df, F.col("id") == 9).collect() == []
