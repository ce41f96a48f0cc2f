import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from targetlens.operators import criteria, filters, joins, reduce
from targetlens.operators.joins import fits_broadcast
from targetlens.storage import bucketed, is_plain_scan, shared_folder, temporary_tables, written


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key, many without a key, some keys without a partner."""
    picks = random.Random(7)
    keys = ["hot"] * 400 + [None] * 300 + [f"k{picks.randrange(60)}" for _ in range(300)]
    left = spark.createDataFrame(list(enumerate(keys)), "row int, k string").repartition(6)
    right = spark.createDataFrame(
        [("hot", 1), *[(f"k{i}", i) for i in range(0, 70, 2)]], "k string, v int"
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(skewed, no_broadcast, how):
    left, right = skewed
    hot = joins.find_hot_keys(left, "k", fewest_rows=20)
    assert {"hot", None} <= {key for key, _ in hot.pieces}
    assert all(pieces > 1 for _, pieces in hot.pieces)
    plain = left.join(right, "k", how)
    spread = joins.spread_join(left, right, "k", hot, how).select(*plain.columns)
    assert sorted(map(repr, spread.collect())) == sorted(map(repr, plain.collect()))


def test_spread_join_repeats_right_rows_with_several_per_key(skewed, no_broadcast):
    left, right = skewed
    doubled = right.unionByName(right.withColumn("v", F.col("v") + 1000))
    hot = joins.find_hot_keys(left, "k", fewest_rows=20)
    plain = left.join(doubled, "k")
    spread = joins.spread_join(left, doubled, "k", hot, "inner").select(*plain.columns)
    assert sorted(map(repr, spread.collect())) == sorted(map(repr, plain.collect()))


def test_hot_rows_are_spread_over_partitions(skewed, no_broadcast):
    left, _ = skewed
    hot = joins.find_hot_keys(left, "k", fewest_rows=20)
    per_key = hot.spread(left).groupBy("k").agg(F.countDistinct("_spread").alias("n"))
    spread = {r["k"]: r["n"] for r in per_key.collect()}
    assert spread["hot"] > 1 and spread[None] > 1


def test_keys_with_awkward_names(spark, no_broadcast):
    key, value = "a.b (c)", "v.w %"
    left = spark.createDataFrame(
        [("x", 1.0), ("x", 2.0), (None, 3.0), ("y", None)], f"`{key}` string, `{value}` double"
    )
    right = spark.createDataFrame([("x", 5)], f"`{key}` string, `q.r` int")
    hot = joins.find_hot_keys(left, key, fewest_rows=1)
    joined = joins.spread_join(left, right, key, hot, "left")
    assert sorted(map(repr, joined.collect())) == sorted(
        map(repr, left.join(right, key, "left").collect())
    )
    assert reduce.top_row(left, key, value).count() == 3
    assert filters.required_columns(left, [key, value]).count() == 2
    shared = criteria.conserved_value(left, value, key, ["x"], 1)
    assert shared.where("has_similar_identity").count() == 2


def test_no_hot_keys_gives_the_plain_join(skewed):
    left, right = skewed
    assert joins.find_hot_keys(left, "k").pieces == ()
    assert joins.left_join(left, right, "k").columns == ["k", "row", "v"]


@pytest.mark.parametrize("kind", ["bigint", "double", "string"])
def test_hot_keys_of_any_type(spark, kind):
    df = spark.range(1000).select(
        F.when(F.col("id") < 400, 7).otherwise(F.col("id")).cast(kind).alias("some key")
    )
    found = dict(joins.find_hot_keys(df, "some key", fewest_rows=100).pieces)
    expected = "7" if kind == "string" else 7
    assert list(found) == [expected]


def test_lookup_join_both_ways(spark, skewed):
    left, right = skewed
    side = written(right, "test")
    assert (side.rows, side.bytes > 0) == (36, True)
    wanted = sorted(map(repr, left.join(right, "k", "left").collect()))
    for limit in ("10m", "1k", "100", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            small = joins.fits_broadcast(side)
            got = joins.lookup_join(left, side, "k")
            assert small == (limit == "10m")
            assert sorted(map(repr, got.collect())) == wanted
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fold_left_shuffles_the_base_once(spark, no_broadcast):
    base = spark.range(100).selectExpr("id AS g")
    sides = [
        spark.range(50).selectExpr(f"id AS g", f"id * {n} AS v{n}").groupBy("g").agg(
            F.max(f"v{n}").alias(f"v{n}")
        )
        for n in (1, 2, 3)
    ]
    folded = joins.fold_left(base, sides, "g")
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4
    assert folded.count() == 100
    assert folded.where("g = 9").first().asDict() == {"g": 9, "v1": 9, "v2": 18, "v3": 27}


def test_bucketed_tables_are_folded_without_moving_rows(spark, no_broadcast):
    base = spark.range(100).selectExpr("id AS `a gene.id`", "id % 7 AS v")
    sides = [
        spark.range(0, 90, n).selectExpr("id AS `a gene.id`", f"id * {n} AS `v {n}`")
        for n in (1, 2, 3)
    ]
    tables = [bucketed(df, "test", "a gene.id", buckets=5) for df in (base, *sides)]
    folded = joins.fold_left(tables[0].table, [t.table for t in tables[1:]], "a gene.id")
    counted = folded.groupBy("`a gene.id`").count()
    for frame in (folded, counted):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    wanted = joins.fold_left(base, sides, "a gene.id")
    assert sorted(map(repr, folded.collect())) == sorted(map(repr, wanted.collect()))
    assert counted.count() == 100 and folded.columns == wanted.columns
    # No more than a file for each bucket, and nothing left in the catalog.
    assert len(list(Path(tables[0].path.removeprefix("file:")).glob("*.parquet"))) <= 5
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("targetlens_")]


def test_bucketed_tables_of_unequal_numbers_or_no_rows(spark, no_broadcast):
    one = bucketed(spark.range(50).selectExpr("id AS g", "id AS a"), "test", "g", buckets=3)
    two = bucketed(spark.range(0).selectExpr("id AS g", "id AS b"), "test", "g", buckets=4)
    found = joins.fold_left(one.table, [two.table], "g").collect()
    assert len(found) == 50 and all(row.b is None for row in found)


def test_written_empty_table(spark):
    side = written(spark.createDataFrame([], "a string, b int"), "test")
    assert side.rows == 0 and fits_broadcast(side)
    assert side.table.columns == ["a", "b"]




class _Session:
    """Stands for a cluster session without a checkpoint folder."""

    def __init__(self, master):
        self.conf = {"spark.master": master}
        self.folder = None
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.sparkContext.getCheckpointDir().rstrip("/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn"))
    local = _Session("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.folder


def test_temporary_tables_are_removed(spark):
    with temporary_tables(spark) as folder:
        side = written(spark.range(5), "kept")
        assert side.path.startswith(folder) and side.table.count() == 5
    assert not os.path.exists(folder.removeprefix("file:"))
    assert not written(spark.range(1), "later").path.startswith(folder)


def test_no_key_scan_where_the_right_side_is_broadcast(spark, skewed, monkeypatch):
    left, right = skewed[0], written(skewed[1], "right").table
    monkeypatch.setattr(joins, "find_hot_keys", lambda *_: pytest.fail("scanned"))
    assert joins.left_join(left, right, "k").count() == left.count()


def test_every_partition_may_have_a_hot_key(spark):
    rows = spark.range(400).selectExpr("id % 4 AS k")
    assert len(joins.find_hot_keys(rows, "k", fewest_rows=1).pieces) <= 4
    spark.conf.set(joins.FEWEST_ROWS_SETTING, "10")
    try:
        skewed = rows.selectExpr("CASE WHEN k < 3 THEN 0 ELSE k END AS k")
        assert [key for key, _ in joins.find_hot_keys(skewed, "k").pieces] == [0]
    finally:
        spark.conf.unset(joins.FEWEST_ROWS_SETTING)


def test_fold_left_refuses_a_side_that_repeats_a_key(spark):
    base = spark.createDataFrame([(1,), (2,)], "g int")
    good = spark.createDataFrame([(1, "a")], "g int, x string")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "g int, y string")
    assert joins.fold_left(base, [good], "g", check=[good]).count() == 2
    with pytest.raises(AssertionError, match="unique g"):
        joins.fold_left(base, [good, twice], "g", check=[twice])


def test_only_tables_that_are_merely_read_are_plain(spark, tmp_path):
    spark.range(9).selectExpr("id", "id % 2 AS v").write.parquet(f"{tmp_path}/t")
    read = spark.read.parquet(f"{tmp_path}/t")
    assert is_plain_scan(read) and is_plain_scan(read.select(F.col("id").alias("x"), "v"))
    for other in (
        read.withColumn("n", F.monotonically_increasing_id()), read.distinct(),
        read.groupBy("v").count(), read.mapInArrow(lambda batches: batches, read.schema),
        read.join(read.select("id"), "id"), read.withColumn("r", F.rand()),
    ):
        assert not is_plain_scan(other)
