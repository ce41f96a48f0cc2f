import itertools

import pytest
from pyspark.sql import functions as F

from targetlens.operators import filters, quality, reduce, shape
from targetlens.operators.chunks import chunk_numbers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_top_row_keeps_whole_row_and_puts_missing_last(spark):
    df = spark.createDataFrame(
        [
            ("g1", "t2", 90, None), ("g1", "t1", 90, "x"), ("g1", "t0", 10, "y"),
            ("g2", "t4", None, "b"), ("g2", "t3", None, "a"), ("g3", "t5", None, "n"),
            ("g3", "t6", 1, None), (None, "t7", 3, "z"),
        ],
        "gene string, transcript string, cds int, note string",
    )
    assert rows(reduce.top_row(df, "gene", "cds")) == rows(
        spark.createDataFrame(
            [
                ("g1", "t1", 90, "x"), ("g2", "t3", None, "a"), ("g3", "t6", 1, None),
                (None, "t7", 3, "z"),
            ],
            df.schema,
        )
    )


def test_top_row_limits_each_task_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS v")
    plan = reduce.top_row(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_argmax_counts_missing_as_zero(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [
            ("g1", "h1", 45.5), ("g1", "h2", 45.5), ("g1", "h0", 3.0), ("g2", None, None),
            ("g3", "h4", nan), ("g3", "h5", -1.0), (None, "h6", 99.0),
        ],
        "gene string, human string, pct double",
    )
    assert rows(reduce.argmax_row(df, "gene", "pct")) == [
        ("g1", "h1", 45.5), ("g2", None, 0.0), ("g3", "h4", 0.0),
    ]
    first_seen = df.withColumn("line", F.when(F.col("human") == "h2", 0).otherwise(1))
    best = reduce.argmax_row(first_seen, "gene", "pct", ["line"]).where("gene = 'g1'")
    assert best.first()["human"] == "h2"


def test_joined_texts_repeat_and_ignore_nulls(spark):
    df = spark.createDataFrame(
        [("a", "y"), ("a", "x"), ("a", "y"), ("a", None), ("b", None), (None, "z"), ("c", "")],
        "k string, v string",
    )
    joined = reduce.joined_texts(df, "k", {"all": F.col("v")})
    assert rows(joined) == [("a", "x, y, y"), ("b", ""), ("c", ""), (None, "z")]
    distinct = reduce.joined_texts(df.distinct(), "k", {"all": F.col("v")}, separator="|")
    assert dict(rows(distinct))["a"] == "x|y"


def test_keep_first(spark):
    df = spark.createDataFrame(
        [
            ("g1", 1, "later"), ("g1", 0, "first"), ("g2", 5, "only"), (None, 3, "n3"),
            (None, 2, "n2"),
        ],
        "gene string, line int, note string",
    )
    kept = reduce.keep_first(df, "gene", ["line"])
    assert rows(kept.select("note")) == [("first",), ("n2",), ("only",)]
    assert reduce.keep_first(df, "Gene", ["line"]) is df
    assert rows(quality.count_removed(df, kept)) == [(5, 3, 2)]


def test_stack_by_name_and_vertical(spark):
    one = spark.createDataFrame([(1, "a")], "x int, y string")
    two = spark.createDataFrame([("b", 2.0)], "y string, z double")
    assert rows(shape.stack_by_name([one, two])) == rows(
        spark.createDataFrame([(1, "a", None), (None, "b", 2.0)], "x int, y string, z double")
    )
    with pytest.raises(Exception, match="z|x"):
        shape.stack_tables([one, two]).collect()


def test_row_id_is_stable_and_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    ids = [r["id"] for r in shape.with_row_id(df, ["x", "y"]).collect()]
    assert len(set(ids)) == 3
    assert ids == [r["id"] for r in shape.with_row_id(df, ["x", "y"]).collect()]


def test_clean_missing(spark):
    df = spark.createDataFrame(
        [("NA", float("nan"), 1), ("null", 2.0, None), ("ok", None, 3)], "s string, d double, i int"
    )
    assert rows(shape.clean_missing(df)) == rows(
        spark.createDataFrame([(None, None, 1), (None, 2.0, None), ("ok", None, 3)], df.schema)
    )


def test_filters(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("b", None), ("c", float("nan")), (None, 5.0), ("e", 3.0)],
        "id string, v double",
    )
    assert rows(filters.null_lookup(df, "v", "id")) == [("b",), ("c",)]
    assert filters.null_lookup(df, "v").columns == ["id", "v"]
    assert rows(filters.threshold_lookup(df, "v", 3, True, ["id"])) == [(None, "v")]
    assert rows(filters.threshold_lookup(df, "v", 3, False, ["id"])) == [("a", "v")]
    with pytest.raises(ValueError, match="nope"):
        filters.threshold_lookup(df, "nope", 3, True, ["id"])
    assert rows(filters.required_columns(df, ["id", "v"])) == [("a", 1.0), ("e", 3.0)]
    assert rows(filters.required_columns(df, ["id", "V"])) == []
    found = filters.keyword_filter(df, "id", "A|E")
    assert rows(found.select("id")) == [("a",), ("e",)]


@pytest.mark.parametrize("count", [0, 3, 4, 8, 9])
def test_chunk_numbers(spark, count):
    ids = list(range(count, 0, -1))
    df = spark.createDataFrame([(i, f"r{i}") for i in ids], "i int, note string").repartition(3)
    got = sorted(tuple(r) for r in chunk_numbers(df, ["i"], 4).collect())
    assert got == [(i, f"r{i}", i - 1, (i - 1) // 4 + 1) for i in range(1, count + 1)]


def test_chunk_numbers_need_a_row_key_and_a_size(spark):
    df = spark.createDataFrame([(1,), (1,)], "i int")
    with pytest.raises(AssertionError, match="unique i"):
        chunk_numbers(df, ["i"], 4)
    with pytest.raises(ValueError):
        chunk_numbers(df, ["i"], 0)


def test_chunk_positions_survive_many_file_pieces(spark):
    setting = "spark.sql.files.maxRecordsPerFile"
    spark.conf.set(setting, "7")
    try:
        df = spark.range(100).selectExpr("99 - id AS i")
        got = {r["i"]: r["position"] for r in chunk_numbers(df, ["i"], 9).collect()}
    finally:
        spark.conf.unset(setting)
    assert got == {i: i for i in range(100)}


def test_quality(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    assert rows(quality.expect_unique(df, "g")) == [("unique g", 1, False)]
    assert rows(quality.expect_min_rows(df, 3)) == [("at least 3 rows", 3, True)]
    assert rows(quality.quality_report(df, "g", 4)) == [
        ("at least 4 rows", 3, False), ("unique g", 1, False),
    ]
    with pytest.raises(AssertionError, match="unique g"):
        quality.require(quality.expect_unique(df, "g"))
    quality.require(quality.expect_unique(df.distinct(), "g"))
    empty = quality.quality_report(df.limit(0), "g", 0)
    assert all(r["passed"] for r in empty.collect())


def test_summary_counts(spark):
    df = spark.createDataFrame(
        [(True, None), (False, True), (True, None)], "a boolean, b boolean"
    )
    assert dict(rows(quality.summary_counts(df, ["a", "b"]))) == {"rows": 3, "a": 2, "b": 1}
    assert dict(rows(quality.summary_counts(df.limit(0), ["a"]))) == {"rows": 0, "a": 0}
    assert quality.count_true(df, "a").first()["count"] == 2


def test_value_map_and_groups(spark):
    pairs = list(itertools.product(["k1", "k2"], ["b", "a", "b"]))
    df = spark.createDataFrame(pairs, "k string, v string")
    assert rows(reduce.value_map(df, "k", "v", "vs")) == [("k1", ["a", "b"]), ("k2", ["a", "b"])]
    groups = reduce.groups_per_value(df, "v", "k", ["k2", "k9"], "ks")
    assert rows(groups) == [("a", ["k2"]), ("b", ["k2"])]


def test_groups_of_a_value_are_bits_until_they_are_listed(spark):
    groups = [f"g{i}" for i in range(150)]
    data = [(v, f"g{i}") for v in range(5) for i in range(160) if i % 5 == v or i % 31 == 0]
    data += data[:40] + [(None, "g1"), (7, None), (8, "elsewhere")]
    df = spark.createDataFrame(data, "v int, `a.g` string").repartition(3)
    found = reduce.groups_per_value(df, "v", "a.g", [*groups, "g1"], "found")
    wanted = {}
    for value, group in data:
        if value is not None and group in groups:
            wanted.setdefault(value, set()).add(group)
    assert {r.v: r.found for r in found.collect()} == {v: sorted(g) for v, g in wanted.items()}
    assert "ObjectHashAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert reduce.groups_per_value(df, "v", "a.g", [], "found").collect() == []


def test_groups_that_are_numbers_stay_numbers(spark):
    df = spark.createDataFrame([("a", 10), ("a", 9), ("b", 3)], "v string, g int")
    found = reduce.groups_per_value(df, "v", "g", [9, 10], "found")
    assert [tuple(r) for r in found.collect()] == [("a", [9, 10])]


def test_value_map_reads_each_pair_of_a_hot_key_once(spark):
    data = [("hot", i % 40) for i in range(4_000)] + [("k", 1), ("k", None), ("none", None)]
    df = spark.createDataFrame(data, "k string, v int").repartition(6)
    found = reduce.value_map(df, "k", "v", "vs")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert {r.k: r.vs for r in found.collect()} == {"hot": list(range(40)), "k": [1], "none": []}


@pytest.fixture
def every_text_hot(every_key_hot, monkeypatch):
    monkeypatch.setattr(reduce, "SMALLEST_HOT_BYTES", 0)


def texts_of(spark):
    data = [("hot", f"t{i * 37 % 900:04}" if i % 50 else None, f"u{i % 3}") for i in range(1_500)]
    data += [("hot", "t0001", "")] * 5 + [(None, "n", "n"), (None, "m", None), ("none", None, None)]
    data += [("k", "", ""), ("k", "", "z"), ("empty", "", None)]
    return data, spark.createDataFrame(data, "k string, t string, u string").repartition(5)


@pytest.mark.parametrize("names", [["t"], ["t", "u"]])
def test_texts_of_hot_keys_are_put_together_from_runs(spark, every_text_hot, names):
    data, df = texts_of(spark)
    found = reduce.joined_texts(df, "k", {name: F.col(name) for name in names}, "; ")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan
    wanted = {}
    for key, *texts in data:
        held = wanted.setdefault(key, [[] for _ in names])
        for place, text in enumerate(texts[: len(names)]):
            if text is not None:
                held[place].append(text)
    wanted = {key: tuple("; ".join(sorted(texts)) for texts in held) for key, held in wanted.items()}
    assert {row.k: tuple(row[name] for name in names) for row in found.collect()} == wanted


def test_a_run_of_a_hot_key_is_a_part_of_its_rows(spark, every_text_hot, monkeypatch):
    _, df = texts_of(spark)
    sizes = []
    deal = type(df).repartitionByRange

    def watched(self, *args):
        out = deal(self, *args)
        sizes.extend(row["count"] for row in out.groupBy(F.spark_partition_id()).count().collect())
        return out

    monkeypatch.setattr(type(df), "repartitionByRange", watched)
    reduce.joined_texts(df, "k", {"t": F.col("t")}).collect()
    assert len(sizes) > 3 and max(sizes) < 0.6 * sum(sizes)


def test_small_tables_are_not_scanned_for_hot_texts(spark, every_key_hot):
    assert reduce.hot_texts(spark.range(9), "id").pieces == ()
