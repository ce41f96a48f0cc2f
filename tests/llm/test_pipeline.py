"""The pipeline's stages on planted rows, and the registered queries against their SQL."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import SMOKE_DIR, queries
from check import _ordered, open_tables
from targetlens.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    frame = QUERIES[name](spark, SMOKE_DIR)
    answer = open_tables(SMOKE_DIR).execute(ORACLES[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == sorted(frame.columns)
    rows = [tuple(r) for r in frame.collect()]
    assert _ordered(frame.columns, rows) == _ordered(names, answer.fetchall())


def test_all_are_registered():
    wanted = {*QUERIES, "pipeline"}
    assert wanted <= set(queries()) and len(QUERIES) == 13


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The smallest documents with planted rows, as a folder of tables."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    benchmark = spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet")
    passage = " ".join(r.text for r in benchmark.limit(3).collect())
    clean = " ".join(f"the {i}x of and to" for i in range(200))
    rows = [
        (10_001, clean, "en", "s", 1), (10_002, clean + " more", "en", "s", 1),
        (10_003, passage, "en", "s", 1), (10_004, "12 34 !", "en", "s", 1), (10_005, None, "en", "s", 1),
        (10_006, "the of and in to the password = 'hunter2hunter2' that is on it", "en", "s", 1),
    ]
    docs.union(spark.createDataFrame(rows, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    names, kept = docs.columns, {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, planted).write.parquet(f"{planted}/stage{number}")
        docs = spark.read.parquet(f"{planted}/stage{number}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == names
        if name == "secret_scan":
            text = docs.where("doc_id = 10006").first()
            assert "hunter2" not in text.text and text.n_chars == len(text.text)
    before = {r.doc_id for r in spark.read.parquet(f"{planted}/documents.parquet").collect()}
    assert before - kept["language_id"] == {10_004, 10_005}
    assert 10_002 in kept["language_id"] - kept["near_dedup"] and 10_001 in kept["near_dedup"]
    assert 10_003 in kept["near_dedup"] - kept["decontamination"]
    assert kept["decontamination"] == kept["secret_scan"] == kept["packing"]


def test_run_gives_every_kept_document_whole(spark, planted):
    rows = corpus_pipeline.run(spark, planted)
    whole = rows.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("d"))
    assert whole.count() > 100 and whole.where("n <> d").count() == 0


def test_near_dedup_decides_by_row(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    texts = {name: " ".join(f"{name}{i}" for i in range(60)) for name in "abcdefgh"}
    near = {name: text + " end" for name, text in texts.items()}
    rows = [
        # A repeated id: one text copies a smaller id, another is clean and unique.
        (1, texts["a"], "x"), (5, texts["a"], "x"), (5, texts["b"], "x"),
        # Its texts resemble those of two ids that have nothing in common.
        (6, texts["c"], "x"), (7, near["c"], "x"), (7, near["d"], "x"), (8, texts["d"], "x"),
        # Rows repeated whole, alone and with a near copy; rows that differ in another column.
        (20, texts["e"], "x"), (20, texts["e"], "x"), (20, texts["e"], "x"), (21, near["e"], "x"),
        (30, texts["f"], "z"), (30, texts["f"], "y"), (31, texts["g"], "x"), (31, texts["g"], "x"),
        # One id with two spellings of one set of words, and with two near copies.
        (40, texts["h"], "x"), (40, texts["h"].upper(), "x"), (40, near["h"], "x"),
        (50, "", "x"), (50, "", "x"), (51, None, "x"), (52, "", "x"),
        (None, texts["a"], "x"), (None, texts["a"], "x"),
    ]
    given = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], docs.schema)
    kept = corpus_pipeline.near_dedup(spark, given, SMOKE_DIR)
    assert kept.columns == docs.columns
    kept = [(row.doc_id, row.text, row.source) for row in kept.collect()]
    last = [row for row in kept if row[0] == 40]
    assert len(last) == 1 and last[0] in rows
    wanted = [
        (1, texts["a"], "x"), (5, texts["b"], "x"), (6, texts["c"], "x"), (7, near["d"], "x"),
        (20, texts["e"], "x"), (30, texts["f"], "y"), (31, texts["g"], "x"), *last,
        (50, "", "x"), (51, None, "x"), (52, "", "x"), (None, texts["a"], "x"),
        (None, texts["a"], "x"),
    ]
    assert sorted(kept, key=repr) == sorted(wanted, key=repr)


def test_near_dedup_without_repeated_rows_or_rows(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), SMOKE_DIR).collect() == []
    twice = docs.limit(50).union(docs.limit(50))
    once = corpus_pipeline.near_dedup(spark, docs.limit(50), SMOKE_DIR).collect()
    found = corpus_pipeline.near_dedup(spark, twice, SMOKE_DIR).collect()
    assert sorted(found) == sorted(once)


CLASHING = ["_key", "_found", "_hits", "_words", "_rules", "_row", "key", "c0", "c7", "a.b", "row", "first"]


@pytest.mark.parametrize("number", range(5))
def test_stages_keep_further_columns_whatever_their_names(spark, planted, number):
    name, stage = corpus_pipeline.STAGES[number]
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    docs = docs.union(docs.where("doc_id = 10001"))
    more = docs.select("*", *[F.col("doc_id").alias(column) for column in CLASHING])
    plain, wide = stage(spark, docs, planted), stage(spark, more, planted)
    if name != "packing":
        assert wide.columns == [*docs.columns, *CLASHING]
        assert wide.where(F.col("`a.b`") != F.col("doc_id")).isEmpty()
        wide = wide.select(docs.columns)
    assert sorted(map(tuple, wide.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
