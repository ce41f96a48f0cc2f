"""Every registered query against its SQL, over the whole smallest tables."""

import json
import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from catalog import ORACLES, QUERIES, files
from check import differences, open_tables


@pytest.fixture(scope="module")
def database():
    return open_tables(SMOKE_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    count, problems = differences(spark, database, name, SMOKE_DIR)
    assert not problems
    assert count


def test_entry(spark):
    table = entry(spark)
    assert table.columns[0] == "Gene stable ID" and len(table.columns) == 20
    assert table.count() == table.select("Gene stable ID").distinct().count() > 0


HARD = [
    "principal_isoform", "ontology_criterion", "family_criteria_table", "conserved_value",
    "evidence_rows", "full_target_table", "manual_table", "human_orthologue", "criteria_fold",
]


@pytest.mark.parametrize("name", HARD)
def test_query_when_nothing_is_broadcast_and_keys_are_hot(
    spark, database, name, no_broadcast, every_key_hot
):
    count, problems = differences(spark, database, name, SMOKE_DIR)
    assert not problems and count


GATHERED = ["ontology_criterion", "annotation_regex", "family_criteria_table", "string_join_repeats"]


@pytest.mark.parametrize("name", GATHERED)
def test_query_when_texts_are_put_together_from_runs(
    spark, database, name, every_key_hot, monkeypatch
):
    monkeypatch.setattr("targetlens.operators.reduce.SMALLEST_HOT_BYTES", 0)
    count, problems = differences(spark, database, name, SMOKE_DIR)
    assert not problems and count


def test_family_flags_have_both_values(spark):
    flags = queries()["family_flags"](spark, SMOKE_DIR)
    names = flags.columns[1:]
    assert len(names) == 5
    for name in names:
        assert {row[0] for row in flags.select(name).distinct().collect()} == {True, False}
    plan = flags._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_hot_key_join_is_split(spark):
    plan = queries()["hot_key_join"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan()
    assert "_spread" in plan.toString()


def test_each_task_writes_a_json_array_of_its_own(spark, tmp_path, monkeypatch):
    orders = files.table(spark, SMOKE_DIR, "orders")
    monkeypatch.setattr(files, "table", lambda *_: orders.repartition(5))
    monkeypatch.setattr(files, "fresh_path", lambda *_: str(tmp_path / "array"))
    found = files.scan_roundtrip_json_array_split(spark, SMOKE_DIR)
    arrays = [json.loads(p.read_text()) for p in (tmp_path / "array").glob("part-*")]
    assert len(arrays) == 5 and all(arrays)
    written = [tuple(record.values()) for array in arrays for record in array]
    assert sorted(written, key=repr) == sorted(map(tuple, found.collect()), key=repr)
    assert len(written) == orders.count()


def test_a_task_without_records_writes_an_empty_json_array(spark, tmp_path, monkeypatch):
    # The file's one row group lies in one of its splits; Spark lets the first task write always.
    files.table(spark, SMOKE_DIR, "orders").coalesce(1).write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    monkeypatch.setattr(files, "table", lambda *_: orders)
    monkeypatch.setattr(files, "fresh_path", lambda *_: str(tmp_path / "array"))
    size = sum(p.stat().st_size for p in (tmp_path / "orders").glob("part-*"))
    settings = {"maxPartitionBytes": str(size // 5), "openCostInBytes": "0"}
    before = {name: spark.conf.get(f"spark.sql.files.{name}") for name in settings}
    for name, value in settings.items():
        spark.conf.set(f"spark.sql.files.{name}", value)
    try:
        found = files.scan_roundtrip_json_array_split(spark, SMOKE_DIR)
        assert found.count() == orders.count()
    finally:
        for name, value in before.items():
            spark.conf.set(f"spark.sql.files.{name}", value)
    arrays = [json.loads(p.read_text()) for p in (tmp_path / "array").glob("part-*")]
    assert [] in arrays and sum(map(len, arrays)) == orders.count()
    # The empty array does not hide that records begin lines: nothing is shuffled.
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_an_empty_table_is_an_empty_json_array(spark, tmp_path, monkeypatch):
    none = files.table(spark, SMOKE_DIR, "orders").where("o_orderkey < 0")
    none.write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    monkeypatch.setattr(files, "table", lambda *_: orders)
    monkeypatch.setattr(files, "fresh_path", lambda *_: str(tmp_path / "array"))
    assert files.scan_roundtrip_json_array_split(spark, SMOKE_DIR).count() == 0


def test_json_array_lines_need_no_module_of_this_repository_in_the_tasks():
    code = cloudpickle.dumps(files._array_lines())
    program = "import sys; from pyspark import cloudpickle; cloudpickle.load(sys.stdin.buffer)"
    known = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", program], input=code, env=known, cwd="/", check=True)
