"""Intermediate tables in the shared folder, so that a lost executor costs a re-read only."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_own_folder: ContextVar[str | None] = ContextVar("own_folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the caller set, else the one of ``spark.checkpoint.dir``.

    One of our own only in local mode where neither is set.
    """
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    folder = _own_folder.get() or f"{shared_folder(spark)}/targetlens"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written inside are removed at the end, whatever happens.

    Results made from them have to be written or collected inside.
    """
    folder = f"{shared_folder(spark)}/targetlens/run-{uuid.uuid4().hex}"
    token = _own_folder.set(folder)
    try:
        yield folder
    finally:
        _own_folder.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def plan_bytes(df: DataFrame) -> int:
    """The size that Spark's own statistics give to a table, as its planner sees it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_plain_scan(df: DataFrame) -> bool:
    """Whether a table is read from its files with nothing dearer than choosing and naming columns."""
    plan = df._jdf.queryExecution().optimizedPlan()
    same = plan.deterministic()
    while plan.nodeName() == "Project":
        plan = plan.child()
    return same and plan.nodeName().startswith(("LogicalRelation", "Relation"))


@dataclass(frozen=True)
class Written:
    """A table in the shared folder; measured when asked, from what Parquet and Spark know of it."""

    table: DataFrame
    path: str

    @cached_property
    def rows(self) -> int:
        """Read from the files' footers: no column is scanned."""
        return self.table.count()

    @cached_property
    def bytes(self) -> int:
        return plan_bytes(self.table)


def written(df: DataFrame, label: str) -> Written:
    """``df`` as a Parquet table: computed once, lineage cut."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return Written(df.sparkSession.read.schema(df.schema).parquet(path), path)


def bucketed(df: DataFrame, label: str, key: str, buckets: int | None = None) -> Written:
    """``df`` as a Parquet table in buckets of ``key``: rows of a key lie in one file of known number.

    Tables with the same number of buckets (by default the session's shuffle partitions) are joined
    and grouped on their keys without moving rows again. Columns may have any names.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = [f"c{place}" for place in range(len(df.columns))]
    by = plain[df.columns.index(key)]
    name = f"spark_catalog.default.targetlens_{uuid.uuid4().hex}"
    rows = df.toDF(*plain).repartition(buckets, by)
    rows.write.bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(name)
    table = spark.table(name).toDF(*df.columns)
    # The files stay, and what was read of the table's layout is kept with the plan.
    spark.sql(f"DROP TABLE {name}")
    return Written(table, path)


def read_together(parts: list[Written]) -> DataFrame:
    """Written tables of one schema as one scan."""
    first = parts[0].table
    return first.sparkSession.read.schema(first.schema).parquet(*[part.path for part in parts])
