"""A training-data pipeline over ``documents``: language, near duplicates, benchmark, secrets, packing.

Each stage is a function of (spark, docs, sf_dir) and works on all rows that the one before kept. All
but the last give the columns of ``documents``, and further ones that they are given, whatever their
names. The steps between are Parquet tables in the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from targetlens.llm import language
from targetlens.llm.common import plainly_named, saved
from targetlens.llm.decontaminate import without_documents
from targetlens.llm.minhash import near_duplicates
from targetlens.llm.packing import packed
from targetlens.llm.secrets import redacted

LEAST_LANGUAGE_SCORE = 0.5
VOCABULARY = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts without letters, or of doubtful language, go.

    The model learns from the labelled documents of the stage's input.
    """
    found = language.identified(docs, language.fit(docs))
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.where(known).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five words, similarity 0.8): that of the smallest id.

    Rows are decided one by one: texts of one id are compared like those of different ids, and of
    rows with equal id and text one stays, that with the smallest other columns. Rows without id
    are linked with nothing and stay.
    """
    plain, names = plainly_named(docs)
    doc_id, text = names["doc_id"], names["text"]
    # Equal for equal rows only, and in the order of the ids.
    row = F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("text"))
    rows = plain.withColumn("key", F.when(F.col(doc_id).isNotNull(), row))
    found = near_duplicates(rows.select("key", text), id_column="key", text_column=text)
    found = found.where("key is not null").groupBy("key")
    marks = found.agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("times"))
    marks = saved(marks.where("not kept or times > 1"), "marks")
    again = marks.where("kept").select("key")
    single = rows.join(marks.select("key"), "key", "left_anti").select(*names.values())
    if not again.isEmpty():
        others = [name for name in names.values() if name not in (doc_id, text)]
        again = rows.join(again, "key", "left_semi").groupBy(doc_id, text)
        again = again.agg(F.min(F.struct(F.lit(0), *others)).alias("first"))
        single = single.unionByName(again.select(doc_id, text, *[f"first.{n}" for n in others]))
    return single.toDF(*names)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those of which a twentieth or more lies in benchmark passages."""
    return without_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by its kind; ``n_chars`` is that of the new text."""
    clean = redacted(docs)
    return clean.withColumn(
        "n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, with their ids."""
    return packed(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# The language model and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
