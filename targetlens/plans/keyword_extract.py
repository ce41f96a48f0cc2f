"""C14: classified rows whose phenotype text holds a keyword."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from targetlens.operators.criteria import protein_or_enzyme
from targetlens.operators.filters import keyword_filter
from targetlens.sinks.tables import write_json
from targetlens.sources.delimited import read_delimited
from targetlens.sources.schemas import PHENOTYPE_EXTRACT


def keyword_extract(
    rows: DataFrame,
    keyword: str = "lethal",
    column: str = "RNAi Phenotype Observed",
    **classifier_columns: str,
) -> DataFrame:
    """Rows with the keyword, each with ``Is_Protein`` and ``Is_Enzyme``."""
    return protein_or_enzyme(keyword_filter(rows, column, keyword), **classifier_columns)


def write_keyword_extract(
    spark: SparkSession, path: str, out: str, keyword: str = "lethal"
) -> None:
    """The keyword rows of a tab-separated phenotype file, as JSON lines."""
    write_json(keyword_extract(read_delimited(spark, path, PHENOTYPE_EXTRACT), keyword), out)
