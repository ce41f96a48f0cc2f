"""Ontology stanzas and domain-to-term mapping lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from targetlens import fixed_values as fixed
from targetlens.operators.joins import left_join
from targetlens.sources import pieces


def read_stanzas(spark: SparkSession, path: str) -> DataFrame:
    """OBO text, one stanza per row in ``value``, from its line in brackets to the next or a blank.

    Files are read line by line whatever their line ends, and split; the lines of a stanza are put
    together again, also where it lies in two blocks.
    """
    lines = pieces.scan(spark, path, "\n")
    line = F.regexp_replace("value", r"\s+$", "")
    begins = F.col("value").rlike(r"^\s*\[") | (F.col("value") == "")
    lines = lines.withColumn("value", line).withColumn("_starts", begins)
    # Whether a block's last stanza goes on is seen from the next block's lines alone.
    found = pieces.assembled(lines.withColumn("_leaves", F.lit(True)), "\n", [])
    return found.select("value").where(F.col("value") != "")


def _live_terms(stanzas: DataFrame) -> DataFrame:
    term = F.col("value")
    return stanzas.where(
        term.rlike(r"^\s*\[Term\]") & ~term.rlike(r"(?m)^is_obsolete:\s*true")
    ).withColumn("go_id", F.regexp_extract("value", r"(?m)^id:\s*(\S+)", 1))


def ontology_terms(stanzas: DataFrame) -> DataFrame:
    """``(go_id, name)`` of the terms that are not obsolete."""
    name = F.regexp_extract("value", r"(?m)^name:[ \t]*([^\r\n]*)", 1)
    return _live_terms(stanzas).select("go_id", name.alias("name"))


def ontology_alternates(stanzas: DataFrame) -> DataFrame:
    """``(alt_id, go_id)``: other ids a term is known by."""
    others = F.regexp_extract_all("value", F.lit(r"(?m)^alt_id:\s*(\S+)"), 1)
    return _live_terms(stanzas).select(F.explode(others).alias("alt_id"), "go_id")


def ontology_edges(stanzas: DataFrame) -> DataFrame:
    """``(child, parent)`` of the is-a lines; a parent named by another id is made primary."""
    parents = F.regexp_extract_all("value", F.lit(r"(?m)^is_a:\s*(\S+)"), 1)
    edges = _live_terms(stanzas).select(
        F.col("go_id").alias("child"), F.explode(parents).alias("alt_id")
    )
    return left_join(edges, ontology_alternates(stanzas), "alt_id").select(
        "child", F.coalesce("go_id", "alt_id").alias("parent")
    )


def read_mapping_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a domain-to-term mapping file, in ``value``."""
    return spark.read.text(path)


def domain_terms(lines: DataFrame, domain: str = fixed.DOMAIN) -> DataFrame:
    """Distinct ``(domain, go_id)`` of the mapping lines.

    A line counts when it starts as a mapping, has exactly one ``>``, and names a domain before
    it and terms behind it.
    """
    halves = F.split("value", ">")
    found = lines.where(
        F.col("value").startswith(fixed.MAPPING_LINE_START) & (F.size(halves) == 2)
    ).select(
        F.regexp_extract(halves[0], fixed.MAPPING_DOMAIN, 1).alias(domain),
        F.explode(F.regexp_extract_all(halves[1], F.lit(fixed.MAPPING_TERM), 0)).alias("go_id"),
    )
    return found.where(F.col(f"`{domain}`") != "").distinct()
