"""Criteria over stacked export files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from targetlens import fixed_values as fixed
from targetlens.operators.criteria import assigned_lenient, conserved_value, token_match
from targetlens.operators.filters import required_columns
from targetlens.operators.reduce import keep_first
from targetlens.operators.shape import with_row_id
from targetlens.sinks.tables import clean_records, write_array_chunks, write_clean_json
from targetlens.sources.delimited import ORDER_COLUMNS, read_stacked
from targetlens.sources.schemas import WIDE_EXPORT


def manual_table(
    stacked: DataFrame,
    gene: str = fixed.GENE,
    order: Sequence[str] = tuple(ORDER_COLUMNS),
    required: Sequence[str] = (fixed.GENOME, "Gene biotype"),
    assigned: Mapping[str, Sequence[str]] = fixed.ASSIGNED_CRITERIA,
    token_flag: str = "linked_to_larval_development",
    token_columns: Sequence[str] = ("GO term accession",),
    tokens: Sequence[str] = tuple(fixed.LARVAL_TERMS),
    identity: str = fixed.IDENTITY,
    genome: str = fixed.GENOME,
    genomes: Sequence[str] = tuple(fixed.COMPARED_GENOMES),
    threshold: int = 2,
    keep_order: bool = False,
) -> DataFrame:
    """First row per gene with an id, then the "assigned", token and conserved-value criteria.

    Only rows with all ``required`` columns take part. The ``order`` columns go unless
    ``keep_order``. Export with ``clean_records(..., keep_id=True, with_uri=True)``.
    """
    rows = keep_first(stacked, gene, order)
    rows = with_row_id(rows, [gene] if gene in rows.columns else rows.columns)
    rows = rows if keep_order else rows.drop(*order)
    rows = required_columns(rows, required)
    for flag, columns in assigned.items():
        rows = assigned_lenient(rows, columns, flag, null_is_true=False)
    rows = token_match(rows, token_columns, token_flag, tokens)
    return conserved_value(rows, identity, genome, genomes, threshold)


def write_manual_table(
    spark: SparkSession,
    paths: Sequence[str],
    out: str,
    chunk_size: int | None = None,
    **options,
) -> None:
    """The criteria over the tab-separated files at ``paths``, with id and gene page address.

    Clean JSON lines, or with ``chunk_size`` JSON array files of that many records, in the order
    of the files.
    """
    stacked = read_stacked(spark, paths, WIDE_EXPORT)
    if chunk_size is None:
        flagged = manual_table(stacked, **options)
        write_clean_json(flagged, out, keep_id=True, with_uri=True)
        return
    flagged = manual_table(stacked, keep_order=True, **options)
    records = clean_records(flagged, keep_id=True, with_uri=True, typed=True, carry=ORDER_COLUMNS)
    write_array_chunks(records, out, ORDER_COLUMNS, chunk_size, leave_out=ORDER_COLUMNS)
