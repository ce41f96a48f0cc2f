"""One row per gene, described by its principal transcript."""

from __future__ import annotations

from pyspark.sql import DataFrame

from targetlens import fixed_values as fixed
from targetlens.functions.flags import quoted
from targetlens.operators.joins import left_join
from targetlens.operators.reduce import max_per_key, top_row


def principal_transcripts(
    transcripts: DataFrame,
    cds: DataFrame,
    gene: str = fixed.GENE,
    transcript: str = fixed.TRANSCRIPT,
    cds_end: str = fixed.CDS_END,
) -> DataFrame:
    """Per gene the transcript with the longest coding sequence; one without any comes last."""
    longest = max_per_key(cds, transcript, cds_end, fixed.CDS_MAX)
    return top_row(left_join(transcripts, longest, transcript), gene, fixed.CDS_MAX)


def in_gene_order(
    genes: DataFrame, genome: str = fixed.GENOME, gene: str = fixed.GENE
) -> DataFrame:
    """O2: sorted by genome, then gene."""
    return genes.orderBy(quoted(genome).asc_nulls_first(), quoted(gene).asc_nulls_first())


def gene_list(
    transcripts: DataFrame,
    cds: DataFrame,
    genome: str = fixed.GENOME,
    gene: str = fixed.GENE,
    transcript: str = fixed.TRANSCRIPT,
    cds_end: str = fixed.CDS_END,
) -> DataFrame:
    """:func:`principal_transcripts` sorted by genome and gene."""
    chosen = principal_transcripts(transcripts, cds, gene, transcript, cds_end)
    return in_gene_order(chosen, genome, gene)
