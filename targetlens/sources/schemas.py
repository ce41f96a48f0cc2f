"""Declared columns of the annotation tables, as far as their headers are fixed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

from targetlens import fixed_values as fixed


def _table(texts: list[str], numbers: Mapping[str, T.DataType] | None = None) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in texts]
    fields += [T.StructField(name, kind) for name, kind in (numbers or {}).items()]
    return T.StructType(fields)


GENE_TRANSCRIPT = _table([fixed.GENOME, fixed.GENE, fixed.TRANSCRIPT, fixed.GENE_DESCRIPTION])
TRANSCRIPT_CDS = _table(
    [fixed.GENOME, fixed.GENE, fixed.TRANSCRIPT], {fixed.CDS_END: T.LongType()}
)
HUMAN_ORTHOLOGUE = _table(
    [fixed.GENE, fixed.HUMAN_GENE, fixed.HUMAN_GENE_NAME], {fixed.IDENTITY: T.DoubleType()}
)
DOMAIN_ANNOTATION = _table([fixed.GENE, fixed.DOMAIN, fixed.DOMAIN_DESCRIPTION])
WIDE_EXPORT = _table(
    [
        fixed.GENE, fixed.GENOME, "Gene biotype", "Human protein stable ID", fixed.DOMAIN,
        "GO term accession", "GO term name", "GO term evidence code", "Paralogue gene stable ID",
    ],
    {fixed.IDENTITY: T.DoubleType()},
)
PHENOTYPE_EXTRACT = _table(
    [
        "Biotype", "WormPep", "Protein Domain", "UniProt", "Gene Ontology Association",
        "RNAi Phenotype Observed",
    ]
)


def column_types(schema: T.StructType | Mapping[str, str] | None) -> dict[str, str]:
    """Type names of the columns that are not text."""
    if schema is None or not isinstance(schema, T.StructType):
        return dict(schema or {})
    return {
        field.name: field.dataType.simpleString()
        for field in schema.fields
        if not isinstance(field.dataType, T.StringType)
    }
