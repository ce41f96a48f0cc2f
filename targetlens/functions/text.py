"""Text expressions. All are built-in Spark functions; none needs a Python worker."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from targetlens import fixed_values as fixed


def sanitize_name(name: str) -> str:
    """Export key for a column name."""
    return re.sub(fixed.KEY_BREAKS, "_", name.lower()).strip("_")


def sanitize_text(text: Column) -> Column:
    """The export-key rule applied to values."""
    return F.btrim(F.regexp_replace(F.lower(text), f"(?U){fixed.KEY_BREAKS}", "_"), F.lit("_"))


def keyword_match(text: Column, keyword: str) -> Column:
    """True where the pattern occurs in any letter case; a missing text does not match."""
    return F.coalesce(text.rlike(f"(?iu){keyword}"), F.lit(False))


def pattern_match(text: Column, pattern: str) -> Column:
    """True where the case-sensitive pattern occurs; a missing text does not match."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True where any of the lower-case words stands in the text, whatever its letter case."""
    lowered = F.lower(text)
    hit = F.lit(False)
    for word in words:
        hit = hit | lowered.contains(word)
    return F.coalesce(hit, F.lit(False))


def has_text(text: Column) -> Column:
    """True where the cell holds something other than white space."""
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def cell_tokens(cell: Column, separators: str = fixed.CELL_SEPARATORS) -> Column:
    """The values of a cell that may hold several."""
    return F.split(cell.cast("string"), separators)


def has_token(
    cell: Column, wanted: Sequence[str], separators: str = fixed.CELL_SEPARATORS
) -> Column:
    """True where one whole token of the cell is among ``wanted``."""
    allowed = F.array(*[F.lit(value) for value in wanted]).cast("array<string>")
    return F.coalesce(F.arrays_overlap(cell_tokens(cell, separators), allowed), F.lit(False))


def missing_as_text(value: Column) -> Column:
    """The value as text, ``NaN`` where it is missing."""
    return F.coalesce(value.cast("string"), F.lit(fixed.MISSING_TEXT))


def number_text(number: Column) -> Column:
    """The number in plain digits wherever it has at most four leading decimal zeros or
    sixteen whole digits; Spark's own text turns to exponents sooner."""
    digits = number.cast("decimal(38,21)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", ".0")
    size = F.abs(number)
    small, large = (size >= 1e-4) & (size < 1e-3), (size >= 1e7) & (size < 1e16)
    return F.when(small | large, plain).otherwise(number.cast("string"))


def species_slug(
    genome_name: Column, project_prefixes: Sequence[str] = fixed.PROJECT_PREFIXES
) -> Column:
    """``Genus species (PRJNA1)`` -> ``Genus_species_prjna1``; null for any other shape."""
    projects = "|".join(re.escape(prefix) for prefix in project_prefixes)
    shape = rf"(?U)^\s*(.+?)\s*\(((?:{projects})\d+)\)"
    species = F.regexp_extract(genome_name, shape, 1)
    project = F.regexp_extract(genome_name, shape, 2)
    joined = F.replace(F.trim(species), F.lit(" "), F.lit("_"))
    slug = F.concat(joined, F.lit("_"), F.lower(project))
    return F.when(project != "", slug)


def gene_uri(
    genome_name: Column,
    gene_id: Column,
    base_url: str = fixed.GENE_PAGE_BASE,
    project_prefixes: Sequence[str] = fixed.PROJECT_PREFIXES,
    missing_slug: str | None = None,
) -> Column:
    """Address of the gene page.

    A genome name without a slug gives null, or the text ``missing_slug`` in the slug's place.
    """
    slug = species_slug(genome_name, project_prefixes)
    if missing_slug is not None:
        slug = F.when(genome_name.isNotNull(), F.coalesce(slug, F.lit(missing_slug)))
    return F.concat(F.lit(f"{base_url}/"), slug, F.lit("/Gene/Summary?g="), gene_id)
