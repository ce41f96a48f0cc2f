"""The criteria: a flag per row or gene, with its evidence text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens import fixed_values as fixed
from targetlens.functions.flags import (
    any_missing,
    any_true,
    has_column,
    is_missing,
    quoted,
    true_names,
)
from targetlens.functions.text import (
    contains_any,
    has_text,
    has_token,
    number_text,
    pattern_match,
)
from targetlens.operators.joins import fits_broadcast, lookup_join
from targetlens.operators.reduce import (
    COPIES,
    argmax_row,
    gathered_texts,
    groups_per_value,
    hot_texts,
    sum_copies,
)
from targetlens.storage import written

_ANNOTATION = "_annotation"


def assigned_strict(
    df: DataFrame, columns: Sequence[str], name: str, null_is_true: bool
) -> DataFrame:
    """Whether the columns are filled, judged by those that exist.

    A row with a gap gets ``null_is_true``, any other its opposite. As soon as one listed column
    does not exist, ``null_is_true`` is taken to be true.
    """
    present = [column for column in columns if has_column(df, column)]
    on_gap = null_is_true or len(present) < len(columns)
    return df.withColumn(name, any_missing(df, present) == F.lit(on_gap))


def assigned_lenient(
    df: DataFrame, columns: Sequence[str], name: str, null_is_true: bool
) -> DataFrame:
    """As C1, absent columns being ignored; no flag at all when none exists."""
    present = [column for column in columns if has_column(df, column)]
    if not present:
        return df
    return df.withColumn(name, any_missing(df, present) == F.lit(null_is_true))


def token_match(
    df: DataFrame,
    columns: Sequence[str],
    name: str,
    wanted: Sequence[str],
    separators: str = fixed.CELL_SEPARATORS,
) -> DataFrame:
    """Whether a cell of the columns holds one of the wanted tokens, compared whole."""
    present = [column for column in columns if has_column(df, column)]
    if not present:
        return df
    hit = F.lit(False)
    for column in present:
        hit = hit | (~is_missing(df, column) & has_token(quoted(column), wanted, separators))
    return df.withColumn(name, hit)


def conserved_value(
    df: DataFrame,
    value: str,
    genome: str,
    genomes: Sequence[str],
    threshold: int,
    flag: str = "has_similar_identity",
    found_in: str = "similar_identity_species",
) -> DataFrame:
    """C4: flag every row whose exact value occurs in at least ``threshold`` of ``genomes``.

    Rows of other genomes are flagged too; rows lacking a value or a genome never are. When the
    value or genome column is absent, no row is flagged.
    """
    if threshold < 1:
        raise ValueError("threshold must be at least 1")
    nowhere = F.lit(None).cast("array<string>")
    if not (has_column(df, value) and has_column(df, genome)):
        return df.withColumn(flag, F.lit(False)).withColumn(found_in, nowhere)
    shared = groups_per_value(df, value, genome, genomes, found_in).where(
        F.size(quoted(found_in)) >= threshold
    )
    joined = lookup_join(df, written(shared, "shared"), value)
    listed = F.when(~is_missing(df, genome), quoted(found_in))
    return joined.select(
        *[quoted(name) for name in df.columns],
        listed.isNotNull().alias(flag),
        listed.alias(found_in),
    )


def protein_or_enzyme(
    df: DataFrame,
    biotype: str = "Biotype",
    protein_id: str = "WormPep",
    protein_entry: str = "UniProt",
    domain: str = "Protein Domain",
    terms: str = "Gene Ontology Association",
    domain_words: Sequence[str] = tuple(fixed.ENZYME_DOMAIN_WORDS),
    term_words: Sequence[str] = tuple(fixed.ENZYME_TERM_WORDS),
) -> DataFrame:
    """``Is_Protein`` from biotype or protein ids, ``Is_Enzyme`` from domain or term words."""
    is_protein = (
        contains_any(quoted(biotype), [fixed.PROTEIN_BIOTYPE])
        | has_text(quoted(protein_id))
        | has_text(quoted(protein_entry))
    )
    is_enzyme = contains_any(quoted(domain), domain_words) | contains_any(
        quoted(terms), term_words
    )
    return df.withColumns({"Is_Protein": is_protein, "Is_Enzyme": is_enzyme})


def human_orthologue(
    df: DataFrame,
    gene: str = fixed.GENE,
    human_gene: str = fixed.HUMAN_GENE,
    human_name: str = fixed.HUMAN_GENE_NAME,
    identity: str = fixed.IDENTITY,
    limit: float = fixed.IDENTITY_LIMIT,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The most similar human orthologue per gene, whether there is none, and whether its
    identity is below ``limit``. A null human name leaves the evidence null."""
    best = argmax_row(df, gene, identity, tie_breakers)
    name, percent = quoted(human_name), quoted(identity)
    lacks, low = quoted(human_gene).isNull(), percent < F.lit(limit)
    shown = F.concat(name, F.lit(" "), number_text(percent), F.lit("%"))
    found = F.concat(F.lit(fixed.HAS_ORTHOLOGUE_TEXT), name)
    ranked = F.concat(
        F.when(low, F.lit(fixed.BELOW_LIMIT_TEXT)).otherwise(F.lit(fixed.ABOVE_LIMIT_TEXT)), shown
    )
    none = F.lit(fixed.NO_ORTHOLOGUE_TEXT)
    return best.select(
        "*",
        lacks.alias(fixed.LACKS_ORTHOLOGUE),
        F.when(lacks, none).otherwise(found).alias(f"{fixed.LACKS_ORTHOLOGUE}_evidence"),
        low.alias(fixed.LOW_IDENTITY),
        F.when(lacks, none).otherwise(ranked).alias(f"{fixed.LOW_IDENTITY}_evidence"),
    )


def domain_flags(
    domain_terms: DataFrame, below: DataFrame, roots: dict[str, str], domain: str
) -> DataFrame:
    """Per domain with a matching term, one flag for each named root.

    ``domain_terms`` holds ``(domain, go_id)``, ``below`` the ``(root, term)`` pairs.
    """
    term_flags = below.groupBy(F.col("term").alias("go_id")).agg(
        *[F.bool_or(F.col("root") == F.lit(root)).alias(name) for name, root in roots.items()]
    )
    pairs = domain_terms.select(quoted(domain), "go_id")
    return (
        lookup_join(pairs, written(term_flags, "terms"), "go_id", "inner")
        .groupBy(quoted(domain))
        .agg(*[F.bool_or(quoted(name)).alias(name) for name in roots])
    )


def _flag_and_evidence(name: str, match: Column, no_match: Column) -> list[Column]:
    found = quoted(name) != ""
    evidence = F.when(found, F.concat(match, quoted(name))).otherwise(no_match)
    return [evidence.alias(f"{name}_evidence"), found.alias(name)]


def _matched_rows(
    annotations: DataFrame,
    roots: dict[str, str],
    patterns: dict[str, str],
    domain_terms: DataFrame | None,
    below: DataFrame | None,
    names: tuple[str, str, str],
) -> DataFrame:
    """Distinct annotation rows with ``_copies``, the annotation text, and a flag per criterion.

    Rows that meet no criterion shrink to their gene before the shuffle.
    """
    gene, domain, description = names
    rows = annotations.select(*[quoted(name) for name in names], F.lit(1).alias(COPIES))
    if roots:
        flags = written(domain_flags(domain_terms, below, roots, domain), "domains")
        if not fits_broadcast(flags):
            rows = sum_copies(rows, names)
        rows = lookup_join(rows, flags, domain, keys=annotations)
    rows = rows.withColumn(
        _ANNOTATION, F.concat(quoted(domain), F.lit(" - "), quoted(description))
    )
    annotation = quoted(_ANNOTATION)
    tests = {
        name: annotation.isNotNull() & F.coalesce(quoted(name), F.lit(False)) for name in roots
    }
    tests |= {name: pattern_match(annotation, pattern) for name, pattern in patterns.items()}
    rows = rows.withColumns(tests)
    met = any_true(list(tests))
    kept = rows.select(
        quoted(gene),
        *[F.when(met, quoted(name)).alias(name) for name in (domain, description)],
        *[quoted(name) for name in tests],
        COPIES,
    )
    return sum_copies(kept, [gene, domain, description, *tests]).withColumn(
        _ANNOTATION, F.concat(quoted(domain), F.lit(" - "), quoted(description))
    )


def evidence_rows(
    annotations: DataFrame,
    roots: dict[str, str] | None = None,
    patterns: dict[str, str] | None = None,
    domain_terms: DataFrame | None = None,
    below: DataFrame | None = None,
    gene: str = fixed.GENE,
    domain: str = fixed.DOMAIN,
    description: str = fixed.DOMAIN_DESCRIPTION,
) -> DataFrame:
    """The matches behind :func:`domain_criteria`, one row each: gene, criterion, annotation and
    number of copies. Unlike a joined text, no gene is ever gathered in one place."""
    roots, patterns = roots or {}, patterns or {}
    matched = _matched_rows(
        annotations, roots, patterns, domain_terms, below, (gene, domain, description)
    )
    met = F.array(*[F.when(quoted(name), F.lit(name)) for name in [*roots, *patterns]])
    return matched.select(
        quoted(gene),
        F.explode(F.array_compact(met)).alias("criterion"),
        quoted(_ANNOTATION).alias("annotation"),
        quoted(COPIES).alias("copies"),
    )


def domain_criteria(
    annotations: DataFrame,
    roots: dict[str, str] | None = None,
    patterns: dict[str, str] | None = None,
    domain_terms: DataFrame | None = None,
    below: DataFrame | None = None,
    gene: str = fixed.GENE,
    domain: str = fixed.DOMAIN,
    description: str = fixed.DOMAIN_DESCRIPTION,
    no_pattern_text: str = fixed.PATTERN_NO_MATCH_TEXT,
) -> DataFrame:
    """C7 and C8 for any number of roots and patterns, in one pass over the annotations.

    Per gene and criterion: ``<name>_evidence`` and ``<name>``. ``roots`` maps a name to an
    ontology term, met by domains with a term at or below it; repeated annotation rows count
    once. ``patterns`` maps a name to a regular expression over ``id - description``; there
    repeated rows repeat in the evidence. The matches of a hot gene are put together in several
    tasks. A domain without a description gives no evidence, and
    without evidence the flag is false.
    """
    roots, patterns = roots or {}, patterns or {}
    matched = _matched_rows(
        annotations, roots, patterns, domain_terms, below, (gene, domain, description)
    )
    entry = F.struct(
        quoted(_ANNOTATION).alias("text"),
        quoted(COPIES).alias("copies"),
        F.struct(*[quoted(name) for name in [*roots, *patterns]]).alias("met"),
    )

    def met(name: str):
        return lambda entries: F.filter(entries, lambda match: match["met"][name])

    texts = {name: (met(name), name in patterns) for name in [*roots, *patterns]}
    evidence = gathered_texts(
        matched, gene, _ANNOTATION, entry, texts, ", ", hot_texts(annotations, gene)
    )
    columns = [quoted(gene)]
    for name, root in roots.items():
        match = F.lit(f"{fixed.TERM_MATCH_TEXT}{root}: ")
        columns += _flag_and_evidence(name, match, F.lit(f"{fixed.TERM_NO_MATCH_TEXT}{root}"))
    for name in patterns:
        match = F.lit(fixed.PATTERN_MATCH_TEXT)
        columns += _flag_and_evidence(name, match, F.lit(no_pattern_text))
    return evidence.select(*columns)


def domain_flags_only(
    annotations: DataFrame,
    roots: dict[str, str] | None = None,
    patterns: dict[str, str] | None = None,
    domain_terms: DataFrame | None = None,
    below: DataFrame | None = None,
    gene: str = fixed.GENE,
    domain: str = fixed.DOMAIN,
    description: str = fixed.DOMAIN_DESCRIPTION,
) -> DataFrame:
    """The flags of :func:`domain_criteria` without the evidence, so that no gene's matches are
    gathered: one boolean per gene and criterion is all that leaves a task."""
    roots, patterns = roots or {}, patterns or {}
    matched = _matched_rows(
        annotations, roots, patterns, domain_terms, below, (gene, domain, description)
    )
    described = quoted(_ANNOTATION).isNotNull()
    return matched.groupBy(quoted(gene)).agg(
        *[F.bool_or(described & quoted(name)).alias(name) for name in [*roots, *patterns]]
    )


def ontology_criterion(
    annotations: DataFrame,
    root: str,
    name: str,
    domain_terms: DataFrame,
    below: DataFrame,
    **columns: str,
) -> DataFrame:
    """C7 for one root."""
    return domain_criteria(
        annotations, roots={name: root}, domain_terms=domain_terms, below=below, **columns
    )


def pattern_criterion(
    annotations: DataFrame, pattern: str, name: str, **columns: str
) -> DataFrame:
    """C8 for one pattern."""
    return domain_criteria(annotations, patterns={name: pattern}, **columns)


def family_rollup(
    df: DataFrame, flags: Sequence[str] = tuple(fixed.FAMILY_FLAGS), name: str = fixed.FAMILY_ROLLUP
) -> DataFrame:
    """True when any family flag is, with the names of the true ones; null counts as false."""
    met = any_true(flags)
    listed = ", ".join(f"'{flag}'" for flag in flags)
    evidence = F.when(
        met, F.concat(F.lit(fixed.ROLLUP_MATCH_TEXT), true_names(flags))
    ).otherwise(F.lit(f"{fixed.ROLLUP_NO_MATCH_TEXT}{listed}"))
    return df.withColumns({name: met, f"{name}_evidence": evidence})
