"""Landing annotation tables, and filter and attribute selection over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from targetlens import fixed_values as fixed
from targetlens.functions.flags import quoted
from targetlens.operators.filters import require_column


def _accepts(name: str, wanted) -> Column:
    if isinstance(wanted, str) and "," in wanted:
        wanted = [part.strip() for part in wanted.split(",")]
    if isinstance(wanted, (list, tuple, set, frozenset)):
        return quoted(name).isin(list(wanted))
    return quoted(name) == wanted


def mart_select(
    df: DataFrame,
    filters: Mapping[str, object],
    attributes: Sequence[str],
    unique_rows: bool = False,
    headers: Mapping[str, str] = fixed.MART_HEADERS,
) -> DataFrame:
    """Rows that meet all filters, with the attribute columns under their output headers.

    A filter value is one value, a list, or a text of values separated by commas. Filter columns
    need not be selected. Repeated rows stay unless ``unique_rows``.
    """
    for name in [*filters, *attributes]:
        require_column(df, name)
    for name, wanted in filters.items():
        df = df.where(_accepts(name, wanted))
    selected = df.select(*[quoted(name).alias(headers.get(name, name)) for name in attributes])
    return selected.distinct() if unique_rows else selected


def mart_query(
    df: DataFrame,
    name: str,
    genomes: str | Sequence[str],
    headers: Mapping[str, str] = fixed.MART_HEADERS,
) -> DataFrame:
    """One of the named queries for some genomes, given as a list or separated by commas."""
    wanted = genomes.split(",") if isinstance(genomes, str) else genomes
    filters: dict[str, object] = {fixed.SPECIES_FILTER: [genome.strip() for genome in wanted]}
    if name in fixed.PROTEIN_CODING_QUERIES:
        filters[fixed.BIOTYPE_FILTER] = fixed.PROTEIN_CODING
    return mart_select(df, filters, fixed.MART_QUERIES[name], headers=headers)


def land_mart(
    df: DataFrame,
    path: str,
    genome: str = fixed.SPECIES_FILTER,
    ids: Sequence[str] = (),
    row_group_bytes: int | None = None,
) -> DataFrame:
    """The table as Parquet, one folder per genome, so that a genome filter reads only its own.

    Files are evened out on the way: a genome with many rows gets many files, and small ones are
    not scattered over all tasks. With ``ids`` files are sorted by the first of these columns and
    have a bloom filter for each, so that a filter on one id reads few row groups of a genome: by
    the first column's bounds, by the filters for the others. ``row_group_bytes`` is the size of a
    row group, by default Parquet's.
    """
    landed = df.hint("rebalance", genome)
    options = {f"parquet.bloom.filter.enabled#{name}": "true" for name in ids}
    if row_group_bytes is not None:
        options["parquet.block.size"] = str(row_group_bytes)
    if ids:
        landed = landed.sortWithinPartitions(quoted(genome), quoted(ids[0]))
    landed.write.options(**options).partitionBy(genome).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
