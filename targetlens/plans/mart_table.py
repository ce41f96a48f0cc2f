"""C13: "is assigned" criteria over mart rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from targetlens import fixed_values as fixed
from targetlens.operators.criteria import assigned_strict
from targetlens.operators.shape import with_row_id
from targetlens.sinks.tables import clean_records, write_array_chunks, write_clean_json


def mart_table(
    rows: DataFrame, criteria: Mapping[str, Sequence[str]] = fixed.MART_CRITERIA
) -> DataFrame:
    """Mart rows with an id and one strict flag per entry of ``criteria``.

    Export with ``clean_records(..., keep_id=False)``.
    """
    flagged = with_row_id(rows, rows.columns)
    for flag, columns in criteria.items():
        flagged = assigned_strict(flagged, columns, flag, null_is_true=False)
    return flagged


def write_mart_table(
    rows: DataFrame,
    out: str,
    criteria: Mapping[str, Sequence[str]] = fixed.MART_CRITERIA,
    order: Sequence[str] = (),
    chunk_size: int = fixed.CHUNK_RECORDS,
) -> None:
    """The flagged mart rows without id.

    Clean JSON lines, or given the ``order`` columns of the rows (see
    :func:`targetlens.sources.delimited.read_delimited`) JSON array files of ``chunk_size``
    records in that order.
    """
    flagged = mart_table(rows, criteria)
    if not order:
        write_clean_json(flagged, out, keep_id=False)
        return
    records = clean_records(flagged, keep_id=False, typed=True, carry=order)
    write_array_chunks(records, out, order, chunk_size, leave_out=order)
