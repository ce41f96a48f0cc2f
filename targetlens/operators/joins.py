"""Equi-joins that stay balanced when one key holds a large share of the left table.

Left rows of a hot key are spread over several join partitions by their map partition number,
which is the same when a task is run again, and the matching right rows are repeated once per
spread. Every left row still meets every right row of its key, so the result does not depend on
which keys were found to be hot.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from targetlens.functions.flags import quoted
from targetlens.operators.quality import expect_unique, require
from targetlens.storage import Written, plan_bytes

# A key is hot when it alone fills more than one of the join's partitions, so there are at most as
# many hot keys as partitions. Spark's sketch takes these bounds; joins with more partitions leave
# what is beyond them to adaptive execution.
MOST_SKETCH_KEYS = 100_000
MOST_SKETCH_ITEMS = 1_000_000
# Setting of the session: a key with fewer rows is never worth spreading.
FEWEST_ROWS_SETTING = "targetlens.join.fewestHotRows"
FEWEST_HOT_ROWS = 100_000
_SPREAD = "_spread"
_PIECES = "_pieces"
_HOT_KEY = "_hot_key"


@dataclass(frozen=True)
class HotKeys:
    """Hot values of one key column, with the number of pieces each is cut into.

    Holds at most one value per shuffle partition, whatever the size of the table.
    """

    column: str
    key_type: T.DataType
    pieces: tuple[tuple[object, int], ...]

    def _frame(self, spark):
        schema = T.StructType(
            [T.StructField(_HOT_KEY, self.key_type), T.StructField(_PIECES, T.IntegerType())]
        )
        return F.broadcast(spark.createDataFrame(list(self.pieces), schema))

    def _with_pieces(self, df: DataFrame) -> DataFrame:
        same = quoted(self.column).eqNullSafe(F.col(_HOT_KEY))
        return df.join(self._frame(df.sparkSession), same, "left").drop(_HOT_KEY)

    def only(self, df: DataFrame) -> DataFrame:
        """Rows of the hot keys."""
        same = quoted(self.column).eqNullSafe(F.col(_HOT_KEY))
        return df.join(self._frame(df.sparkSession), same, "left_semi")

    def without(self, df: DataFrame) -> DataFrame:
        """Rows of all other keys."""
        same = quoted(self.column).eqNullSafe(F.col(_HOT_KEY))
        return df.join(self._frame(df.sparkSession), same, "left_anti")

    def spread(self, left: DataFrame) -> DataFrame:
        """Left rows with the piece each one belongs to."""
        pieces = F.coalesce(F.col(_PIECES), F.lit(1))
        return (
            self._with_pieces(left)
            .withColumn(_SPREAD, F.pmod(F.spark_partition_id(), pieces))
            .drop(_PIECES)
        )

    def repeat(self, right: DataFrame) -> DataFrame:
        """Right rows, once per piece of their key."""
        last = F.coalesce(F.col(_PIECES), F.lit(1)) - 1
        return (
            self._with_pieces(right)
            .withColumn(_SPREAD, F.explode(F.sequence(F.lit(0), last)))
            .drop(_PIECES)
        )


def find_hot_keys(df: DataFrame, column: str, fewest_rows: int | None = None) -> HotKeys:
    """Hot values of ``column``, by one frequent-items sketch: a single scan, no key shuffle.

    ``fewest_rows`` is by default the session's ``targetlens.join.fewestHotRows``. The counts are
    estimates; they steer the balance of a join, never its result.
    """
    conf = df.sparkSession.conf
    partitions = int(conf.get("spark.sql.shuffle.partitions"))
    if fewest_rows is None:
        fewest_rows = int(conf.get(FEWEST_ROWS_SETTING, str(FEWEST_HOT_ROWS)))
    most = min(max(partitions, 1), MOST_SKETCH_KEYS)
    items = min(max(16_384, 8 * most), MOST_SKETCH_ITEMS)
    top = F.expr(f"approx_top_k({_HOT_KEY}, {most}, {items})")
    found = (
        df.select(quoted(column).alias(_HOT_KEY))
        .agg(top.alias("top"), F.count(F.lit(1)).alias("rows"))
        .first()
    )
    share = max(found["rows"] / partitions, fewest_rows)
    pieces = tuple(
        (item["item"], math.ceil(item["count"] / share))
        for item in found["top"] or []
        if item["count"] > share
    )
    return HotKeys(column, df.schema[column].dataType, pieces)


def spread_join(left: DataFrame, right: DataFrame, on: str, hot: HotKeys, how: str) -> DataFrame:
    """Shuffle join on ``on`` with the hot keys of ``left`` cut into pieces.

    ``how`` is one of ``inner``, ``left``, ``left_semi``, ``left_anti``.
    """
    if not hot.pieces:
        return left.join(right, on, how)
    return hot.spread(left).join(hot.repeat(right), [on, _SPREAD], how).drop(_SPREAD)


def broadcast_limit(spark) -> int:
    """The session's limit on broadcasts in bytes; negative when there are none."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower().rstrip("b")
    units = {"k": 2**10, "m": 2**20, "g": 2**30}
    return int(limit[:-1]) * units[limit[-1]] if limit[-1] in units else int(limit)


def _balanced(left, right, on: str, how: str, hot: HotKeys | None) -> DataFrame:
    """The join; ``left`` is scanned for hot keys only where Spark will shuffle it."""
    if hot is None and plan_bytes(right) <= broadcast_limit(left.sparkSession):
        return left.join(right, on, how)
    return spread_join(left, right, on, hot or find_hot_keys(left, on), how)


def left_join(
    left: DataFrame, right: DataFrame, on: str, hot: HotKeys | None = None
) -> DataFrame:
    """Left equi-join; ``right`` may be as large as ``left``. ``hot`` if already known."""
    return _balanced(left, right, on, "left", hot)


def inner_join(
    left: DataFrame, right: DataFrame, on: str, hot: HotKeys | None = None
) -> DataFrame:
    """Inner equi-join of many rows with one row per key; only ``left`` may have hot keys."""
    return _balanced(left, right, on, "inner", hot)


def fits_broadcast(*sides: Written) -> bool:
    """Whether the written tables together are within the session's limit on broadcasts."""
    return sum(side.bytes for side in sides) <= broadcast_limit(sides[0].table.sparkSession)


def lookup_join(
    left: DataFrame,
    side: Written,
    on: str,
    how: str = "left",
    keys: DataFrame | None = None,
) -> DataFrame:
    """Join a derived, measured lookup table back onto the rows of ``left``.

    Within the broadcast limit ``left`` is not shuffled at all; beyond it the join shuffles, with
    the hot keys cut into pieces. ``keys`` may name a cheaper table in which the key is
    distributed the same way.
    """
    if fits_broadcast(side):
        return left.join(F.broadcast(side.table), on, how)
    hot = find_hot_keys(left if keys is None else keys, on)
    return spread_join(left, side.table, on, hot, how)


def fold_left(
    base: DataFrame, sides: Sequence[DataFrame], on: str, check: Sequence[DataFrame] = ()
) -> DataFrame:
    """Chain of left equi-joins onto a table that is unique on ``on``.

    Each side must be unique on ``on`` too; a side among ``check`` that repeats a key is an error
    (A10). All joins share the key, so every side is shuffled at most once and the running result
    not again.
    """
    for side in check:
        require(expect_unique(side, on))
    return reduce(lambda joined, side: joined.join(side, on, "left"), sides, base)
