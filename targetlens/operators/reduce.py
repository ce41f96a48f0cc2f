"""Many rows per key to one."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from targetlens.functions.flags import is_missing, quoted
from targetlens.operators import joins
from targetlens.operators.joins import HotKeys
from targetlens.storage import plan_bytes, written

_RANK = "_rank"
_RUN = "_run"
_ENTRIES = "_entries"
COPIES = "_copies"
# A table of fewer bytes has no key whose texts are worth putting together in several tasks.
SMALLEST_HOT_BYTES = 64_000_000


def max_per_key(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """A1: greatest value per key; null when the key has none."""
    return df.groupBy(quoted(key)).agg(F.max(quoted(value)).alias(name))


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first whole row per key.

    Spark keeps one row per key and task before the shuffle, so a hot key costs no more than
    any other. ``order`` must be total for the result to be the same on every run.
    """
    window = Window.partitionBy(*[quoted(key) for key in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def _ascending(df: DataFrame, names: Sequence[str] | None, skip: Sequence[str]) -> list[Column]:
    if names is None:
        names = [name for name in df.columns if name not in skip]
    return [quoted(name).asc_nulls_last() for name in names]


def top_row(
    df: DataFrame, key: str, value: str, tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """A2: the row with the greatest value per key, rows without a value last.

    Equal values are decided by ``tie_breakers`` ascending (default: all other columns).
    """
    ties = _ascending(df, tie_breakers, [key, value])
    return first_row(df, [key], [quoted(value).desc_nulls_last(), *ties])


def argmax_row(
    df: DataFrame, key: str, value: str, tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """A3: the row with the greatest value per key, a missing value counting as 0.

    Rows without a key are left out. Equal values are decided as in :func:`top_row`.
    """
    filled = F.when(is_missing(df, value), F.lit(0)).otherwise(quoted(value))
    known = df.where(~is_missing(df, key)).withColumn(
        value, filled.cast(df.schema[value].dataType)
    )
    return top_row(known, key, value, tie_breakers)


def joined_texts(
    df: DataFrame, key: str, texts: dict[str, Column], separator: str = ", "
) -> DataFrame:
    """A4: per key, the texts of each named column joined in ascending order.

    Null texts are ignored; a key with none gets ``''``. Equal rows are counted before the key's
    shuffle, so what is gathered per key is its distinct texts, and repeats are written out only
    in the finished text. Hot keys are gathered as in :func:`gathered_texts`.
    """
    named = df.select(
        quoted(key), *[text.alias(name) for name, text in texts.items()], F.lit(1).alias(COPIES)
    )
    counted = sum_copies(named, [key, *texts])
    hot = hot_texts(df, key)
    if len(texts) == 1 or not hot.pieces:
        return _joined(counted, key, list(texts), separator, hot)
    # The runs of a hot key are of one text each.
    parts = [_joined(hot.without(counted), key, list(texts), separator, None)]
    for name in texts:
        alone = _joined(hot.only(counted), key, [name], separator, hot)
        others = [F.lit(None).cast("string").alias(other) for other in texts if other != name]
        parts.append(alone.select("*", *others))
    whole = reduce(DataFrame.unionByName, parts)
    return whole.groupBy(quoted(key)).agg(*[F.max(quoted(name)).alias(name) for name in texts])


def _joined(
    counted: DataFrame, key: str, names: Sequence[str], separator: str, hot: HotKeys | None
) -> DataFrame:
    def entry(name: str) -> Column:
        return F.struct(quoted(name).alias("text"), F.col(COPIES).alias("copies"))

    if hot is not None and hot.pieces:
        name = names[0]
        every = {name: (lambda entries: entries, True)}
        return gathered_texts(counted, key, name, entry(name), every, separator, hot)
    lists = counted.groupBy(quoted(key)).agg(
        *[
            F.sort_array(F.collect_list(F.when(quoted(name).isNotNull(), entry(name)))).alias(name)
            for name in names
        ]
    )
    return lists.select(
        quoted(key), *[spelled_out(quoted(name), separator).alias(name) for name in names]
    )


def hot_texts(df: DataFrame, key: str) -> HotKeys:
    """Keys with so many rows that their texts are put together by several tasks.

    A table that one task could hold has none, and is not scanned for them.
    """
    if plan_bytes(df) < SMALLEST_HOT_BYTES:
        return HotKeys(key, df.schema[key].dataType, ())
    return joins.find_hot_keys(df, key)


def gathered_texts(
    rows: DataFrame,
    key: str,
    text: str,
    entry: Column,
    texts: Mapping[str, tuple[Callable[[Column], Column], bool]],
    separator: str,
    hot: HotKeys,
) -> DataFrame:
    """Per key, the texts of its sorted entries, joined; ``entry`` begins with ``text``.

    ``texts`` names the joined texts, with which of the entries each takes and whether it repeats
    them. The rows of hot keys are dealt by range of the text. Each task sorts and spells the run of a key
    that it has, so what meets in the end is one piece of text from each task, in order. Rows
    without a text add nothing but their key.
    """

    def listed(df: DataFrame, *by: str) -> DataFrame:
        entries = F.sort_array(F.collect_list(F.when(quoted(text).isNotNull(), entry)))
        return df.groupBy(*map(quoted, by)).agg(entries.alias(_ENTRIES))

    def spelled(name: str) -> Column:
        some, repeat = texts[name]
        return spelled_out(some(F.col(_ENTRIES)), separator, repeat)

    def run(name: str) -> Column:
        some, _ = texts[name]
        return F.when(F.size(some(F.col(_ENTRIES))) > 0, spelled(name)).alias(name)

    def whole(name: str) -> Column:
        part = F.struct(_RUN, quoted(name).alias("text"))
        parts = F.array_sort(F.collect_list(F.when(quoted(name).isNotNull(), part)))
        return F.array_join(F.transform(parts, lambda x: x["text"]), separator).alias(name)

    if hot.pieces:
        rows = written(rows, "texts").table
    others = listed(hot.without(rows) if hot.pieces else rows, key)
    others = others.select(quoted(key), *[spelled(name).alias(name) for name in texts])
    if not hot.pieces:
        return others
    count = 1 + sum(number for _, number in hot.pieces)
    dealt = hot.only(rows).repartitionByRange(count, quoted(key), quoted(text))
    runs = listed(dealt.withColumn(_RUN, F.spark_partition_id()), key, _RUN)
    runs = runs.select(quoted(key), _RUN, *map(run, texts))
    return others.unionByName(runs.groupBy(quoted(key)).agg(*map(whole, texts)))


def spelled_out(entries: Column, separator: str = ", ", repeat: bool = True) -> Column:
    """Joined ``text`` of a list of entries, each ``copies`` times, or once without ``repeat``."""

    def spelled(entry: Column) -> Column:
        if not repeat:
            return entry["text"]
        again = F.repeat(F.concat(entry["text"], F.lit(separator)), entry["copies"].cast("int") - 1)
        return F.concat(again, entry["text"])

    return F.array_join(F.transform(entries, spelled), separator)


def sum_copies(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct rows of the named columns with the sum of their ``_copies``."""
    return df.groupBy(*[quoted(name) for name in names]).agg(
        F.sum(COPIES).alias(COPIES)
    )


# Bits of a positive long.
_GROUPS_PER_WORD = 63


def groups_per_value(
    df: DataFrame, value: str, group: str, groups: Sequence[str], name: str
) -> DataFrame:
    """A5: per value, the sorted distinct ``groups`` it occurs in.

    A group is a bit of a number while rows are gathered, so a value is a row of a few numbers
    however often it occurs; the names are spelled out at the end.
    """
    allowed = list(dict.fromkeys(str(item) for item in groups))
    words = [
        allowed[i : i + _GROUPS_PER_WORD] for i in range(0, len(allowed), _GROUPS_PER_WORD)
    ]
    wanted = df.where(~is_missing(df, value) & quoted(group).isin(allowed))
    masks = [
        F.bit_or(
            F.coalesce(*[F.when(quoted(group) == g, F.lit(1 << bit)) for bit, g in enumerate(word)],
                       F.lit(0)).cast("long")
        ).alias(f"_groups{place}")
        for place, word in enumerate(words)
    ]
    kind = df.schema[group].dataType
    named = [
        F.when(F.getbit(f"_groups{place}", F.lit(bit)) == 1, F.lit(g).cast(kind))
        for place, word in enumerate(words)
        for bit, g in enumerate(word)
    ]
    listed = F.array_sort(F.array_compact(F.array(*named))) if named else F.array().cast("array<string>")
    counted = wanted.groupBy(quoted(value)).agg(*masks) if masks else wanted.select(quoted(value))
    return counted.select(quoted(value), listed.alias(name))


def value_map(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Long key/value rows as one sorted distinct list per key; a missing value is in none.

    Pairs are made distinct first, by key and value, so the copies of a very frequent key are
    dropped in many tasks, and the task that lists its values reads each of them once.
    """
    pairs = df.select(quoted(key), quoted(value)).distinct()
    return pairs.groupBy(quoted(key)).agg(F.array_sort(F.collect_list(quoted(value))).alias(name))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each row once."""
    return df.distinct()


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row per key in the given order; rows without a key count as one key.

    A table without the key column is returned as it is.
    """
    if key not in df.columns:
        return df
    return first_row(df, [key], [quoted(name).asc_nulls_last() for name in order])
