"""Boolean trigram queries of regular expressions, and an inverted index that answers them.

A query is an AND of requirements, a requirement an OR of alternatives, an alternative a set of
trigrams that must all occur. Case is folded, so a query never excludes a text that could match.
"""

from __future__ import annotations

import re._constants as kinds
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_STRINGS = 48
SMALL_CLASS = 8

Requirement = frozenset[frozenset[str]]


@dataclass(frozen=True)
class _Part:
    """The strings a part can be (None: not listable), and what must occur in any of its matches."""

    strings: frozenset[str] | None
    needs: tuple[Requirement, ...] = ()


def trigram_query(pattern: str) -> tuple[Requirement, ...]:
    """What must occur in a text that ``pattern`` matches; empty: nothing can be said."""
    part = _sequence(list(parser.parse(pattern)))
    return tuple(dict.fromkeys(part.needs + _requirement(part.strings)))


def _requirement(strings: frozenset[str] | None) -> tuple[Requirement, ...]:
    """One of ``strings`` occurs; nothing if one of them is too short for a trigram."""
    if not strings:
        return ()
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return ()
    return (frozenset(s for s in sets if not any(other < s for other in sets)),)


def _sequence(items: list) -> _Part:
    strings, needs, whole = frozenset([""]), [], True
    for item in items:
        part = _part(*item)
        needs += part.needs
        joined = None
        if part.strings is not None and len(strings) * len(part.strings) <= MOST_STRINGS:
            joined = frozenset(a + b for a, b in product(strings, part.strings))
        if joined is None:
            needs += _requirement(strings)
            strings, whole = part.strings or frozenset([""]), False
        else:
            strings = joined
    if whole:
        return _Part(strings, tuple(needs))
    return _Part(None, (*needs, *_requirement(strings)))


def _part(kind, value) -> _Part:
    if kind is kinds.LITERAL:
        return _Part(frozenset([chr(value).lower()]))
    if kind is kinds.IN and all(k is kinds.LITERAL for k, _ in value):
        letters = frozenset(chr(v).lower() for _, v in value)
        return _Part(letters if len(letters) <= SMALL_CLASS else None)
    if kind is kinds.SUBPATTERN:
        return _sequence(list(value[-1]))
    if kind is kinds.BRANCH:
        return _either([_sequence(list(branch)) for branch in value[1]])
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
        least, most, body = value
        part = _sequence(list(body))
        if (least, most) == (0, 1) and part.strings is not None:
            return _Part(part.strings | {""})
        if least == 0:
            return _Part(None)
        if least == most and part.strings is not None and len(part.strings) ** least <= MOST_STRINGS:
            return _Part(frozenset(map("".join, product(part.strings, repeat=least))))
        return _Part(None, part.needs + _requirement(part.strings))
    if kind in (kinds.AT, kinds.ASSERT, kinds.ASSERT_NOT):
        return _Part(frozenset([""]))
    return _Part(None)


def _either(parts: list[_Part]) -> _Part:
    if all(part.strings is not None for part in parts):
        strings = frozenset().union(*(part.strings for part in parts))
        if len(strings) <= MOST_STRINGS:
            return _Part(strings)
    needs = [part.needs + _requirement(part.strings) for part in parts]
    if not all(needs):
        return _Part(None)
    # One requirement of each branch suffices for a superset of the matches.
    return _Part(None, (frozenset().union(*(branch[0] for branch in needs)),))


def trigram_index(docs: DataFrame, key: str, text: Column, trigrams: list[str]) -> DataFrame:
    """Postings ``trigram``, ``key`` of the given trigrams: one row for each that a text holds."""
    folded = docs.select(F.col(key), F.lower(text).alias("folded"))
    held = [F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in trigrams]
    return folded.select(F.explode(F.array_compact(F.array(*held))).alias("trigram"), key)


def candidates(postings: DataFrame, key: str, queries: dict[str, tuple]) -> DataFrame:
    """``key``, ``rules``: the sorted names of the queries that a key's postings satisfy.

    Postings meet the queries in one join (the query table is as long as the rules). An
    alternative holds when all its trigrams do, a requirement when an alternative does, a query
    when all its requirements do. Postings of one key come from one row, so counting combines
    before the shuffle. Null keys are counted as one key.
    """
    rows = [
        (rule, r, a, trigram, len(alternative), len(needs))
        for rule, needs in queries.items()
        for r, need in enumerate(needs)
        for a, alternative in enumerate(sorted(need, key=sorted))
        for trigram in sorted(alternative)
    ]
    wanted = postings.sparkSession.createDataFrame(
        rows, "rule string, need int, alternative int, trigram string, trigrams int, needs int"
    )
    met = postings.join(F.broadcast(wanted), "trigram")
    met = met.groupBy(key, "rule", "need", "needs", "alternative", "trigrams").agg(
        F.collect_set("trigram").alias("held")
    )
    met = met.where(F.size("held") == F.col("trigrams"))
    met = met.groupBy(key, "rule", "needs").agg(F.collect_set("need").alias("held"))
    met = met.where(F.size("held") == F.col("needs"))
    return met.groupBy(key).agg(F.sort_array(F.collect_set("rule")).alias("rules"))
