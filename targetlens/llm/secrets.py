"""Secrets in texts: a trigram index names the texts that can match a rule, the rule's expression
then finds its spans. Built-in functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.llm.common import let, plainly_named
from targetlens.llm.trigrams import candidates, trigram_index, trigram_query

BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping; those whose group ``group`` is shorter
    than ``least`` are dropped afterwards."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Fixed values. A run of at least n characters of a class is what remains of its runs after the
# shorter ones are dropped, so those rules can ask for the length in the pattern itself. The first
# rule cannot: a dropped match still uses up its characters.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[bp]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE_RULES + MORE_RULES


def running_sums(values: Column) -> Column:
    """The sums of an array up to each of its items, in blocks, so that a long one stays cheap."""
    zero = F.lit(0).cast("long")

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda a, b: a + b)

    def of_blocks(values: Column) -> Column:
        last = F.greatest(F.size(values) - 1, F.lit(0))
        starts = F.sequence(F.lit(0), last, F.lit(BLOCK))
        return F.transform(starts, lambda start: total(F.slice(values, start + 1, BLOCK)))

    def before_blocks(sums: Column) -> Column:
        return F.transform(sums, lambda _, i: total(F.slice(sums, F.lit(1), i)))

    def sums(values: Column, before: Column) -> Column:
        return F.transform(
            values,
            lambda _, i: F.get(before, F.floor(i / BLOCK).cast("int"))
            + total(F.slice(values, i - i % BLOCK + 1, i % BLOCK + 1)),
        )

    return let(
        values,
        lambda v: let(of_blocks(v), lambda s: let(before_blocks(s), lambda before: sums(v, before))),
    )


def _matches(text: Column, rule: Rule, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of the texts before each match and after the last, and of the matches: ``text``, and
    ``counts`` for those that are not dropped."""
    gaps = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = found
    if rule.least:
        tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    matches = F.zip_with(
        found,
        tested,
        lambda match, part: F.struct(
            match.alias("text"), (F.char_length(part) >= rule.least).alias("counts")
        ),
    )
    return let(gaps, lambda gaps: let(matches, lambda matches: use(gaps, matches)))


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """Spans of a rule in code points, end exclusive."""

    def placed(gaps: Column, matches: Column) -> Column:
        steps = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(matches)),
            matches,
            lambda gap, match: (F.char_length(gap) + F.char_length(match["text"])).cast("long"),
        )
        spans = F.zip_with(
            running_sums(steps),
            matches,
            lambda end, match: F.struct(
                (end - F.char_length(match["text"])).alias("start"),
                F.lit(place).alias("place"),
                end.alias("end"),
                F.lit(rule.kind).alias("kind"),
                match["counts"].alias("counts"),
            ),
        )
        return F.filter(spans, lambda x: x["counts"])

    spans = F.transform(
        _matches(text, rule, placed), lambda x: F.struct(x["start"], x["place"], x["end"], x["kind"])
    )
    return spans.cast("array<struct<start:long,place:int,end:long,kind:string>>")


def with_rules(docs: DataFrame, id_column: str, text_column: str, rules: tuple) -> DataFrame:
    """``docs`` with ``_rules``: the kinds of rules that a row's text has to be scanned for.

    Rules without a mandatory trigram are scanned for everywhere. Rows that share an id share the
    kinds found for any of them; scanning too much changes no result.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: needs for kind, needs in queries.items() if needs}
    always = F.array(*[F.lit(kind) for kind in queries if kind not in indexed]).cast(
        "array<string>"
    )
    if not indexed:
        return docs.withColumn("_rules", always)
    trigrams = sorted({t for needs in indexed.values() for need in needs for a in need for t in a})
    keyed = docs.select(quoted(id_column).alias("_key"), quoted(text_column).alias("_text"))
    postings = trigram_index(keyed, "_key", F.col("_text"), trigrams)
    found = candidates(postings, "_key", indexed).withColumnRenamed("rules", "_rules")
    joined = docs.join(found, docs[quoted_name(id_column)].eqNullSafe(found["_key"]), "left")
    kinds = F.concat(always, F.coalesce("_rules", F.array().cast("array<string>")))
    return joined.withColumn("_rules", kinds).drop("_key")


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def secret_spans(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Id, text and ``spans``: a sorted array of (start, place of the rule, end, kind) per row.

    Positions are code points, ends exclusive, of the whole text. Null and empty texts have no
    spans. Rows with a null or repeated id are scanned like any other; equal rows give equal
    results, one for each. Columns other than the two are left out, so none can clash.
    """
    text = F.coalesce(quoted(text_column), F.lit("")).alias("_text")
    narrow = docs.select(quoted(id_column).alias("_id"), text)
    narrow = with_rules(narrow, "_id", "_text", rules)
    empty = F.array().cast("array<struct<start:long,place:int,end:long,kind:string>>")
    text = F.col("_text")
    each = [
        F.when(
            F.array_contains("_rules", F.lit(rule.kind)) & F.regexp_like(text, F.lit(rule.pattern)),
            _spans(text, rule, place),
        ).otherwise(empty)
        for place, rule in enumerate(rules)
    ]
    spans = F.array_sort(F.concat(*each))
    return narrow.select(
        F.col("_id").alias(id_column), text.alias(text_column), spans.alias("spans")
    )


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    texts = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    return F.array_join(texts, ",")


def redacted(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets; all rows and columns stay.

    Rules apply in their order, each to what the earlier ones left. Null texts stay null. Columns
    may have any names.
    """
    plain, names = plainly_named(docs)
    text_column = names[text_column]
    marked = with_rules(plain, names[id_column], text_column, rules)

    def rebuilt(gaps: Column, matches: Column, kind: str) -> Column:
        parts = F.zip_with(
            gaps,
            matches,
            lambda gap, match: F.concat(
                gap,
                F.when(match["counts"], F.lit(f"[{kind}]")).otherwise(
                    F.coalesce(match["text"], F.lit(""))
                ),
            ),
        )
        return F.array_join(parts, "")

    def without(text: Column, rule: Rule) -> Column:
        holds = F.array_contains("_rules", F.lit(rule.kind))
        holds = holds & F.regexp_like(text, F.lit(rule.pattern))
        new = _matches(text, rule, lambda gaps, matches: rebuilt(gaps, matches, rule.kind))
        return F.when(holds, new).otherwise(text)

    def applied(df: DataFrame, rule: Rule) -> DataFrame:
        return df.withColumn(text_column, without(quoted(text_column), rule))

    return reduce(applied, rules, marked).select(*names.values()).toDF(*names)
