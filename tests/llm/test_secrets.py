"""Secret spans against Python's regular expressions, the trigram queries, redaction."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from targetlens.llm.secrets import RULES, Rule, joined_spans, redacted, running_sums, secret_spans
from targetlens.llm.trigrams import trigram_query

SCHEMA = "doc_id long, text string"
GITHUB = "ghp_" + "aB3" * 13
TEXTS = [
    None, "", "no secret here", "password=short", "password = 'longenough1'",
    "token=token:abcdefgh12", "API_KEY: abc/def+123==", "apikey=ABCDEFGHIJ secret:x",
    "é😀 token=é", "é😀 token=abcdef😀token=ghijkl", "AKIA" + "A1" * 8, "AKIA" + "A1" * 7,
    "x" + "0123456789abcdef" * 2, "deadbeef" * 3, "deadbee" * 3, "passwd='" + "f" * 40 + "'",
    GITHUB, f"secret={GITHUB}", "xoxb-1234567890-abcdefghij", "AIza" + "b" * 35,
    "-----BEGIN RSA PRIVATE KEY-----\nabc", "eyJhbGciOiJ.eyJzdWIiOi." + "eyJ.eyJhbGciOiJI" * 2,
    "sk_live_" + "0a" * 10, "token=abcdef " * 700, "tokentoken==\"abcdef\"", "a" * 200_000,
]


def by_python(text):
    spans = []
    for place, rule in enumerate(RULES):
        for match in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(match.group(rule.group)) >= rule.least:
                spans.append((match.start(), place, match.end(), rule.kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def test_spans_agree_with_python(spark):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[4]), (4, TEXTS[6]), (4, TEXTS[6])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", spans int")
    result = secret_spans(df).select("doc_id", joined_spans("spans").alias("s")).collect()
    wanted = sorted(((k, by_python(t)) for k, t in rows), key=repr)
    assert sorted(map(tuple, result), key=repr) == wanted


def test_empty_table(spark):
    assert secret_spans(spark.createDataFrame([], SCHEMA)).collect() == []
    assert redacted(spark.createDataFrame([], SCHEMA)).collect() == []


def test_redaction_keeps_rows_and_columns(spark):
    rows = [(1, TEXTS[4], "a"), (2, None, "b"), (3, "clean", "c"), (4, "token=short", "d")]
    rows += [(5, f"x {GITHUB} y token=abcdefg z", "e"), (6, "password=short", "f")]
    df = spark.createDataFrame(rows, SCHEMA + ", rules string")
    result = {r.doc_id: r.text for r in redacted(df).collect()}
    assert redacted(df).columns == df.columns
    assert result == {
        1: "[assign]'", 2: None, 3: "clean", 4: "token=short", 5: "x [github] y [assign] z",
        6: "password=short",
    }


def test_running_sums(spark):
    values = list(range(1, 1_200))
    df = spark.createDataFrame([(values,), ([],)], "v array<long>").select(running_sums("v"))
    sums = [sum(values[: i + 1]) for i in range(len(values))]
    assert [r[0] for r in df.collect()] == [sums, []]


def holds(query, text):
    grams = {text[i : i + 3] for i in range(len(text) - 2)}
    return all(any(alternative <= grams for alternative in need) for need in query)


@pytest.mark.parametrize("pattern", [r.pattern for r in RULES] + ["a|bcd", "(ab){2}c?", "(x|abc)+def"])
@settings(max_examples=60, deadline=None)
@given(data=st.data())
def test_trigram_queries_never_exclude_a_match(pattern, data):
    text = data.draw(st.from_regex(re.compile(pattern, re.ASCII), fullmatch=False))
    assert holds(trigram_query(pattern), text.lower())


def test_rules_without_trigrams_scan_everything(spark):
    assert trigram_query(RULES[2].pattern) == ()
    rule = (Rule("digits", r"[0-9]{3,}"),)
    df = spark.createDataFrame([(1, "ab 1234 c")], SCHEMA)
    assert secret_spans(df, rules=rule).select(joined_spans("spans")).first()[0] == "digits:3:7"
