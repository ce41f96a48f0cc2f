"""Benchmark windows against a scan of every window, and awkward rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from targetlens.llm import decontaminate
from targetlens.llm.decontaminate import contamination, without_documents, without_spans

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_force(docs, benchmark, window=13):
    found = []
    items = [(i, WORD.findall((t or "").translate(LOWER))) for i, t in benchmark]
    for key, text in docs:
        words, hit, held = WORD.findall((text or "").translate(LOWER)), set(), set()
        for item, wanted in items:
            size = min(window, len(wanted))
            for j in range(len(wanted) - size + 1 if wanted else 0):
                for i in range(len(words) - size + 1):
                    if words[i : i + size] == wanted[j : j + size]:
                        hit |= set(range(i, i + size))
                        held.add(str(item))
        found.append((key, len(words), len(hit), sorted(held)))
    return sorted(found, key=repr)


def result(spark, docs, benchmark):
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(benchmark, "item_id long, text string")
    rows = contamination(left, right).select("doc_id", "_hits").collect()
    return sorted(((r[0], r[1].n_words, r[1].n_hit, r[1]["items"]) for r in rows), key=repr)


def cases():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(50)] + ["Ünï", "ÄB", "İx"]
    benchmark = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 30)))) for i in range(12)]
    benchmark += [(50, None), (51, ""), (52, "- , ."), (3, benchmark[4][1])]
    docs = []
    for key in range(60):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        if rng.random() < 0.6:
            passage = (rng.choice(benchmark)[1] or "").split()
            start = rng.randrange(len(words) + 1)
            words[start:start] = passage[: rng.randint(0, 40)] * rng.randint(1, 2)
        docs.append((key, ", ".join(words).upper() if key % 3 else "\n".join(words)))
    docs += [(None, benchmark[1][1]), (1, benchmark[2][1]), (1, benchmark[2][1]), (70, None)]
    return docs + [(71, ""), (72, (benchmark[5][1] + " ") * 3_000)], benchmark


def test_agrees_with_every_window(spark):
    docs, benchmark = cases()
    assert result(spark, docs, benchmark) == brute_force(docs, benchmark)


def test_agrees_when_the_windows_are_not_broadcast(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST_BYTES", -1)
    docs, benchmark = cases()
    assert result(spark, docs, benchmark) == brute_force(docs, benchmark)


@pytest.mark.parametrize("benchmark", [[], [(1, None)]])
def test_nothing_to_hit(spark, benchmark):
    assert result(spark, [(1, "a b")], benchmark) == [(1, 2, 0, [])]
    assert result(spark, [], [(1, "a b")]) == []


def test_removal(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    docs = [
        (1, f"before, {passage}. After", "x"), (2, "clean one", "y"), (3, None, "z"),
        (4, " ".join(["filler"] * 300) + " " + passage, "w"),
    ]
    left = spark.createDataFrame(docs, "doc_id long, text string, window string")
    right = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = without_documents(left, right)
    assert kept.columns == left.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    cut = {r.doc_id: r.text for r in without_spans(left, right).collect()}
    assert cut[1] == "before, After" and cut[2] == "clean one" and cut[3] is None
    assert cut[4].split() == ["filler"] * 300


def test_hits_of_rows_with_one_id_do_not_meet(spark, monkeypatch):
    seen = []
    measured = decontaminate._measured

    def watched():
        seen.append(True)
        return F.struct(measured().alias("hits"), F.size("_found").alias("found"))

    monkeypatch.setattr(decontaminate, "_measured", watched)
    passages = [" ".join(f"p{i}x{j}" for j in range(13)) for i in range(20)]
    rows = [(key, text) for key in (None, 1) for text in passages for _ in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(passages)), "item_id long, text string")
    found = contamination(docs, benchmark).select("_hits.*").collect()
    assert seen and len(found) == len(rows)
    assert all(row.found == 1 and row.hits.n_hit == 13 for row in found)
