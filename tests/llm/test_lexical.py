"""Ranked search against a score of every document, and awkward rows."""

import math
import random
import re
from collections import Counter

import pytest

from targetlens.llm import lexical
from targetlens.llm.lexical import ranked_documents, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def brute_force(docs, items, best=10):
    split = [TERM.findall((text or "").translate(LOWER)) for _, text in docs]
    number, total = sum(map(bool, split)), sum(map(len, split))
    df = Counter(t for words in split for t in set(words))
    found = []
    for item, text in items:
        scored = []
        for (key, _), words in zip(docs, split, strict=True):
            counts, score = Counter(words), 0
            for term in set(TERM.findall((text or "").translate(LOWER))) & set(words):
                weight = math.floor(1000 * math.log((2 * number + 2) / (2 * df[term] + 1)))
                m = 10 + 90 * len(words) * number // total
                score += weight * (10**9 * counts[term] // (1000 * counts[term] + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        found += [(item, rank, s[2], -s[0]) for rank, s in enumerate(scored[:best], 1)]
    return sorted(found, key=repr)


def cases():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "ÄB", "ß", "x9", "\U0001f600"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(most):
        return rng.choice([" ", "_", ", ", "\n"]).join(
            rng.choices(vocabulary, weights, k=rng.randint(1, most))
        )

    docs = [(key, text(120)) for key in range(400)]
    docs += [(-5, docs[3][1].upper()), (3, docs[3][1]), (3, docs[3][1]), (None, docs[3][1])]
    docs += [(900, None), (901, ""), (902, "-- ,"), (903, "w1 " * 60_000 + "w250")]
    items = [(key, text(20)) for key in range(25)]
    items += [(3, docs[3][1]), (3, docs[3][1]), (30, None), (31, "!"), (32, "nowhere"), (None, "w7")]
    return docs, items


def result(spark, docs, items, **options):
    left, right = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    found = ranked_documents(left.repartition(7), right, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


def test_agrees_with_every_score(spark):
    docs, items = cases()
    assert result(spark, docs, items) == brute_force(docs, items)


def test_items_in_several_blocks(spark):
    docs, items = cases()
    assert result(spark, docs, items, most_item_bytes=700, best=3) == brute_force(docs, items, 3)


def test_ties_go_to_the_smallest_ids(spark):
    docs = [(key, "one two") for key in range(60, 0, -1)] + [(99, "three")]
    found = result(spark, docs, [(1, "Two")])
    assert [row[2] for row in sorted(found, key=lambda r: r[1])] == list(range(1, 11))


@pytest.mark.parametrize("docs, items", [([], []), ([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")])])
def test_empty_tables(spark, docs, items):
    assert result(spark, docs, items) == []


def test_terms_are_letters_digits_and_what_is_beyond_ascii():
    text = "".join(map(chr, range(256))) + " ÀB c"
    assert [t.decode() for t in terms_of(text)] == TERM.findall(text.translate(LOWER))
    assert terms_of(None) == terms_of("") == []


def test_portions_hold_all_documents(spark, monkeypatch):
    monkeypatch.setattr(lexical, "MOST_CELLS", 50)
    split = [[b"a", b"b"], [b"b"], [b"a", b"c"]]
    table = lexical.pa.table({"term": [0, 1, 2], "count": [2, 3, 1]})
    index = lexical._index(split, {b"a": 0, b"b": 1, b"c": 2}, table, 4, 20)
    rng = random.Random(1)
    terms = [rng.sample(range(3), rng.randint(1, 3)) for _ in range(90)]
    batch = lexical.columns(
        n=lexical.pa.array([5] * 90),
        terms=lexical.pa.array(terms, lexical.pa.list_(lexical.pa.int32())),
        times=lexical.pa.array([[2] * len(t) for t in terms], lexical.pa.list_(lexical.pa.int64())),
    )
    portions = list(index.portions(batch))
    assert len(portions) > 5 and sum(p.num_rows for p in portions) == 90
    scores = lexical.np.concatenate([index.scores(p) for p in portions])
    assert (scores == index.scores(batch)).all() and scores.any()


def test_extra_columns_may_clash(spark):
    docs = spark.createDataFrame([(1, "a b", 1, 2)], "doc_id int, text string, id int, `a.b` int")
    items = spark.createDataFrame([("q", "b", 3)], "item_id string, text string, score int")
    found = ranked_documents(docs, items).collect()
    assert [tuple(r)[:3] for r in found] == [("q", 1, 1)]
