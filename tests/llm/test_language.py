"""Held-out accuracy and awkward rows of language identification."""

import math
import random
from collections import Counter

import pytest
import regex

from targetlens.llm import language
from targetlens.llm.common import fold
from pyspark.sql import functions as F

SYLLABLES = {"aa": "ba be bi bo".split(), "bb": "ku kö kä st".split(), "cc": "ño ll ci ta".split()}
SCHEMA = "doc_id long, text string, lang string"


def text_of(rng, lang, words):
    syllables = SYLLABLES[lang]
    made = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words)]
    return " ".join(made).capitalize() + ". 12"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(300)]
    return [(i, text_of(rng, lang, rng.randint(3, 60)), lang) for i, lang in enumerate(langs)]


def test_held_out_accuracy(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    held_out = fold(F.col("doc_id"), 5) == 0
    model = language.fit(docs, ~held_out)
    found = language.identified(docs, model).where(fold(F.col("row.doc_id"), 5) == 0)
    found = found.select("row.lang", "lang_pred", "score").collect()
    right = sum(r.lang == r.lang_pred for r in found)
    assert len(found) > 30 and right >= 0.95 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_labels_of_held_out_rows_are_not_used(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    held_out = fold(F.col("doc_id"), 5) == 0
    wrong = docs.withColumn("lang", F.when(held_out, "zz").otherwise(F.col("lang")))
    one, two = language.fit(docs, ~held_out), language.fit(wrong, ~held_out)
    assert one.languages == two.languages and one.words == two.words


def test_unseen_words_back_off_to_shorter_n_grams(spark, rows):
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    scorer = language.Scorer(model)
    assert "kökökukustkä" not in model.words
    assert scorer.predict(["Kökökukustkä"])[0] == ["bb"]
    assert model.word_score("語").tolist() == [0.0] * 3


def test_awkward_rows(spark, rows):
    model = language.fit(spark.createDataFrame(rows + [(900, None, "aa"), (901, "x", None)], SCHEMA))
    odd = [(1, None, "a"), (2, "", "b"), (3, "12 !? _", "c"), (None, "ba be bo", "d")]
    odd += [(5, "ba be bo", "e"), (5, "ba be bo", "e"), (6, "kökä " * 50_000, "f"), (7, "語", "g")]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang_pred string")
    found = [(r["row"].doc_id, r.lang_pred) for r in language.identified(docs, model).collect()]
    assert sorted(found, key=repr) == sorted(
        [(1, "und"), (2, "und"), (3, "und"), (None, "aa"), (5, "aa"), (5, "aa"), (6, "bb"),
         (7, "aa")],
        key=repr,
    )


def test_empty_tables(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    model = language.fit(empty)
    assert model.languages == []
    found = language.identified(spark.createDataFrame(rows[:2], SCHEMA), model).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 2
    assert language.identified(empty, model).collect() == []


def scores_by_dictionaries(rows, texts):
    """Language and score of each text from counts kept in dictionaries."""
    counts, grams = Counter(), Counter()
    for text, lang in {(text, lang) for _, text, lang in rows}:
        counts.update((lang, word) for word in regex.findall(r"\p{L}+", text.lower()))
    for (lang, word), number in counts.items():
        for size in range(1, 6):
            for i in range(len(word) + 3 - size):
                grams[lang, f"_{word}_"[i : i + size]] += number
    langs = sorted({lang for lang, _ in counts})

    def logs(table, least, size_of):
        totals = Counter()
        for (_, item), number in table.items():
            totals[item] += number
        items = [item for item, total in totals.items() if total >= least]
        found = {}
        for size in set(map(size_of, items)):
            some = [item for item in items if size_of(item) == size]
            sums = [sum(table[lang, item] for item in some) + 0.5 * len(some) for lang in langs]
            for item in some:
                of = [math.log((table[g, item] + 0.5) / s) for g, s in zip(langs, sums, strict=True)]
                found[item] = [x - sum(of) / len(of) for x in of]
        return found

    words, pieces = logs(counts, 2, lambda item: 0), logs(grams, 3, len)

    def of_word(word):
        if word in words:
            return words[word]
        for size in range(5, 0, -1):
            whole = f"_{word}_" if size > 1 else word
            known = [whole[i : i + size] for i in range(len(whole) - size + 1)]
            known = [pieces[gram] for gram in known if gram in pieces]
            if known:
                return [sum(of) / len(known) for of in zip(*known, strict=True)]
        return [0.0] * len(langs)

    found = []
    for text in texts:
        parts = [of_word(word) for word in regex.findall(r"\p{L}+", (text or "").lower())]
        if not parts:
            found.append(("und", 0.0))
            continue
        sums = [sum(of) * min(1, 30 / len(parts)) for of in zip(*parts, strict=True)]
        share = 1 / sum(math.exp(x - max(sums)) for x in sums)
        found.append((langs[sums.index(max(sums))], share))
    return found


@pytest.mark.parametrize("most", [5, 100_000])
def test_agrees_with_scores_by_dictionaries(spark, rows, monkeypatch, most):
    monkeypatch.setattr(language, "MOST_CHUNKS", most)
    rng = random.Random(7)
    texts = [text for _, text, _ in rows[:60]]
    texts += [" ".join(rng.sample("ba kust ñokö llbe x½ü ①ba² 12 q_ta é́ 語 Σας".split(), 6)) for _ in range(60)]
    texts += ["½ ² ①", "", None, "12_", "ba½ku"]
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    wanted = scores_by_dictionaries(rows, texts)
    scorer = language.Scorer(model)
    for _ in range(2):
        for start in range(0, len(texts), 10):
            some = [text or "" for text in texts[start : start + 10]]
            for got, want in zip(zip(*scorer.predict(some)), wanted[start : start + 10], strict=True):
                assert got[0] == want[0] and got[1] == pytest.approx(want[1], abs=1e-4)


def test_other_numerals_are_no_letters(spark, rows):
    assert language.words_of("x½ü ①ba² ½²① 1_2") == ["x", "ü", "ba"]
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    docs = spark.createDataFrame([(1, "½ ² ①"), (2, "Ⅷ ⓐ")], "doc_id long, text string")
    found = language.identified(docs, model).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 2


def test_columns_may_clash(spark, rows):
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    docs = spark.createDataFrame([(1, "ba be", 2, 3)], "`a.b` long, text string, row int, score int")
    found = language.identified(docs, model).select("row.*", "lang_pred").collect()
    assert [tuple(r) for r in found] == [(1, "ba be", 2, 3, "aa")]
