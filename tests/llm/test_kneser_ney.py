"""The model against counts in dictionaries, its files, and awkward rows."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from targetlens.llm import kneser_ney as kn

SCHEMA = "doc_id long, text string, score string"


def sequence(text):
    return ["<s>", *[w.decode() for w in (text or "").encode().lower().split()], "</s>"]


class BruteForce:
    def __init__(self, texts):
        runs = [sequence(t) for t in texts]
        self.count = Counter(w for r in runs for w in r[1:])
        self.pairs = Counter(p for r in runs for p in zip(r, r[1:]))
        self.after = Counter(v for _, v in self.pairs)
        self.context, self.kinds = Counter(), defaultdict(lambda: [0, 0, 0, 0])
        for (u, _), n in self.pairs.items():
            self.context[u] += n
            self.kinds[u][min(n, 3)] += 1
        self.tokens, self.words = sum(self.count.values()), len(self.count)
        self.d, self.e = self.discounts(self.pairs), self.discounts(self.after)

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        if not all(n[i] for i in (1, 2, 3, 4)):
            return [0, 0.5, 0.75, 1.0]
        y = n[1] / (n[1] + 2 * n[2])
        raw = [i - (i + 1) * y * n[i + 1] / n[i] for i in (1, 2, 3)]
        return [0, *(min(max(x, 0.0), i) for i, x in enumerate(raw, 1))]

    def lower(self, v):
        if not self.pairs:
            return 1 / (self.words + 1)
        share = sum(self.e[min(n, 3)] for n in self.after.values()) / len(self.pairs)
        n = self.after[v]
        return (n - self.e[min(n, 3)]) / len(self.pairs) + share / (self.words + 1)

    def given(self, u, v):
        if not self.context[u]:
            return self.lower(v)
        n = self.pairs[u, v]
        rest = sum(self.d[i] * self.kinds[u][i] for i in (1, 2, 3))
        return (n - self.d[min(n, 3)] + rest * self.lower(v)) / self.context[u]

    def row(self, text):
        run = sequence(text)
        total = self.tokens + self.words + 1
        base = sum(math.log10((self.count[w] + 1) / total) for w in run[1:])
        score = sum(math.log10(self.given(u, v)) for u, v in zip(run, run[1:]))
        return len(run) - 1, sum(self.count[w] > 0 for w in run[1:]), self.tokens, base, score


def corpus():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "Ab"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 50)))) for i in range(80)]
    rows += [(80, None), (81, ""), (None, "w1 w2"), (82, "w1 W1 \n w1"), (82, "w1 W1 \n w1")]
    return rows + [(84, "w3 w4 " * 20_000), (85, "unseen words only"), (86, "w1 unseen w2")]


def compared(spark, rows, training):
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(4)
    model = kn.fit(docs, training)
    taught = [r.text for r in docs.where(training).collect()]
    wanted = BruteForce(taught)
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    found = sorted(([r.doc_id, *(r[n] for n in names)] for r in kn.scored(docs, model).collect()), key=repr)
    right = sorted(([k, *wanted.row(t)] for k, t in rows), key=repr)
    for one, two in zip(found, right, strict=True):
        assert one[:4] == two[:4]
        assert one[4:] == pytest.approx(two[4:], rel=1e-9, abs=1e-9)
    return wanted


def test_agrees_with_dictionaries(spark):
    wanted = compared(spark, corpus(), F.coalesce(F.col("doc_id") < 83, F.lit(True)))
    mass = sum(wanted.given("w1", v) for v in wanted.count) + wanted.given("w1", "unseen")
    assert mass == pytest.approx(1.0)


def test_agrees_in_many_small_parts(spark, monkeypatch):
    monkeypatch.setattr(kn, "FLUSH_TOKENS", 50)
    monkeypatch.setattr(kn, "PIECE_BYTES", 200)
    compared(spark, corpus(), F.lit(True))


def test_without_training_rows(spark):
    compared(spark, corpus()[:6], F.lit(False))
    docs = spark.createDataFrame([], SCHEMA)
    assert kn.scored(docs, kn.fit(docs)).collect() == []


def test_files_hold_sorted_hashes(spark):
    docs = spark.createDataFrame([(*r, "x") for r in corpus()], SCHEMA)
    pairs, words = kn._mapped(kn.fit(docs))
    for first, stops, second, counts in pairs.values():
        assert (first[1:] > first[:-1]).all() and (counts > 0).all()
        for a, b in zip(stops[:-1], stops[1:]):
            assert (second[a + 1 : b] > second[a : b - 1]).all()
    assert all((known[1:] > known[:-1]).all() for known, _ in words.values())


def test_missing_files_are_an_error(spark, tmp_path):
    docs = spark.createDataFrame([(*r, "x") for r in corpus()], SCHEMA)
    model = kn.fit(docs, path=str(tmp_path / "model"))
    file = sorted((tmp_path / "model").glob("pairs/bucket=*/part-*"))[3]
    file.rename(tmp_path / "elsewhere")
    with pytest.raises(Exception, match="files of the model"):
        kn.scored(docs, model).collect()


def test_few_files_are_mapped_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([(*r, "x") for r in corpus()], SCHEMA)
    model = kn.fit(docs)
    texts = [text for _, text in corpus()]
    wanted = kn.text_scores(model, texts, kn.WordHashes())
    monkeypatch.setattr(kn, "MOST_MAPS", 2)
    kn._mapped.cache_clear()
    found = kn.text_scores(model, texts, kn.WordHashes())
    assert all((found[name] == wanted[name]).all() for name in wanted)
    assert max(len(files.maps) for files in kn._mapped(model)) == 2 < len(kn._mapped(model)[0])
    kn._mapped.cache_clear()
