"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel of two strings sums, over all subsequences of four letters, the product of their
weights, where an occurrence of span ``s`` weighs ``DECAY ** s``. Inserted letters widen a span and
lower its weight instead of breaking the match. Letters are compared after blanks, signs and look-
alike digits between the letters of a word are undone. A sentence is judged by its words, a
document by its most toxic word; labelled sentences say which words are toxic.

With landmarks ``l`` the machine is ``sum of b_l * K(x, l)``, and as the kernel is a sum over
subsequences, that is one table with a weight for each of them: a word is scored by a lookup per
subsequence, however many landmarks there are.

Not judged: words of one to three letters score the bias alone, whatever the labels say, and
letters outside the alphabet share one code, so that words of equal length in other scripts are
not told apart.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from heapq import nlargest
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.llm.common import Recent, columns, let, pieces, saved

# Bounds of the training sample (labelled rows of each label, as an expectation) and of the model.
ROWS_PER_LABEL = 5_000
LANDMARKS = 512
NEGATIVES = 6_000
ROUNDS = 3
LEAST_CONTEXTS = 3
CHANCE = 1e-5
RATIO = 10.0

ORDER = 4
DECAY = 0.6
WIDEST = 9
LONGEST = 24
RIDGE = 1e-3
PULL = 0.01
CLIPPED = (-3.0, 3.0)
MARGINS = ("first", "second")
PIECE_BYTES = 4_000_000
MOST_CHUNKS = 200_000

# The letters told apart (any other letter is one more), and digits and signs that
# stand in for letters.
ALPHABET = "abcdefghijklmnopqrstuvwxyzßàáâäçèéêëìíîïñòóôöùúûü"
LOOK_ALIKE = str.maketrans("013457@$", "oieastas")
SIZE = len(ALPHABET) + 1
CODES = {letter: code for code, letter in enumerate(ALPHABET)}

SPACED = re.compile(r"(?<!\S)(?:\w[ ]){2,}\w(?!\S)")
LETTER = re.compile(r"[^\W\d_]")
SENTENCE_END = r"[.!?\n\r]+"


def letters_of(chunk: str) -> str:
    """The letters of a chunk in lower case, look-alikes undone if it has letters at all."""
    if chunk.isalpha():
        return chunk.lower()
    if not LETTER.search(chunk):
        return ""
    return "".join(LETTER.findall(chunk.lower().translate(LOOK_ALIKE)))


def chunks_of(text: str) -> list[str]:
    """Words between white space; letters spaced one by one are one word more."""
    chunks = text.split()
    return chunks + [m.replace(" ", "") for m in SPACED.findall(text)]


def _windows(word: str) -> list[str]:
    """The word, or windows of a longer one that overlap by half."""
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def _subsequences(length: int) -> Iterator[tuple[tuple[int, ...], float]]:
    """Places of four letters in order within a span, and their weight."""
    for first in range(length - ORDER + 1):
        for last in range(first + ORDER - 1, min(first + WIDEST, length)):
            for inner in combinations(range(first + 1, last), ORDER - 2):
                yield (first, *inner, last), DECAY ** (last - first + 1)


def _norm(length: int) -> float:
    return float(np.sqrt(sum(w * w for _, w in _subsequences(length)))) or 1.0


NORMS = [_norm(length) for length in range(LONGEST + 1)]


def _numbers(codes: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    """One number for the letters at ``places`` of each row of ``codes``."""
    found = codes[:, places[0]]
    for place in places[1:]:
        found = found * SIZE + codes[:, place]
    return found


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and letter codes of the words that are long enough, by length."""
    lengths = np.array([len(word) for word in words], int)
    for length in sorted(set(lengths[lengths >= ORDER].tolist())):
        places = np.flatnonzero(lengths == length)
        codes = [[CODES.get(c, SIZE - 1) for c in words[p]] for p in places]
        yield places, np.array(codes, np.int32)


class Landmarks:
    """The landmarks' weights of every subsequence that one of them has."""

    def __init__(self, words: list[str]):
        found: dict[int, dict[int, float]] = {}
        for column, word in enumerate(words):
            codes = np.array([[CODES.get(c, SIZE - 1) for c in word]], np.int32)
            for places, weight in _subsequences(len(word)):
                row = found.setdefault(int(_numbers(codes, places)[0]), {})
                row[column] = row.get(column, 0.0) + weight / NORMS[len(word)]
        self.numbers = np.array(sorted(found), np.int64)
        self.rows = np.zeros(SIZE**ORDER, np.int32)
        self.rows[self.numbers] = np.arange(1, len(found) + 1)
        self.table = np.zeros((len(found) + 1, len(words)), np.float32)
        for row, number in enumerate(self.numbers.tolist(), 1):
            for column, weight in found[number].items():
                self.table[row, column] = weight

    def kernel(self, words: list[str]) -> np.ndarray:
        """The kernel of words with the landmarks."""
        found = np.zeros((len(words), self.table.shape[1]), np.float32)
        for places, codes in _by_length(words):
            for start in range(0, len(places), 2_000):
                some = codes[start : start + 2_000]
                total = np.zeros((len(some), self.table.shape[1]), np.float32)
                for at, weight in _subsequences(codes.shape[1]):
                    rows = self.rows[_numbers(some, at)]
                    held = np.flatnonzero(rows)
                    total[held] += np.float32(weight) * self.table[rows[held]]
                found[places[start : start + 2_000]] = total / NORMS[codes.shape[1]]
        return found

    def weights(self, factors: np.ndarray) -> np.ndarray:
        """One weight per subsequence, for a machine with a factor per landmark."""
        found = np.zeros(SIZE**ORDER, np.float32)
        found[self.numbers] = (self.table @ factors.astype(np.float32))[1:]
        return found


@dataclass
class Model:
    """A weight for each subsequence and a bias; ``curve`` makes a score of a document's margins."""

    weights: np.ndarray
    bias: float
    curve: tuple[float, float, float] = (0.0, 0.0, -40.0)

    def words(self, words: list[str]) -> np.ndarray:
        """The machine's output for words of any length (the largest of a long one's windows)."""
        parts = [_windows(word) for word in words]
        flat = [window for windows in parts for window in windows]
        values = np.zeros(len(flat), np.float32)
        for places, codes in _by_length(flat):
            total = np.zeros(len(places), np.float32)
            for at, weight in _subsequences(codes.shape[1]):
                total += np.float32(weight) * self.weights[_numbers(codes, at)]
            values[places] = total / NORMS[codes.shape[1]]
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        return np.maximum.reduceat(values, starts) + self.bias if flat else values


class Scorer:
    """The two largest margins of documents; those of chunks are remembered within a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.recent = Recent(MOST_CHUNKS)

    @classmethod
    def of(cls, model: Model) -> Scorer:
        """The model's scorer, which a reused worker keeps for its later tasks."""
        if not hasattr(model, "scorer"):
            model.scorer = cls(model)
        return model.scorer

    def margins(self, texts: list[str]) -> np.ndarray:
        split = [chunks_of(text) for text in texts]
        new = self.recent.missing(set().union(*split))
        words = [letters_of(chunk) for chunk in new]
        distinct = list(dict.fromkeys(words))
        values = dict(zip(distinct, self.model.words(distinct).tolist(), strict=True))
        self.recent.known.update((chunk, values[word]) for chunk, word in zip(new, words, strict=True))
        margin = self.recent.known.__getitem__
        none = [self.model.bias] * 2
        best = [nlargest(2, [*map(margin, chunks), *none]) for chunks in split]
        return np.array(best, float).reshape(-1, 2)


def _inverse_root(kernel: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(kernel)
    values = np.maximum(values, RIDGE)
    return vectors @ np.diag(values**-0.5) @ vectors.T


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60):
    """A linear machine with squared hinge loss by Newton steps on the rows inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        inside = y * (x @ w) < 1
        xi, wi = x[inside], weight[inside][:, None]
        hessian = xi.T @ (xi * wi) + RIDGE * np.eye(x.shape[1])
        new = np.linalg.solve(hessian, xi.T @ (wi[:, 0] * y[inside]))
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1], float(w[-1])


def _train(toxic: list[str], clean: list[str]) -> Model:
    """A machine that tells toxic words from clean ones, most often seen first.

    After each round the clean words it finds hardest become negatives, and some landmarks.
    """
    marks = toxic[: LANDMARKS * 3 // 4]
    chosen = clean[:: max(1, len(clean) // NEGATIVES)]
    hard = chosen
    for _ in range(ROUNDS):
        held = marks + hard[: LANDMARKS - len(marks)]
        landmarks = Landmarks(held)
        root = _inverse_root(landmarks.kernel(held).astype(float))
        words = toxic + chosen
        x = landmarks.kernel(words) @ root
        y = np.array([1.0] * len(toxic) + [-1.0] * len(chosen))
        weight = np.where(y > 0, 1.0 / len(toxic), 1.0 / len(chosen)) * len(words)
        w, bias = _svm(x, y, weight)
        model = Model(landmarks.weights(root @ w), bias)
        margins = model.words(clean)
        hard = [clean[i] for i in np.argsort(-margins, kind="stable")[: NEGATIVES // 2]]
        chosen = list(dict.fromkeys(hard + chosen))
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    training: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    rows_per_label: int = ROWS_PER_LABEL,
) -> Model:
    """A model from a bounded sample of labelled rows for which ``training`` holds on the id.

    Rows with a null id or label are not used. The sentences of the sample are counted in Spark; the
    driver gets the sample's words with two counts each, and a margin per sampled row. Without
    both labels or without a word that tells them apart, every score is 0.
    """
    rows = labels.select(
        quoted(id_column).alias("id"), (quoted(label_column) == 1).alias("toxic")
    ).where("id is not null and toxic is not null")
    if training is not None:
        rows = rows.where(training)
    rows = rows.distinct()
    totals = rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("total"))
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    rows = rows.join(F.broadcast(totals), "toxic")
    rows = rows.where(share * F.col("total") < rows_per_label).select("id", "toxic")
    texts = docs.select(
        quoted(id_column).alias("id"), quoted(text_column).cast("string").alias("text")
    ).where("text is not null")
    # The sample is bounded by its parameter, so its ids can go to every task.
    sample = saved(texts.join(F.broadcast(rows), "id").distinct(), "toxicity-sample")
    toxic, clean = _labelled_words(sample)
    if not toxic or not clean:
        return Model(np.zeros(SIZE**ORDER, np.float32), -1.0)
    return _calibrated(sample, _train(toxic, clean))


def _labelled_words(sample: DataFrame) -> tuple[list[str], list[str]]:
    """Words of toxic sentences that clean ones lack, and words of clean sentences, by frequency.

    What counts is after how many different words a word stands in sentences of either label, so a
    passage that is copied often, even with changes, says no more than once what is toxic.
    """
    sentences = sample.select(
        "toxic", F.explode(F.split(F.lower("text"), SENTENCE_END)).alias("sentence")
    ).distinct()
    words = F.regexp_extract_all("sentence", F.lit(r"[\p{L}]+"), F.lit(0))
    contexts = let(
        words,
        lambda w: F.zip_with(
            F.concat(F.array(F.lit("")), w), w, lambda x, y: F.struct(x.alias("x"), y.alias("word"))
        ),
    )
    contexts = sentences.select("toxic", F.inline(contexts)).where("word is not null").distinct()
    counts = contexts.groupBy("word").agg(
        F.count_if("toxic").alias("in_toxic"), F.count_if(~F.col("toxic")).alias("in_clean")
    )
    number = contexts.agg(
        F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("clean")
    ).first()
    lift = F.col("in_toxic") / max(number["toxic"], 1)
    base = (F.col("in_clean") + 0.5) / max(number["clean"], 1)
    usable = counts.where(F.char_length("word").between(3, LONGEST))
    # In as many contexts as chance hardly makes all toxic, at the share of toxic ones.
    share = (number["toxic"] + 1) / (number["toxic"] + number["clean"] + 2)
    least = max(LEAST_CONTEXTS, math.ceil(math.log(CHANCE) / math.log(share)))
    toxic = usable.where((F.col("in_toxic") >= least) & (lift >= RATIO * base))
    toxic = toxic.orderBy(F.desc("in_toxic"), "word").select("word")
    clean = usable.where("in_clean > 0").where(~(lift >= RATIO * base))
    clean = clean.orderBy(F.desc("in_clean"), "word").select("word")
    return toxic.toArrow()["word"].to_pylist(), clean.toArrow()["word"].to_pylist()


def _calibrated(sample: DataFrame, model: Model) -> Model:
    """The model with the logistic curve that fits the sampled documents' margins to their labels."""
    found = _margins(sample, model).join(sample.select("id", "toxic"), "id")
    table = found.select("first", "second", F.col("toxic").cast("double").alias("y")).toArrow()
    x = np.column_stack([table["first"], table["second"]]).astype(float).clip(*CLIPPED)
    x, y = np.hstack([x, np.ones((len(x), 1))]), np.asarray(table["y"], float)

    def cost(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + PULL * (w[:2] @ w[:2]))

    # Newton steps, halved where they overshoot; a pull keeps the curve finite where the margins
    # separate the labels.
    w = np.zeros(3)
    pull = 2 * PULL * np.array([1.0, 1.0, 1e-6])
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (p - y) + pull * w
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(pull), slope)
        while cost(w - step) > cost(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return replace(model, curve=tuple(map(float, w)))


def _margins(narrow: DataFrame, model: Model) -> DataFrame:
    """``id`` and the two largest margins, ``first`` and ``second``, of rows with ``id``, ``text``."""
    shared = narrow.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer.of(shared.value)
        for piece, texts in pieces(batches, PIECE_BYTES):
            margins = scorer.margins([text or "" for text in texts])
            first, second = (pa.array(margins[:, i], pa.float64()) for i in (0, 1))
            yield columns(id=piece["id"], first=first, second=second)

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.select("id", "text").mapInArrow(judge, f"id {kind}, first double, second double")


def toxicity(
    docs: DataFrame,
    model: Model,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = 0.3,
) -> DataFrame:
    """Id, ``score``, ``predicted`` for every row of ``docs``, from the text alone.

    ``score`` is from 0 to 1 and higher for toxic texts; ``predicted`` is 1 from ``threshold`` on.
    Null and empty texts and texts without words get the score of a text without a toxic word. Null
    and repeated ids and equal rows are rows like others; extra columns are left out.
    """
    narrow = docs.select(
        quoted(id_column).alias("id"), quoted(text_column).cast("string").alias("text")
    )
    first, second = (F.least(F.greatest(c, F.lit(CLIPPED[0])), F.lit(CLIPPED[1])) for c in MARGINS)
    power = model.curve[0] * first + model.curve[1] * second + model.curve[2]
    score = 1 / (1 + F.exp(-F.least(F.greatest(power, F.lit(-40.0)), F.lit(40.0))))
    return _margins(narrow, model).select(
        F.col("id").alias(id_column),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
    )
