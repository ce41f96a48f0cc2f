"""Language of a text: known words by their log frequency in each language, unseen words by the
longest of their character n-grams that are known."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from targetlens.functions.flags import quoted
from targetlens.llm.common import columns, pieces, saved

# Bounds of the model: labelled rows per language (as an expectation), the smallest counts of a
# word and of an n-gram, the longest n-gram.
ROWS_PER_LANGUAGE = 2_000
LEAST_WORD = 2
LEAST_GRAM = 3
LONGEST_GRAM = 5
SMOOTHING = 0.5
MOST_EVIDENCE = 30.0
UNKNOWN = "und"
EDGE = "_"
WORD = re.compile(r"[^\W\d_]+")
PIECE_BYTES = 1_000_000
MOST_CHUNKS = 200_000


def words_of(text: str) -> list[str]:
    """Runs of letters; the pattern alone would take other numerals than digits for letters."""
    found = []
    for run in WORD.findall(text):
        if run.isalpha():
            found.append(run)
        else:
            found += "".join([c if c.isalpha() else " " for c in run]).split()
    return found


@dataclass
class Model:
    """Languages, and the rows of ``scores`` (log frequency per language) of words and n-grams."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray

    def word_score(self, word: str) -> np.ndarray:
        """A known word's row; else the mean row of its longest known n-grams; else zeros."""
        row = self.words.get(word)
        if row is not None:
            return self.scores[row]
        edged = EDGE + word + EDGE
        for size in range(LONGEST_GRAM, 0, -1):
            text = edged if size > 1 else word
            grams = (text[i : i + size] for i in range(len(text) - size + 1))
            rows = [r for r in map(self.grams.get, grams) if r is not None]
            if rows:
                return self.scores[rows].mean(axis=0)
        return np.zeros(len(self.languages), np.float32)


class Scorer:
    """Scores of chunks between white space, remembered within a bound.

    A chunk's scores over its words, and their number, are a row of a table. When the table is full
    it is kept while the next one fills, so chunks in use are copied and not worked out again.
    """

    @classmethod
    def of(cls, model: Model) -> Scorer:
        """The model's scorer, which a reused worker keeps for its later tasks."""
        if not hasattr(model, "scorer"):
            model.scorer = cls(model)
        return model.scorer

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.before: dict[str, int] = {}
        self.table = self.old_table = np.zeros((0, len(model.languages) + 1), np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text; both are ``und`` and 0 without letters or languages."""
        # Words hold letters only, so signs may part them; this leaves fewer different chunks.
        split = [text.lower().replace(",", " ").replace(".", " ").split() for text in texts]
        self._learn(set().union(*split))
        found = [self._best(chunks) for chunks in split]
        return [language for language, _ in found], [score for _, score in found]

    def _learn(self, chunks: set[str]) -> None:
        """Rows for the chunks that have none."""
        if len(self.known) > MOST_CHUNKS:
            self.before, self.old_table = self.known, self.table[: len(self.known)]
            self.known, self.table = {}, self.table[:0]
        missing = list(chunks.difference(self.known))
        first = len(self.known)
        if first + len(missing) > len(self.table):
            rows = max(first + len(missing), min(2 * len(self.table), MOST_CHUNKS))
            table = np.zeros((rows, self.table.shape[1]), np.float32)
            table[:first] = self.table[:first]
            self.table = table
        score = self.model.word_score
        for number, chunk in enumerate(missing, first):
            old = self.before.get(chunk)
            if old is not None:
                self.table[number] = self.old_table[old]
                continue
            row = self.table[number]
            for word in words_of(chunk):
                row[:-1] += score(word)
                row[-1] += 1
        self.known.update(zip(missing, range(first, first + len(missing)), strict=True))

    def _best(self, chunks: list[str]) -> tuple[str, float]:
        if not chunks or not self.model.languages:
            return UNKNOWN, 0.0
        rows = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        total = self.table[rows].sum(axis=0, dtype=np.float64)
        words = total[-1]
        if not words:
            return UNKNOWN, 0.0
        evidence = total[:-1] * min(1.0, MOST_EVIDENCE / words)
        best = int(np.argmax(evidence))
        share = 1.0 / np.exp(evidence - evidence[best]).sum()
        return self.model.languages[best], float(share)


def _sample(docs: DataFrame, rows_per_language: int) -> DataFrame:
    """``text``, ``lang`` of about ``rows_per_language`` rows per language, the same in each run."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    totals = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("total"))
    share = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) / (1 << 20)
    chosen = labelled.join(F.broadcast(totals), "lang")
    chosen = chosen.where(share * F.col("total") < rows_per_language)
    return chosen.select("text", "lang").distinct()


def _grams(word: Column) -> Column:
    edged = F.concat(F.lit(EDGE), word, F.lit(EDGE))

    def of_size(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.char_length(edged) - size + 1)
        grams = F.transform(starts, lambda i: F.substring(edged, i, F.lit(size)))
        return F.when(F.char_length(edged) >= size, grams).otherwise(F.array())

    return F.concat(*[of_size(size) for size in range(1, LONGEST_GRAM + 1)])


def fit(
    docs: DataFrame,
    training: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> Model:
    """A model from a bounded sample of the rows for which ``training`` holds and a language is set.

    Words and n-grams are counted in Spark; the driver gets the counts of the sample only.
    """
    rows = docs if training is None else docs.where(training)
    rows = rows.select(
        quoted(id_column).alias("id"),
        quoted(text_column).cast("string").alias("text"),
        quoted(lang_column).cast("string").alias("lang"),
    )
    sample = saved(_sample(rows, rows_per_language), "language-sample")
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0))
    words = sample.select("lang", F.explode(words).alias("item"))
    words = saved(words.groupBy("lang", "item").count(), "language-words")
    grams = words.select("lang", F.explode(_grams(F.col("item"))).alias("item"), "count")
    grams = grams.groupBy("lang", "item").agg(F.sum("count").alias("count"))
    word_counts = _common(words, LEAST_WORD)
    gram_counts = _common(grams, LEAST_GRAM)
    languages = sorted({row["lang"] for row in words.select("lang").distinct().collect()})
    known_words, word_scores = _scores(word_counts, languages)
    known_grams, gram_scores = _scores(gram_counts, languages, by_size=True)
    shifted = {gram: row + len(word_scores) for gram, row in known_grams.items()}
    scores = np.concatenate([word_scores, gram_scores]).astype(np.float32)
    return Model(languages, known_words, shifted, scores)


def _common(counts: DataFrame, least: int):
    """Counts of the items that are frequent enough over all languages, as a local table."""
    totals = counts.groupBy("item").agg(
        F.sum("count").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("lang", "count"))).alias("of"),
    )
    return totals.where(F.col("total") >= least).select("item", "of").toArrow()


def _scores(table: pa.Table, languages: list[str], by_size: bool = False):
    """Each item's row, and the rows: smoothed log frequency in each language.

    N-grams are normalised among those of their size.
    """
    items = table["item"].to_pylist()
    place = {language: i for i, language in enumerate(languages)}
    counts = np.zeros((len(items), len(languages)))
    for row, of in enumerate(table["of"].to_pylist()):
        for language, count in of:
            counts[row, place[language]] = count
    sizes = np.array([len(item) if by_size else 0 for item in items], int)
    scores = np.zeros_like(counts)
    for size in set(sizes.tolist()):
        some = sizes == size
        totals = counts[some].sum(axis=0) + SMOOTHING * some.sum()
        scores[some] = np.log((counts[some] + SMOOTHING) / totals)
    # Only differences between languages matter; centred rows keep sums small.
    if len(languages):
        scores -= scores.mean(axis=1, keepdims=True)
    return {item: row for row, item in enumerate(items)}, scores


def identified(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``lang_pred``, ``score``, from the text alone.

    ``lang_pred`` is one of the model's languages; null texts, texts without letters, and all texts
    where the model has no language are ``und`` with score 0. ``score`` is the share of the best
    language among all, from 0 to 1. Ties go to the first language by name. One row in, one row
    out, whatever ids they have and whether they are equal; further columns stay in ``row``, so
    that no name can clash. The text column is of strings.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_column)

    def text_of(batch: pa.RecordBatch) -> pa.Array:
        return batch["row"].field(place)

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer.of(shared.value)
        for piece, texts in pieces(batches, PIECE_BYTES, text_of):
            languages, scores = scorer.predict([text or "" for text in texts])
            yield columns(
                row=piece["row"],
                lang_pred=pa.array(languages, pa.string()),
                score=pa.array(scores, pa.float64()),
            )

    # The text goes to the task once, within its row.
    every = F.struct(*[quoted(name) for name in docs.columns]).alias("row")
    fields = [
        T.StructField("row", docs.schema, True),
        T.StructField("lang_pred", T.StringType(), True),
        T.StructField("score", T.DoubleType(), True),
    ]
    return docs.select(every).mapInArrow(identify, T.StructType(fields))
