"""Ranked lexical search of few items in many documents, reversed: the index is of the items.

An inverted index over the items' terms is broadcast, within a size; every document's term counts
are streamed through it once, and each task keeps a bounded heap of the best documents of each item.
The heaps are merged in two rounds.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.llm.common import columns, lists, pieces, saved, text_bytes

BEST = 10
# Items whose texts are larger together are searched in several blocks, each in a pass of its own.
MOST_ITEM_BYTES = 16_000_000
# Scores, and entries of the index, held at once while documents are streamed through it.
MOST_CELLS = 1_000_000
MERGES = 256
NO_ID = np.iinfo(np.int64).max

# A to Z in lower case; ASCII that is neither letter nor digit parts terms.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Terms of ASCII letters, digits and all other characters beyond ASCII; null has none."""
    return text_bytes(text).translate(TERM_BYTES).split()


def _term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``id``, ``n`` and the numbers and counts of the vocabulary's terms, a row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for piece, texts in pieces(batches):
            totals, terms, times = [], [], []
            for text in texts:
                split = terms_of(text)
                totals.append(len(split))
                known = {n: c for t, c in Counter(split).items() if (n := number(t)) is not None}
                terms.append(np.fromiter(known, np.int32, len(known)))
                times.append(np.fromiter(known.values(), np.int64, len(known)))
            yield columns(
                id=piece["id"],
                n=pa.array(totals, pa.int64()),
                terms=lists(terms, pa.int32()),
                times=lists(times, pa.int64()),
            )

    return docs.mapInArrow(counted, "id long, n long, terms array<int>, times array<long>")


@dataclass
class Index:
    """For each term its weight and the items that hold it: ``items[starts[t] : starts[t + 1]]``."""

    weights: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    n_items: int
    documents: int
    words: int

    def portions(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Documents in portions whose scores and index entries are within a bound, or one alone."""
        term, ends = _flat(batch["terms"]), _ends(batch["terms"])
        entries = np.append(0, np.cumsum(self.starts[term + 1] - self.starts[term]))[ends]
        cells = np.diff(entries, prepend=0) + self.n_items
        start, total = 0, 0
        for row, size in enumerate(cells.tolist()):
            if row > start and total + size > MOST_CELLS:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)

    def scores(self, docs: pa.RecordBatch) -> np.ndarray:
        """Scores of all items, a row per document."""
        n, term, tf = docs["n"].to_numpy(), _flat(docs["terms"]), _flat(docs["times"])
        rows = np.repeat(np.arange(len(n)), np.diff(_ends(docs["terms"]), prepend=0))
        m = 10 + 90 * n * self.documents // self.words
        part = self.weights[term] * (1_000_000_000 * tf // (1_000 * tf + 8 * m[rows]))
        sizes = self.starts[term + 1] - self.starts[term]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        cells = np.repeat(rows * self.n_items, sizes)
        cells += self.items[places + np.repeat(self.starts[term], sizes)]
        found = np.zeros(len(n) * self.n_items, np.int64)
        np.add.at(found, cells, np.repeat(part, sizes))
        return found.reshape(len(n), self.n_items)


class Heaps:
    """The ``best`` documents of each item: highest score first, then smallest id."""

    def __init__(self, n_items: int, best: int):
        self.best = best
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(n_items)]
        self.floor = np.ones(n_items, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """Documents with their scores; only those that may be among an item's best are looked at."""
        floor = self.floor
        if len(ids) > self.best:
            cut = len(ids) - self.best
            floor = np.maximum(floor, np.partition(scores, cut, axis=0)[cut])
        rows, items = np.nonzero(scores >= floor)
        found = zip(items.tolist(), scores[rows, items].tolist(), ids[rows].tolist(), strict=True)
        for item, score, key in found:
            heap = self.heaps[item]
            if len(heap) < self.best:
                heapq.heappush(heap, (score, -key))
            else:
                heapq.heappushpop(heap, (score, -key))
            if len(heap) == self.best:
                self.floor[item] = heap[0][0]

    def rows(self) -> pa.RecordBatch:
        flat = [(item, s, -k) for item, heap in enumerate(self.heaps) for s, k in heap]
        return columns(
            item=pa.array([row[0] for row in flat], pa.int32()),
            score=pa.array([row[1] for row in flat], pa.int64()),
            id=pa.array([None if row[2] == NO_ID else row[2] for row in flat], pa.int64()),
        )


def _blocks(items: DataFrame, most_bytes: int) -> list[DataFrame]:
    """Items in blocks of about ``most_bytes`` of text each; rows are dealt by their content."""
    held = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = max(1, -(-held // most_bytes))
    if number == 1:
        return [items]
    block = F.pmod(F.xxhash64("id", "text"), F.lit(number))
    return [items.where(block == n) for n in range(number)]


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    most_item_bytes: int = MOST_ITEM_BYTES,
) -> DataFrame:
    """The ``best`` documents of each item: item id, ``rank`` from 1, id, ``score`` above 0.

    Terms are weighted by how few documents hold them, and saturate with their count in a document
    relative to its length; all is integer arithmetic but the logarithm, so results are exact. Equal
    scores rank by ascending id, documents without id last.

    Every row of ``docs`` is a document and every row of ``items`` an item, repeated ids and equal
    rows too. Null or empty texts have no terms: such documents are not found, such items find
    nothing, as all do in an empty table. Extra columns are left out. Ids of documents are integers.

    Counts are of all documents. The texts are split once; what is written is the counts of the
    items' terms in each document.
    """
    narrow = docs.select(
        quoted(id_column).cast("long").alias("id"), quoted(text_column).cast("string").alias("text")
    )
    asked = items.select(
        quoted(item_column).alias("id"), quoted(item_text_column).cast("string").alias("text")
    )
    found = None
    for block in _blocks(asked, most_item_bytes):
        part = _search(narrow, block, best)
        found = part if found is None else found.unionByName(part)
    return found.select(
        F.col("item").alias(item_column), "rank", F.col("id").alias(id_column), "score"
    )


def _search(docs: DataFrame, items: DataFrame, best: int) -> DataFrame:
    """One block of items, whose texts the driver holds, against all documents."""
    spark = docs.sparkSession
    table = items.toArrow()
    split = [sorted(set(terms_of(text))) for text in table["text"].to_pylist()]
    vocabulary = {term: n for n, term in enumerate(sorted(set().union(*split)))}
    counts = saved(_term_counts(docs, vocabulary), "term-counts")
    totals = counts.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").count()
    index = _index(split, vocabulary, held.toArrow(), totals[0], totals[1] or 0)
    shared = spark.sparkContext.broadcast(index)

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        heaps = Heaps(index.n_items, best)
        for batch in batches:
            for some in index.portions(batch):
                heaps.add(some["id"].fill_null(NO_ID).to_numpy(), index.scores(some))
        found = heaps.rows()
        task = TaskContext.get().partitionId()
        yield found.append_column("task", pa.array([task] * found.num_rows, pa.int32()))

    # Only documents with one of the terms can score.
    some = counts.where(F.size("terms") > 0)
    heaps = some.mapInArrow(streamed, "item int, score long, id long, task int")
    merge = F.pmod("task", F.lit(MERGES)).alias("merge")
    first = _best(heaps.select("item", "score", "id", merge), ["item", "merge"], best)
    last = _best(first.drop("rank"), ["item"], best)
    ids = pa.table({"item": pa.array(range(len(split)), pa.int32()), "key": table["id"]})
    ids = F.broadcast(spark.createDataFrame(ids))
    return last.join(ids, "item").select(F.col("key").alias("item"), "rank", "id", "score")


def _flat(values: pa.ListArray) -> np.ndarray:
    return values.flatten().to_numpy()


def _ends(values: pa.ListArray) -> np.ndarray:
    """Where each list ends among the items of all."""
    return np.cumsum(values.value_lengths().to_numpy())


def _best(rows: DataFrame, by: list[str], best: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where(F.col("rank") <= best)


def _index(
    split: list[list[bytes]],
    vocabulary: dict[bytes, int],
    held: pa.Table,
    documents: int,
    words: int,
) -> Index:
    """The inverted index of the items' terms; ``held`` has in how many documents each term is."""
    df = np.zeros(len(vocabulary), np.int64)
    df[held["term"].to_numpy()] = held["count"].to_numpy()
    weights = np.floor(1_000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
    terms = np.array([vocabulary[t] for listed in split for t in listed], np.int64)
    items = np.repeat(np.arange(len(split)), [len(listed) for listed in split])
    order = np.argsort(terms, kind="stable")
    starts = np.zeros(len(vocabulary) + 1, np.int64)
    np.cumsum(np.bincount(terms, minlength=len(vocabulary)), out=starts[1:])
    return Index(weights, starts, items[order], len(split), documents, max(words, 1))
