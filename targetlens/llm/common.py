"""What several of these operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens.storage import fresh_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MOST_HASHES = 150_000


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plainly_named(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns ``c0``, ``c1`` and so on, and these names by those they had.

    Operators that add columns of their own meet no clashing or awkward names in it.
    """
    names = {name: f"c{place}" for place, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def fold(id_column: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text; a null id is in fold 0."""
    return F.coalesce(F.crc32(id_column.cast("string")) % folds, F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case and no other letter changed.

    ``lower`` is much faster than ``translate`` and the same where all characters are ASCII.
    """
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where a lambda inside uses it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_bytes(text: str | None) -> bytes:
    """UTF-8 of a text; null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A to Z in lower case; null has none."""
    return text_bytes(text).lower().split()


class WordHashes(dict):
    """64-bit hashes of words, remembered; what is remembered is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_HASHES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Recent:
    """Values of the keys used last: a full generation is kept until the next one is full too."""

    def __init__(self, most: int, always: dict | None = None):
        self.most, self.always = most, always or {}
        self.known, self.before = dict(self.always), {}

    def missing(self, keys: set[str]) -> list[str]:
        """The keys without a value; those with one from the generation before keep it."""
        if len(self.known) > self.most + len(self.always):
            self.known, self.before = dict(self.always), self.known
        known, before, left = self.known, self.before, []
        for key in keys.difference(known):
            value = before.get(key)
            if value is None:
                left.append(key)
            else:
                known[key] = value
        return left


def pieces(
    batches: Iterable[pa.RecordBatch],
    most_bytes: int = 4_000_000,
    text_of: Callable[[pa.RecordBatch], pa.Array] = lambda batch: batch.column("text"),
) -> Iterable:
    """Arrow batches with texts, cut so that the texts of one stay within a size.

    A longer text is a piece of its own. Gives each piece and its texts.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(text_of(batch)), 0).to_pylist()
        start, total = 0, 0
        for row, size in enumerate(sizes):
            if row > start and total + size > most_bytes:
                piece = batch.slice(start, row - start)
                yield piece, text_of(piece).to_pylist()
                start, total = row, 0
            total += size
        if start < len(sizes):
            piece = batch.slice(start)
            yield piece, text_of(piece).to_pylist()


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrays as one Arrow list column."""
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def columns(**named) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(named)
