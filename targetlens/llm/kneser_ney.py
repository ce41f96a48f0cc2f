"""Interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted hash arrays, read
through memory maps by the tasks that score.

Word pairs are counted in each task, packed by bucket and merged bucket by bucket; a bucket takes
its bits from both words, so the pairs of a very frequent word are spread. A bucket's file holds
the hashes of its first words, sorted, and for each the sorted hashes of its second words with
their counts. From these files come the words' files: how often a word occurs, how many second
words it has once, twice and more often, and after how many words it occurs. Both kinds of file are
plain arrays, so a task maps them and touches only the pages that its texts need.
"""

from __future__ import annotations

import glob
import os
from collections import OrderedDict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.llm.common import WordHashes, ascii_words, columns, pieces
from targetlens.storage import fresh_path

# A bucket is for about so many bytes of training text; the bounds of its number of bits.
BUCKET_BYTES = 4_000_000
FEWEST_BITS, MOST_BITS = 5, 16
FLUSH_TOKENS = 3_000_000
PIECE_BYTES = 8_000_000
MOST_MAPS = 128

# Words never hold blanks, so these cannot be words.
START = np.uint64(xxhash.xxh3_64_intdigest(b" start "))
END = np.uint64(xxhash.xxh3_64_intdigest(b" end "))
HEADER = 8  # longs at the start of a file: rows, pairs or words seen 1 to 4 times, their total


def _top(values: np.ndarray, bits: int) -> np.ndarray:
    return (values >> np.uint64(64 - bits)).astype(np.int64)


def pair_buckets(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of pairs: more bits of the second word, so that a frequent first one is spread."""
    of_first = 3 * bits // 8
    of_second = bits - of_first
    return (_top(first, of_first) << of_second) | _top(second, of_second)


def bucket_bits(texts: DataFrame) -> int:
    """Enough bits for buckets of a bounded size, by the bytes of the texts."""
    total = texts.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    return min(max((total // BUCKET_BYTES).bit_length(), FEWEST_BITS), MOST_BITS)


def _joined(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, each from a multiple of eight bytes on."""
    parts = []
    for array in arrays:
        data = array.tobytes()
        parts.append(data + b"\0" * (-len(data) % 8))
    return b"".join(parts)


class _Reader:
    """Arrays out of a buffer that ``_joined`` made."""

    def __init__(self, buffer):
        self.buffer, self.at = buffer, 0

    def take(self, kind: str, count: int) -> np.ndarray:
        found = np.frombuffer(self.buffer, kind, count, self.at)
        self.at += -(-found.nbytes // 8) * 8
        return found


def _times(counts: np.ndarray) -> list[int]:
    """How many of ``counts`` are 1, 2, 3, 4."""
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


def pack_pairs(first: np.ndarray, second: np.ndarray, counts: np.ndarray) -> bytes:
    """Pairs sorted by first, then second word."""
    words, starts = np.unique(first, return_index=True)
    stops = np.append(starts, len(first)).astype(np.int64)
    header = [len(words), len(first), *_times(counts), int(counts.sum()), 0]
    counts = counts.astype("<u4")
    return _joined(np.array(header, "<i8"), words, stops.astype("<u4"), second, counts)


def unpack_pairs(buffer) -> tuple[np.ndarray, ...]:
    """First words, where the second words of each start and stop, second words, counts."""
    reader = _Reader(buffer)
    header = reader.take("<i8", HEADER)
    rows, pairs = int(header[0]), int(header[1])
    words, stops = reader.take("<u8", rows), reader.take("<u4", rows + 1)
    return words, stops, reader.take("<u8", pairs), reader.take("<u4", pairs)


def _summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal keys (the first array is the most significant) with their counts added."""
    if not len(counts):
        return keys, counts
    order = np.lexsort(keys[::-1])
    keys = [key[order] for key in keys]
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    return [key[starts] for key in keys], np.add.reduceat(counts[order], starts, axis=0)


def _sequences(texts: list[str | None], words: WordHashes) -> list[np.ndarray]:
    """Start, words and end of each text, as hashes."""
    found = []
    for text in texts:
        hashes = words.of(ascii_words(text))
        found.append(np.concatenate([[START], hashes, [END]]).astype(np.uint64))
    return found


def _pairs_of(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct words, the place of each token among them, and which tokens start a text."""
    tokens = np.concatenate(sequences)
    words, places = np.unique(tokens, return_inverse=True)
    lengths = np.array([len(s) for s in sequences])
    return words, places, np.cumsum(lengths) - lengths


def _counter(bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = WordHashes(), [], 0
        for _, texts in pieces(batches, PIECE_BYTES):
            sequences = _sequences(texts, words)
            held += sequences
            size += sum(map(len, sequences))
            if size >= FLUSH_TOKENS:
                yield _flushed(held, bits)
                held, size = [], 0
        if held:
            yield _flushed(held, bits)

    return count


def _flushed(sequences: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """The counted pairs of some texts, a row per bucket. The list is emptied on the way."""
    words, places, starts = _pairs_of(sequences)
    sequences.clear()
    pairs = places[:-1] * len(words) + places[1:]
    del places
    # Not from one text's end to the next one's start.
    pairs, counts = np.unique(np.delete(pairs, starts[1:] - 1), return_counts=True)
    first = words[pairs // len(words)]
    second = words[pairs % len(words)]
    del pairs
    return _by_bucket(pair_buckets(first, second, bits), first, second, counts)


def _by_bucket(buckets: np.ndarray, first, second, counts) -> pa.RecordBatch:
    order = np.argsort(buckets.astype(np.uint16), kind="stable")
    names, starts = np.unique(buckets[order], return_index=True)
    stops = np.append(starts[1:], len(order))
    data = []
    for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
        some = order[start:stop]
        data.append(pack_pairs(first[some], second[some], counts[some]))
    return columns(bucket=pa.array(names, pa.int32()), data=pa.array(data, pa.binary()))


def _merge_pairs(table: pa.Table) -> pa.Table:
    parts = [unpack_pairs(data.as_buffer()) for data in table["data"]]
    first = np.concatenate([np.repeat(w, np.diff(s.astype(np.int64))) for w, s, _, _ in parts])
    second = np.concatenate([v for _, _, v, _ in parts])
    counts = np.concatenate([c for _, _, _, c in parts]).astype(np.int64)
    (first, second), counts = _summed([first, second], counts)
    return _one_row(table, pack_pairs(first, second, counts))


def _one_row(table: pa.Table, data: bytes) -> pa.Table:
    return pa.table(
        {"bucket": pa.array([table["bucket"][0].as_py()], pa.int32()),
         "data": pa.array([data], pa.binary())}
    )


def _word_counter(bits: int):
    """What each file of pairs says about words, a row per bucket of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                keys, stats = _words_of_pairs(*unpack_pairs(content.as_buffer()))
                names, starts = np.unique(_top(keys, bits), return_index=True)
                ends = np.append(starts[1:], len(keys))
                parts = zip(starts, ends, strict=True)
                data = [pack_words(keys[a:b], stats[a:b]) for a, b in parts]
                yield columns(bucket=pa.array(names, pa.int32()), data=pa.array(data, pa.binary()))

    return count


def _words_of_pairs(words, stops, second, counts) -> tuple[np.ndarray, np.ndarray]:
    """Sorted words of a file of pairs and their five numbers in it."""
    starts = stops[:-1].astype(np.int64)
    of_first = np.zeros((len(words), 5), np.int64)
    if len(words):
        of_first[:, 0] = np.add.reduceat(counts.astype(np.int64), starts)
        for column, held in ((1, counts == 1), (2, counts == 2), (3, counts >= 3)):
            of_first[:, column] = np.add.reduceat(held.astype(np.int64), starts)
    after, times = np.unique(second, return_counts=True)
    of_second = np.zeros((len(after), 5), np.int64)
    of_second[:, 4] = times
    keys = np.concatenate([words, after])
    (keys,), stats = _summed([keys], np.concatenate([of_first, of_second]))
    return keys, stats


def pack_words(words: np.ndarray, stats: np.ndarray) -> bytes:
    """Sorted words with their count, their second words seen once, twice, more often, and the
    number of words they follow."""
    after = stats[:, 4]
    header = [len(words), int((stats[:, 0] > 0).sum()), *_times(after), int(after.sum())]
    header.append(int(stats[:, 0].sum()))
    rest = [stats[:, i].astype("<u4") for i in (1, 2, 3, 4)]
    return _joined(np.array(header, "<i8"), words, stats[:, 0].astype("<i8"), *rest)


def unpack_words(buffer) -> tuple[np.ndarray, list[np.ndarray]]:
    reader = _Reader(buffer)
    rows = int(reader.take("<i8", HEADER)[0])
    words, count = reader.take("<u8", rows), reader.take("<i8", rows)
    return words, [count, *(reader.take("<u4", rows) for _ in range(4))]


def _merge_words(table: pa.Table) -> pa.Table:
    parts = [unpack_words(data.as_buffer()) for data in table["data"]]
    words = np.concatenate([w for w, _ in parts])
    stats = np.concatenate([np.column_stack([s.astype(np.int64) for s in rows]) for _, rows in parts])
    (words,), stats = _summed([words], stats)
    return _one_row(table, pack_words(words, stats))


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = [np.frombuffer(c.as_buffer(), "<i8", HEADER) for c in batch["content"]]
        for head in heads:
            yield columns(**{f"h{i}": pa.array([int(v)], pa.int64()) for i, v in enumerate(head)})


def _discounts(times: list[int]) -> list[float]:
    """The discounts of counts 1, 2 and more; middling ones where too little was seen for them."""
    one, two, three, four = times
    if not all(times):
        return [0.5, 0.75, 1.0]
    y = one / (one + 2 * two)
    found = [1 - 2 * y * two / one, 2 - 3 * y * three / two, 3 - 4 * y * four / three]
    return [min(max(d, 0.0), float(i)) for i, d in enumerate(found, 1)]


@dataclass(frozen=True)
class Model:
    """Where the files are, and the totals that all scores share."""

    path: str
    local: bool
    bits: int
    pair_discounts: tuple[float, ...]
    word_discounts: tuple[float, ...]
    word_times: tuple[int, ...]
    tokens: int
    vocabulary: int
    pairs: int
    files: tuple[int, int]

    def folder(self) -> str:
        """The model's folder as a path of the worker."""
        return urlparse(self.path).path if self.local else SparkFiles.get(os.path.basename(self.path))


def fit(
    docs: DataFrame,
    training: Column | None = None,
    text_column: str = "text",
    path: str | None = None,
) -> Model:
    """Count the rows for which ``training`` holds and write the model under ``path``.

    ``path`` is by default in the shared folder. Where that is not a mounted one, Spark copies the
    model's files to its workers.
    """
    spark = docs.sparkSession
    path = path or fresh_path(spark, "bigrams")
    rows = docs if training is None else docs.where(training)
    texts = rows.select(quoted(text_column).cast("string").alias("text"))
    bits = bucket_bits(texts)
    parts = texts.mapInArrow(_counter(bits), "bucket int, data binary")
    _written(parts, _merge_pairs, f"{path}/pairs")
    parts = _files(spark, f"{path}/pairs").mapInArrow(
        _word_counter(bits), "bucket int, data binary"
    )
    _written(parts, _merge_words, f"{path}/words")
    pairs, words = _totals(spark, f"{path}/pairs"), _totals(spark, f"{path}/words")
    local = urlparse(path).scheme in ("", "file")
    if not local:
        spark.sparkContext.addFile(path, recursive=True)
    return Model(
        path,
        local,
        bits,
        tuple(_discounts(pairs[2:6])),
        tuple(_discounts(words[2:6])),
        (words[2], words[3], words[1] - words[2] - words[3]),
        tokens=words[7],
        vocabulary=words[1],
        pairs=words[6],
        files=(pairs[-1], words[-1]),
    )


def _written(parts: DataFrame, merge, path: str) -> None:
    """One file per bucket with what ``merge`` makes of its parts."""
    merged = parts.groupBy("bucket").applyInArrow(merge, "bucket int, data binary")
    merged = merged.withColumn("data", F.col("data").cast("string"))
    merged.write.partitionBy("bucket").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.where(F.col("length") >= 8 * HEADER).select("content")


def _totals(spark: SparkSession, path: str) -> list[int]:
    names = [f"h{i}" for i in range(HEADER)]
    heads = _files(spark, path).mapInArrow(_headers, ", ".join(f"{n} long" for n in names))
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
    found = heads.agg(*sums, F.count(F.lit(1)).alias("files")).first()
    return [int(found[n]) for n in (*names, "files")]


class BucketFiles(Mapping):
    """The files of a model's pairs or words by bucket, mapped into memory when asked for.

    At most :data:`MOST_MAPS` are mapped at a time, those asked for last. A file that is missing is
    an error, as where the model's folder cannot be seen from a worker.
    """

    def __init__(self, folder: str, unpack, number: int):
        self.unpack, self.maps = unpack, OrderedDict()
        found = glob.glob(f"{glob.escape(folder)}/bucket=*/part-*")
        self.paths = {
            int(path.rsplit("bucket=", 1)[1].split("/")[0]): path
            for path in found
            if os.path.getsize(path) >= 8 * HEADER
        }
        if len(self.paths) != number:
            raise FileNotFoundError(f"{len(self.paths)} of {number} files of the model in {folder}")

    def __contains__(self, bucket: object) -> bool:
        return bucket in self.paths

    def __iter__(self) -> Iterator[int]:
        return iter(self.paths)

    def __len__(self) -> int:
        return len(self.paths)

    def __getitem__(self, bucket: int):
        if bucket in self.maps:
            self.maps.move_to_end(bucket)
        else:
            while len(self.maps) >= MOST_MAPS:
                self.maps.popitem(last=False)
            self.maps[bucket] = self.unpack(np.memmap(self.paths[bucket], np.uint8, mode="r"))
        return self.maps[bucket]


@lru_cache(maxsize=2)
def _mapped(model: Model) -> tuple[BucketFiles, BucketFiles]:
    return (
        BucketFiles(f"{model.folder()}/pairs", unpack_pairs, model.files[0]),
        BucketFiles(f"{model.folder()}/words", unpack_words, model.files[1]),
    )


def _word_stats(files: dict, words: np.ndarray, bits: int) -> np.ndarray:
    """Five numbers for each of the sorted ``words``, zeros for unknown ones."""
    stats = np.zeros((5, len(words)), np.int64)
    buckets = _top(words, bits)
    for bucket, some in _runs(buckets):
        if bucket in files:
            known, columns_of = files[bucket]
            at = np.searchsorted(known, words[some])
            hit = known[np.minimum(at, len(known) - 1)] == words[some]
            rows = np.arange(some.start, some.stop)[hit]
            for i, column in enumerate(columns_of):
                stats[i, rows] = column[at[hit]]
    return stats


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, slice]]:
    names, starts = np.unique(sorted_values, return_index=True)
    stops = np.append(starts[1:], len(sorted_values))
    for name, start, stop in zip(names.tolist(), starts.tolist(), stops.tolist(), strict=True):
        yield name, slice(start, stop)


def _pair_counts(files: dict, first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Counts of pairs, zeros for unknown ones."""
    counts = np.zeros(len(first), np.int64)
    buckets = pair_buckets(first, second, bits).astype(np.uint16)
    order = np.argsort(buckets, kind="stable")
    for bucket, some in _runs(buckets[order]):
        if bucket not in files:
            continue
        rows = order[some]
        words, stops, followers, of = files[bucket]
        at = np.minimum(np.searchsorted(words, first[rows]), len(words) - 1)
        rows, at = (x[words[at] == first[rows]] for x in (rows, at))
        low, high = stops[at].astype(np.int64), stops[at + 1].astype(np.int64)
        last, wanted = high.copy(), second[rows]
        # All rows halve their own range at once.
        while (open_ := low < high).any():
            middle = (low + high) // 2
            less = followers[np.minimum(middle, len(followers) - 1)] < wanted
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        inside = low < last
        inside[inside] = followers[low[inside]] == wanted[inside]
        counts[rows[inside]] = of[low[inside]]
    return counts


def _discounted(counts: np.ndarray, discounts: tuple[float, ...]) -> np.ndarray:
    """Counts less their discount, zero for those not seen."""
    by_count = np.array([0.0, *discounts])
    return counts - by_count[np.minimum(counts, 3)]


def text_scores(model: Model, texts: list[str | None], words: WordHashes) -> dict[str, np.ndarray]:
    """``n_tokens``, ``n_known``, ``base_score``, ``score`` of each text."""
    pair_files, word_files = _mapped(model)
    sequences = _sequences(texts, words)
    known, places, starts = _pairs_of(sequences)
    stats = _word_stats(word_files, known, model.bits)
    # The end of a text is never a first word; it occurs as often as the start.
    as_token = stats[0].copy()
    as_token[np.searchsorted(known, END)] = stats[0][np.searchsorted(known, START)]

    pairs = places[:-1] * len(known) + places[1:]
    pairs, of = np.unique(pairs, return_inverse=True)
    first, second = pairs // len(known), pairs % len(known)
    seen = _pair_counts(pair_files, known[first], known[second], model.bits)
    unseen_share = 1.0
    lower = np.zeros(len(known))
    if model.pairs:
        held = [d * t for d, t in zip(model.word_discounts, model.word_times, strict=True)]
        unseen_share = sum(held) / model.pairs
        lower = _discounted(stats[4], model.word_discounts) / model.pairs
    lower += unseen_share / (model.vocabulary + 1)
    context = stats[0][first]
    backoff = sum(d * stats[i][first] for i, d in enumerate(model.pair_discounts, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        given = (_discounted(seen, model.pair_discounts) + backoff * lower[second]) / context
    chance = np.log10(np.where(context > 0, given, lower[second]))
    base = np.log10((as_token + 1) / (model.tokens + model.vocabulary + 1))

    # Every token but a text's start; its pair begins one place before it.
    lengths = np.array([len(s) for s in sequences])
    is_token = np.ones(len(places), bool)
    is_token[starts] = False
    tokens = places[is_token]
    sums = np.cumsum(lengths - 1) - (lengths - 1)
    return {
        "n_tokens": lengths - 1,
        "n_known": np.add.reduceat((as_token[tokens] > 0).astype(np.int64), sums),
        "base_score": np.add.reduceat(base[tokens], sums),
        "score": np.add.reduceat(chance[of[np.flatnonzero(is_token) - 1]], sums),
    }


def scored(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity``.

    Tokens are the words between ASCII white space, A to Z in lower case, and one end. ``score`` is
    the model's log10 probability of the whole text, ``base_score`` that of an add-one unigram
    model, ``n_known`` the number of tokens that the training texts have. A null or empty text is
    its end alone. Without training texts every token has probability 1. Null and repeated ids and
    equal rows are rows like others; extra columns are left out.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for piece, texts in pieces(batches, PIECE_BYTES):
            yield columns(id=piece["id"], **text_scores(model, texts, words))

    kind = docs.schema[id_column].dataType.simpleString()
    narrow = docs.select(
        quoted(id_column).alias("id"), quoted(text_column).cast("string").alias("text")
    )
    found = narrow.mapInArrow(
        score, f"id {kind}, n_tokens long, n_known long, base_score double, score double"
    )
    return found.select(
        F.col("id").alias(id_column),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
