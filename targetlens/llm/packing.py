"""Documents packed into token sequences by sum-of-squares online packing.

Each task packs its own share of the documents as they come, so nothing is shuffled or gathered.
An array holds for every fill level how many windows are filled that far. A document goes to the
level that makes the sum of the squared numbers smallest, which keeps few windows partly filled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from targetlens.functions.flags import quoted
from targetlens.llm.common import columns, pieces
from targetlens.llm.tokenizer import WorkerEncoder

LENGTH = 4096
END_ID = 2
MOST_OPEN = 1_024
PIECE_BYTES = 4_000_000
SEQUENCE_BITS = 36


@dataclass
class Piece:
    """Part of a document's ids; ``row`` is what the document is known by."""

    row: object
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        first = Piece(self.row, self.start, self.ids[:at], self.doc_tokens)
        return first, Piece(self.row, self.start + at, self.ids[at:], self.doc_tokens)


@dataclass
class Packer:
    """Windows of ``length`` tokens; ``closed`` collects those that are done."""

    length: int = LENGTH
    most_open: int = MOST_OPEN
    closed: list[list[Piece]] = field(default_factory=list)

    def __post_init__(self):
        self.levels = np.zeros(self.length + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = {}

    def add(self, row, ids: np.ndarray) -> None:
        """A document: full windows first, the rest to the best level."""
        whole = len(ids) - len(ids) % self.length
        for start in range(0, whole, self.length):
            part = ids[start : start + self.length]
            self.closed.append([Piece(row, start, part, len(ids))])
        if whole < len(ids):
            self._place(Piece(row, whole, ids[whole:], len(ids)))
        if int(self.levels.sum()) > self.most_open:
            self.drain(self.most_open // 2)

    def best_level(self, size: int) -> int:
        """The level (0: a new window) whose use by ``size`` more tokens gives the smallest sum of
        squares; the fullest of equals."""
        before = self.levels[: self.length - size + 1]
        after = self.levels[size:]
        change = 2 * after + 1
        change[-1] = 0  # a full window is on no level
        change[1:] -= 2 * before[1:] - 1
        usable = before > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def _place(self, piece: Piece) -> None:
        size = len(piece.ids)
        level = self.best_level(size)
        window = []
        if level:
            window = self.open[level].pop()
            self.levels[level] -= 1
        window.append(piece)
        self._put(window, level + size)

    def _put(self, window: list[Piece], level: int) -> None:
        if level == self.length:
            self.closed.append(window)
        else:
            self.open.setdefault(level, []).append(window)
            self.levels[level] += 1

    def drain(self, most: int) -> None:
        """Leave at most so many windows open: the fullest are filled up from the emptiest.

        What a window holds stays in it, and only the last piece it is given may be cut. Where none
        may stay open, the rest of the last one is cut into powers of two, which need no padding.
        """
        held = [[level, w] for level in sorted(self.open) for w in self.open[level]]
        self.open.clear()
        self.levels[:] = 0
        low, high = 0, len(held) - 1
        while high - low + 1 > most and low < high:
            full, giver = held[high], held[low]
            piece = giver[1].pop()
            if len(piece.ids) > self.length - full[0]:
                piece, rest = piece.cut(self.length - full[0])
                giver[1].append(rest)
            full[1].append(piece)
            full[0] += len(piece.ids)
            giver[0] -= len(piece.ids)
            if full[0] == self.length:
                self.closed.append(full[1])
                high -= 1
            if not giver[0]:
                low += 1
        for level, window in held[low : high + 1]:
            if most or level == self.length:
                self._put(window, level)
            elif level:
                self._in_powers(window, level)

    def _in_powers(self, window: list[Piece], total: int) -> None:
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            part = []
            while room:
                piece = window.pop(0)
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    window.insert(0, rest)
                part.append(piece)
                room -= len(piece.ids)
            self.closed.append(part)


def packed(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``,
    ``offset``.

    A document is its ids by the vocabulary file ``path`` and then ``end_id``; ``ids`` are
    little-endian unsigned 32-bit numbers. Pieces of a document have gapless ``start``, pieces of a
    sequence gapless ``offset``. Sequences have ``length`` tokens; the last ones of each task have
    a power of two, so nothing is padded when ``length`` is a power of two.

    A null or empty text is one ``end_id``. Null and repeated ids are packed like others, equal rows
    each on their own. Extra columns are left out. An empty table gives no pieces. A task's open
    windows are at most ``MOST_OPEN``: beyond it, and at its end, the fullest are filled up with
    what the emptiest hold. Sequence ids differ between tasks and stay the same when a
    task reads its rows in the same order again.
    """
    encoder = WorkerEncoder(docs.sparkSession, path)
    kind = docs.schema[id_column].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder.get()
        packer = Packer(length)
        sequence = TaskContext.get().partitionId() << SEQUENCE_BITS
        kind_of_id = pa.null()
        for piece, texts in pieces(batches, PIECE_BYTES):
            kind_of_id = piece["id"].type
            found = encode.ids([text or "" for text in texts])
            for row, ids in zip(piece["id"].to_pylist(), found, strict=True):
                packer.add(row, np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id)))
            yield _rows(packer.closed, sequence, kind_of_id)
            sequence += len(packer.closed)
            packer.closed.clear()
        packer.drain(0)
        yield _rows(packer.closed, sequence, kind_of_id)

    narrow = docs.select(
        quoted(id_column).alias("id"), quoted(text_column).cast("string").alias("text")
    )
    found = narrow.mapInArrow(
        pack,
        f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
        "offset long",
    )
    return found.withColumnRenamed("id", id_column)


def _rows(windows: list[list[Piece]], sequence: int, kind: pa.DataType) -> pa.RecordBatch:
    offsets, numbers = [], []
    for number, window in enumerate(windows, sequence):
        sizes = [len(piece.ids) for piece in window]
        offsets += [0, *np.cumsum(sizes[:-1]).tolist()]
        numbers += [number] * len(window)
    flat = [piece for window in windows for piece in window]
    return columns(
        id=pa.array([p.row for p in flat], kind),
        start=pa.array([p.start for p in flat], pa.int64()),
        length=pa.array([len(p.ids) for p in flat], pa.int64()),
        ids=pa.array([p.ids.astype("<u4").tobytes() for p in flat], pa.binary()),
        doc_tokens=pa.array([p.doc_tokens for p in flat], pa.int64()),
        sequence_id=pa.array(numbers, pa.int64()),
        offset=pa.array(offsets, pa.int64()),
    )


def padding(pieces_of: DataFrame, length: int = LENGTH) -> DataFrame:
    """``sequences``, ``tokens``, ``padded``: one row; sequences of a power of two need none."""
    sizes = pieces_of.groupBy("sequence_id").agg(F.sum("length").alias("size"))
    power = F.col("size") == F.pow(F.lit(2), F.floor(F.log2("size"))).cast("long")
    return sizes.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.sum("size").alias("tokens"),
        F.sum(F.when(power, 0).otherwise(length - F.col("size"))).alias("padded"),
    )
