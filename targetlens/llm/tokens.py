"""Token counts of whole texts, with a shortcut for pre-tokens that are one token."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from targetlens.functions.flags import quoted
from targetlens.llm.common import columns, pieces
from targetlens.llm.tokenizer import WorkerEncoder, has_word_ends

PIECE_BYTES = 4_000_000


def token_counts(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 2_048,
) -> DataFrame:
    """Id, ``n_bytes``, ``n_tokens``, ``over_limit`` for every row of ``docs``.

    Counts are those of the library for the vocabulary file ``path`` (``.json`` or ``.model``)
    without added begin, end or special tokens; special strings in a text are handled as the
    library does by default. For vocabularies with word ends, pre-tokens proved to be one token
    are counted directly and only the rest is merged; other vocabularies are counted by the
    library alone.

    A null or empty text has no bytes and no tokens. Null and repeated ids, equal rows and extra
    columns change nothing: one row in, one row out. An empty table gives an empty one.
    """
    count = _counter(docs.sparkSession, path)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in pieces(batches, PIECE_BYTES):
            found = pa.array(count([text or "" for text in texts]), pa.int64())
            yield columns(id=piece["id"], n_bytes=piece["n_bytes"], n_tokens=found)

    kind = docs.schema[id_column].dataType.simpleString()
    text = quoted(text_column).cast("string")
    bytes_of = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    narrow = docs.select(
        quoted(id_column).alias("id"), text.alias("text"), bytes_of.alias("n_bytes")
    )
    found = narrow.mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long")
    return found.select(
        F.col("id").alias(id_column),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )


def _counter(spark, path: str):
    """The function from texts to their numbers of tokens that tasks use."""
    if path.endswith(".json") and has_word_ends(path):
        encoder = WorkerEncoder(spark, path)
        return lambda texts: [len(ids) // 4 for ids in encoder.get().ids(texts)]

    def by_library(texts: list[str]) -> list[int]:
        if path.endswith(".model"):
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            return [len(ids) for ids in model.encode(texts, num_threads=1)]
        found = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
        return [len(e.ids) for e in found]

    return by_library
