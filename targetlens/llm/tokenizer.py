"""Token ids of a public vocabulary, as its library gives them, for very many short strings.

Pieces between blanks, tabs and line ends never share a token, so each distinct one is encoded once
and remembered. Texts of ordinary letters are put in lower case and parted at full stops and commas
too, where those stand alone, so that nearly all pieces are pre-tokens. A pre-token that is proved
to be one token needs no library call, and the rest are merged by the library, many at a time. A
piece of other letters goes to the library as it is, special strings included.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from targetlens.llm.common import Recent

MOST_CHUNKS = 350_000
AT_ONCE = 2_000

# Letters that normalisation leaves alone but for simple lower-casing.
LETTERS = "a-zßà-öø-įĳ-ňŋ-ž"
PLAIN_SIGNS = "!-~À-ÖØ-öø-įĲ-ňŊ-ž"
PLAIN = re.compile(f"[{PLAIN_SIGNS}]*")
PLAIN_TEXT = re.compile(f"[{PLAIN_SIGNS} \\n\\t\\r]*")
# Signs that stand together are one pre-token.
TOGETHER = re.compile("[!-/:-@[-`{-~][!-/:-@[-`{-~]")
# Fixed value: the vocabulary's rule for pre-tokens, for plain chunks in lower case.
PRE_TOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
SPECIAL = "<|"


def chunks_of(text: str) -> list[str]:
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def has_word_ends(path: str) -> bool:
    """Whether a vocabulary file is of the kind whose pre-tokens are known here."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return (
        spec["model"].get("end_of_word_suffix") == WORD_END
        and (split.get("pattern") or {}).get("Regex") == RULE
        and [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        == ["NFC", "Replace", "Lowercase"]
    )


def whole_tokens(path: str) -> dict[str, int]:
    """Vocabulary strings proved to encode alone as one token, with its id.

    Bounded by the vocabulary; each string is tried with the library itself, once for a file.
    """
    state = os.stat(path)
    return dict(_proved(path, state.st_mtime_ns, state.st_size))


@lru_cache(maxsize=2)
def _proved(path: str, changed: int, size: int) -> tuple:
    # One string at a time: what the library makes of many at once stays in the driver's memory.
    library = Tokenizer.from_file(path)
    ends = [t[: -len(WORD_END)] for t in library.get_vocab() if t.endswith(WORD_END)]
    plain = [w for w in ends if PLAIN.fullmatch(w) and PRE_TOKENS.fullmatch(w)]
    tried = ((w, library.encode(w, add_special_tokens=False).ids) for w in plain)
    return tuple((w, ids[0]) for w, ids in tried if len(ids) == 1)


def packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, "<u4").tobytes()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers; pieces are remembered within a bound."""

    def __init__(self, path: str, whole: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 2, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.recent = Recent(MOST_CHUNKS, {word: packed([i]) for word, i in whole.items()})

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, one after the other."""
        split, unlike = [], set()
        for text in texts:
            if not PLAIN_TEXT.fullmatch(text) or SPECIAL in text:
                split.append(chunks_of(text))
                unlike.update(split[-1])
                continue
            text = text.lower()
            if not TOGETHER.search(text):
                text = text.replace(",", " , ").replace(".", " . ")
            split.append(text.split())
        self._learn(self.recent.missing(set().union(*split)), unlike)
        known = self.recent.known.__getitem__
        return [b"".join(map(known, chunks)) for chunks in split]

    def _learn(self, chunks: list[str], unlike: set[str]) -> None:
        """Ids of chunks, which are plain and in lower case but for those of ``unlike`` texts."""
        known, words, mixed = self.recent.known, [], {}
        for chunk in chunks:
            if chunk in unlike:
                if not PLAIN.fullmatch(chunk) or SPECIAL in chunk:
                    known[chunk] = self._alone(chunk)
                else:
                    mixed[chunk] = PRE_TOKENS.findall(chunk.lower())
            elif chunk.isalpha():
                words.append(chunk)
            else:
                mixed[chunk] = PRE_TOKENS.findall(chunk)
        parts = set().union(*mixed.values()).difference(known)
        self._merge([*words, *parts.difference(words)])
        known.update([(chunk, b"".join([known[w] for w in mixed[chunk]])) for chunk in mixed])

    def _alone(self, text: str) -> bytes:
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def _merge(self, words: list[str]) -> None:
        """Ids of pre-tokens, many in one call: a token that ends a word ends its pre-token."""
        known = self.recent.known
        for start in range(0, len(words), AT_ONCE):
            some = words[start : start + AT_ONCE]
            ids = self.library.encode(" ".join(some), add_special_tokens=False).ids
            ids = np.array(ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some) or (len(ids) and stops[-1] != len(ids)):
                known.update((word, self._alone(word)) for word in some)
                continue
            first = 0
            for word, stop in zip(some, stops.tolist(), strict=True):
                known[word] = ids[first:stop].tobytes()
                first = stop


@lru_cache(maxsize=2)
def _kept(path: str, whole: tuple) -> Encoder:
    return Encoder(path, dict(whole))


class WorkerEncoder:
    """What a task needs to make its encoder, which a reused worker keeps for later tasks."""

    def __init__(self, spark, path: str):
        self.path = path
        self.whole = spark.sparkContext.broadcast(tuple(whole_tokens(path).items()))

    def get(self) -> Encoder:
        return _kept(self.path, self.whole.value)
