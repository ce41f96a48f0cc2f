"""Packing as an exact round trip, the level rule against all levels, token counts."""

import os
import shutil
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from targetlens.llm.packing import Packer, packed, padding
from targetlens.llm.tokenizer import Encoder, has_word_ends, whole_tokens
from targetlens.llm.tokens import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    (1, "Hello, World! it's 2024 <|endoftext|> x"), (2, None), (3, ""), (4, "word " * 9_000),
    (5, "ÄÖß ſ İ ² ½ é́ 中文 \x1c\x85 a b"), (None, "null id"), (7, "same"), (7, "same"),
    (8, "<|startoftext|>a<|endoftext|>"), (9, "x" * 5_000), (10, "don't you'll 'REs"),
]
SCHEMA = "doc_id long, text string, ids string"


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH, whole_tokens(PATH))


ODD = "abcdeXYZ'' \n\t019.,;<|>&éÉßñÑİŉſ中文́\x1c\x85\xa0 Σς½²ǅ😀\x00\x0b\x0c"
PARTS = st.one_of(st.sampled_from(ODD), st.sampled_from(["'re", "'LL", " the ", "<|endoftext|>"]))


@settings(max_examples=400, deadline=None)
@given(parts=st.lists(PARTS, max_size=40))
def test_ids_are_the_library_s(encoder, parts):
    text = "".join(parts)
    assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == library_ids(text)


COMMON = st.one_of(
    st.sampled_from("abcXYZéÉßñŁ'' \n\t09..,,;<|>&"),
    st.sampled_from(["'re", "'LL", " the ", "word. ", "Ende, ", "x.y", "it's, ", "3.5", "...", "<|"]),
)


@settings(max_examples=400, deadline=None)
@given(parts=st.lists(COMMON, max_size=60))
def test_ids_of_common_letters_are_the_library_s(encoder, parts):
    text = "".join(parts)
    assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == library_ids(text)


def test_bounds_on_what_is_remembered_change_nothing(monkeypatch):
    monkeypatch.setattr("targetlens.llm.tokenizer.MOST_CHUNKS", 3)
    encoder = Encoder(PATH, whole_tokens(PATH))
    for _, text in TEXTS * 2:
        ids = encoder.ids([text or ""])[0]
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text)


def test_whole_tokens_are_proved():
    whole = whole_tokens(PATH)
    assert has_word_ends(PATH) and len(whole) > 30_000
    assert all(library_ids(word) == [whole[word]] for word in list(whole)[::997])


def test_whole_tokens_are_proved_one_by_one_and_once_for_a_file(tmp_path, monkeypatch):
    loaded = []

    class Library:
        def __init__(self, path):
            loaded.append(path)
            self.whole = Tokenizer.from_file(path)

        from_file = classmethod(lambda cls, path: cls(path))
        get_vocab = lambda self: dict(sorted(self.whole.get_vocab().items())[-500:])

        def encode(self, text, add_special_tokens):
            return self.whole.encode(text, add_special_tokens=add_special_tokens)

    copy = str(shutil.copy(PATH, tmp_path / "vocabulary.json"))
    monkeypatch.setattr("targetlens.llm.tokenizer.Tokenizer", Library)
    first = whole_tokens(copy)
    assert first and whole_tokens(copy) == first and loaded == [copy]
    assert all(library_ids(word) == [token] for word, token in first.items())
    os.utime(copy, (1, 1))
    assert whole_tokens(copy) == first and loaded == [copy, copy]


def rebuilt(rows):
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        documents[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place and length > 0
            place += length
        assert place <= 4096
    return documents


def test_round_trip(spark):
    df = spark.createDataFrame([(*row, "x") for row in TEXTS], SCHEMA)
    pieces = packed(df, PATH)
    documents = rebuilt(pieces.collect())
    for key, text in TEXTS:
        ids = [*library_ids(text), 2]
        parts = sorted(documents[key])
        if key == 7:
            assert [p[1] for p in parts] == [ids, ids]
            continue
        assert [i for _, part, _ in parts for i in part] == ids
        assert {total for *_, total in parts} == {len(ids)}
        starts = [start for start, *_ in parts]
        assert starts == [sum(len(p) for _, p, _ in parts[:i]) for i in range(len(parts))]
    assert padding(pieces).first().padded == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert packed(df, PATH).collect() == [] and token_counts(df, PATH).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=16, max_size=16), st.integers(1, 15))
def test_best_level_minimises_the_sum_of_squares(counts, size):
    packer = Packer(16)
    packer.levels[1:16] = counts[1:]

    def total(level):
        levels = packer.levels.copy()
        if level:
            levels[level] -= 1
        if level + size < 16:
            levels[level + size] += 1
        return int((levels**2).sum())

    usable = [h for h in range(16 - size + 1) if h == 0 or packer.levels[h]]
    best = min(total(h) for h in usable)
    assert packer.best_level(size) == max(h for h in usable if total(h) == best)


def test_many_open_windows_are_drained():
    packer = Packer(64, most_open=3)
    rng = np.random.default_rng(0)
    wanted = {row: rng.integers(0, 9, rng.integers(1, 150)) for row in range(300)}
    for row, ids in wanted.items():
        packer.add(row, ids)
        assert packer.levels.sum() <= 4
    packer.drain(0)
    held = defaultdict(dict)
    for window in packer.closed:
        size = sum(len(p.ids) for p in window)
        assert size == 64 or size & (size - 1) == 0
        for piece in window:
            held[piece.row][piece.start] = piece.ids.tolist()
    for row, ids in wanted.items():
        assert sum((held[row][s] for s in sorted(held[row])), []) == ids.tolist()


@pytest.mark.parametrize("seed", range(3))
def test_open_windows_are_filled_up_and_not_cut_anew(seed):
    packer = Packer()
    rng = np.random.default_rng(seed)
    sizes = np.minimum(rng.lognormal(6, 1, 3_000).astype(int) + 1, 4_000)
    for row, size in enumerate(sizes):
        packer.add(row, np.zeros(size, np.uint32))
    opened = [{p.row for p in w} for level in packer.open.values() for w in level]
    closed = len(packer.closed)
    packer.drain(0)
    cuts = sum(p.start > 0 for window in packer.closed for p in window)
    # At most one cut for a window that is filled up, and some for the powers of two of the last.
    assert cuts <= len(packer.closed) - closed + 12
    kept = [{p.row for p in w} for w in packer.closed[closed:]]
    whole = sum(any(held <= window for window in kept) for held in opened)
    assert whole >= len(kept) - 13


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, name):
    path = public_tokenizers.path(name)
    df = spark.createDataFrame([(*row, "x") for row in TEXTS], SCHEMA.replace("ids", "n_tokens"))
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        number = {text: len(model.encode(text or "")) for _, text in TEXTS}
    else:
        library = Tokenizer.from_file(path)
        number = {t: len(library.encode(t or "", add_special_tokens=False).ids) for _, t in TEXTS}
    wanted = [(k, len((t or "").encode()), number[t], number[t] > 2_048) for k, t in TEXTS]
    rows = [tuple(r) for r in token_counts(df, path).collect()]
    assert sorted(rows, key=repr) == sorted(wanted, key=repr)
