"""Byte-pair encoding against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from clinflow.llm import bpe
from clinflow.llm.queries import vocabulary

PATH = vocabulary("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, ids int, n_tokens string"
HARD = [
    "", "a", " ", "  ", "   ", "a  b", "a   b", "a b ", "a b  ", " a", "\n a", "a \n b", "a\n \nb",
    "<|endoftext|>", "x<|endoftext|> y <|endoftext|><|endoftext|>", "<|endoftext", "\t\t x",
    "don't we've I'll they'd '''s", "é ß 日本 😀 ", "   x　y ", "՘֋ x₏", "ꟍ 𐵀 ",
    "1234 5 6a", "\x1c \x1d", "a \x85 b", "नमस्ते", "مرحبا",
    "a" * 5000, "ab" * 3000, "the" * bpe.SHORT, " " * 300, "Zeichenkettenlängenbegrenzung"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_texts_equal_the_library(library):
    rng = random.Random(1)
    alphabet = "ab .,'\n\t1é日😀 ՘s<|endoftext|>"
    texts = HARD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
                    for _ in range(5000)]
    mine = bpe.Bpe(PATH)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [a.tolist() for a in mine.encode_batch(texts)] == want
    assert [a.tolist() for a in mine.encode_batch(texts)] == want  # from remembered words
    assert [mine.decode(ids) for ids in want] == [
        library.decode(ids, skip_special_tokens=False) for ids in want] == texts


def test_heap_and_matrix_merge_alike():
    mine = bpe.Bpe(PATH)
    rng = random.Random(2)
    words = [bytes(rng.choice(b"theandring  ") for _ in range(rng.randint(1, 90))) for _ in range(400)]
    assert [a.tolist() for a in mine.merge(words)] == [mine.merge_long(w).tolist() for w in words]


def test_broken_ids_decode_like_the_library(library):
    mine = bpe.Bpe(PATH)
    rng = random.Random(3)
    for _ in range(500):
        ids = [rng.randrange(mine.size) for _ in range(rng.randint(0, 12))]
        assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert mine.decode([mine.size + 5, 64]) == mine.decode([64])


def test_forgetting_words_changes_nothing(monkeypatch):
    mine = bpe.Bpe(PATH)
    want = [a.tolist() for a in mine.encode_batch(HARD)]
    monkeypatch.setattr(bpe, "CACHE_WORDS", 0)
    assert [mine.encode_batch([t])[0].tolist() for t in HARD] == want


def test_a_vocabulary_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        bpe.Bpe(vocabulary("word_bpe_49k.json"))


def test_digest_and_round_trip_over_a_table(spark, library):
    rows = [(i, t, 1, "x") for i, t in enumerate(HARD)] + [
        (None, "no id", 1, "x"), (3, "again", 1, "x"), (3, "again", 1, "x"), (99, None, 1, "x"),
        (100, "very long " * 40_000, 1, "x")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, bpe.digest(docs, PATH).collect()), key=repr) == sorted(want, key=repr)
    back = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        [(i, t or "") for i, t, *_ in rows], key=repr)
    nothing = spark.createDataFrame([], SCHEMA)
    assert bpe.digest(nothing, PATH).count() == bpe.encode(nothing, PATH).count() == 0
