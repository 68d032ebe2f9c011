"""Word-end BPE against the library the vocabulary file belongs to."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return word_bpe.Encoder(word_bpe.Vocabulary(PATH))


def ids_of(encoder, text):
    return memoryview(encoder(text)).cast("i").tolist()


def test_random_texts_match_the_library(encoder, library):
    rng = random.Random(5)
    signs = "aAbB tTsS'’09  \n\té́İΣσςßЖ漢字🙂!?.,-_́\u0085Ᲊ\U000105c0‍"
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(40)))
        if rng.random() < 0.2:
            text += rng.choice(["<|endoftext|>", "<|startoftext|>", "<|endoftext"]) + text
        told = library.encode(text, add_special_tokens=False).ids
        ids = ids_of(encoder, text)
        assert ids == told, text
        names = encoder.words.vocabulary.name
        assert word_bpe.decoded(ids, names) == library.decode(told, skip_special_tokens=False)


def test_scan_and_heap_give_the_same(encoder):
    v = encoder.words.vocabulary
    rng = random.Random(6)
    for _ in range(300):
        word = bytes(rng.choice(b"theaningos") for _ in range(rng.randrange(1, 200)))
        parts = [v.inner[b] for b in word[:-1]] + [v.last[word[-1]]]
        assert word_bpe.scanned(list(parts), v.pairs, v.width) == word_bpe.heaped(list(parts), v.pairs, v.width)


def test_long_words_and_long_texts(encoder, library, monkeypatch):
    for text in ("ab" * 3000, "x" * 2000, "the" * 400 + "ing"):
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(word_bpe, "PIECE_CHARS", 50)
    monkeypatch.setattr(word_bpe, "REMEMBERED_BYTES", 2000)
    text = "Ünï código don't  we're 12 x́ y z. " * 200
    assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_frames(spark, library):
    rows = [(1, "Hello World's end", "a"), (2, None, "b"), (3, "", "c"), (3, "", "c"), (4, " \n", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens string")
    back = word_bpe.decode(word_bpe.encode(docs, PATH), PATH).collect()
    assert len(back) == 5
    for row in back:
        told = library.encode(row.text or "", add_special_tokens=False).ids
        assert list(row.tokens) == told
        assert row.decoded == library.decode(told, skip_special_tokens=False)
    digests = {r.doc_id: r for r in word_bpe.round_trip(docs, PATH).collect()}
    assert digests[2].n_tokens == 0 and digests[2].ids_sha256 == hashlib.sha256(b"").hexdigest()
    told = library.encode(rows[0][1], add_special_tokens=False).ids
    assert digests[1].ids_sha256 == hashlib.sha256(" ".join(map(str, told)).encode()).hexdigest()
    empty = docs.where(F.lit(False))
    assert word_bpe.round_trip(empty, PATH).count() == 0 and word_bpe.encode(empty, PATH).count() == 0
