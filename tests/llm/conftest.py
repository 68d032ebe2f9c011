import random

import public_tokenizers
import pytest

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score int"


def sentence(rng, n):
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, columns that clash with results' names."""
    rng = random.Random(3)
    body = "\n".join(sentence(rng, 12) for _ in range(10))
    texts = [
        (1, body), (2, None), (3, ""), (4, " \n\t "), (5, body), (5, body), (None, body), (None, None),
        (6, " ".join(sentence(rng, 20) for _ in range(2000))), (7, "x" * 200_000), (8, "one two three"),
        (9, "Ünï çødé 日本語 🎉 \x85 text"),
    ]
    return spark.createDataFrame([(i, t, "en", "s", 0, "k", 1) for i, t in texts], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
