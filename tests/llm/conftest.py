import random

import pytest

from claimwright.llm.common import ship

#: Names that the operators use inside, as further columns of the input.
CLASHING = ("key", "sha256", "fp", "root", "rank", "size", "score", "copies", "target", "kept", "_n", "batch", "n_tokens", "label", "t", "x", "mark")
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table, in several partitions, with further columns of clashing names."""

    def make(rows, partitions=3):
        full = [(*r, *(None,) * (5 - len(r))) for r in rows]
        extra = ", ".join(f"`{c}` string" for c in CLASHING)
        clash = [(*r, *(f"{c}!" for c in CLASHING)) for r in full]
        return spark.createDataFrame(clash, f"{COLUMNS}, {extra}").repartition(partitions, "doc_id", "text")

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(1)
    words = ["the", "Thing", "tion", "naïve", "ÉTÉ", "don't", "x1y22", "你好", "straße", "...", "ΑΣ", "it's", "<|endoftext|>", "$$$", "é"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))), rng.choice(["en", "de", None]), rng.choice(["a", "b", None])) for i in range(10, 40)]
    rows += [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", None, None), (4, "one", "de", "b"), (5, "two words", "fr", "b"),
        (6, "a" * 30_000, "en", "c"), (7, " ".join(rng.choice(words) for _ in range(40_000)), "en", "c"), (8, "two words", None, "a"), (8, "two words", None, "a"),
        (9, "two  words", "es", "a"), (9, "Two words", "es", "b"), (None, "two words", "en", "a"), (None, None, None, None), (None, "lonely null", None, None),
        (50, "line\n\nline \n line\x1cx\xa0y", "en", None), (-3, "negative id", "en", "a"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(documents, odd_rows):
    return documents(odd_rows)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])
