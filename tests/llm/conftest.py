import random

import pytest

from tallyhouse.llm.queries import vocabulary

#: Extra columns whose names the operators use inside themselves.
CLASHES = ["id", "rep", "key", "size", "band", "kept", "q_words", "row_key", "copies", "nth", "gone_id", "draw", "score", "word", "term"]


@pytest.fixture(scope="session")
def path():
    return vocabulary()


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n): a text of n invented words, the same for the same seed."""

    def make(seed, n):
        rng = random.Random(seed)
        syllables = "an be co du el fi go ha in ka lo mi no pu re sa ti vo".split()
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows of doc_id, text[, lang[, source]]): with the table's other columns and clashing extras."""

    def make(rows):
        full = [(*r, *("en", "web")[len(r) - 2 :], None, *["x"] * len(CLASHES)) for r in rows]
        kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
        return spark.createDataFrame(full, kinds)

    return make


@pytest.fixture(scope="session")
def odd(prose):
    """Rows with every kind of odd value: null id, null, empty and blank text, repeats, a very long text."""
    same = prose(1, 80)
    return [
        (1, None, None, None), (2, "", "en", "b"), (3, " \n\t ", "en", None), (4, same), (4, same), (None, same), (5, prose(2, 70), None, "a"),
        (6, "one"), (7, "¿qué? – ßüß 漢字 🙂 <|endoftext|> x y", "es"), (8, prose(3, 6000)), (9, "12 34 -- !!", None, "b"), (10, "a " * 300, "en", "é"),
    ]
