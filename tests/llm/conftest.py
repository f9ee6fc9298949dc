import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from tallywatch.llm.common import ship_package

    ship_package(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, copy int, bin string"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text[, source]) with further columns whose names operators use themselves."""
    def build(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "k", 9, "b") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


#: Nulls, an empty and a long text, ties and repeated rows.
ODD = [
    (None, None, None), (None, "one text without an id, but with words", None), (1, None, "a"), (2, "", "a"), (3, " \n\t ", "b"),
    (4, "word " * 30_000, "b"), (5, "the same line of text here\nand another line of it", "a"), (5, "the same line of text here\nand another line of it", "a"),
    (5, "another text under the same id. It has two sentences.", "c"), (6, "the same line of text here\nand one more line", None),
]


@pytest.fixture
def odd(docs):
    return docs(*ODD)
