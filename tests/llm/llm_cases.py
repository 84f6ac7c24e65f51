"""Fixtures that the tests of this folder import."""

import pytest
from pyspark.sql import Row

from sigflow.llm.common import workers_find_package


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    workers_find_package(spark)


#: Null and empty texts, white space, repeated rows, a null id, long words.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away"),
    (2, "the  quick brown fox jumps over the lazy dog and runs away "),
    (3, "The quick brown fox jumps over the lazy dog and runs away"),
    (4, None),
    (5, ""),
    (6, " \t\n"),
    (7, "eins zwei"),
    (8, "Eins\nzwei"),
    (9, "ﬁ ☃ 🙂 naïve ça \x85 a b <|endoftext|> <s> ▁x"),
    (9, "ﬁ ☃ 🙂 naïve ça \x85 a b <|endoftext|> <s> ▁x"),
    (10, "x" * 5000 + " " + "word " * 9000),
    (None, "The quick brown fox jumps over the lazy dog and runs away"),
]


@pytest.fixture()
def texts():
    return TEXTS


@pytest.fixture()
def docs(spark):
    """With columns whose names the operators use inside."""
    rows = [Row(doc_id=i, text=t, lang="en", source=None, n_chars=None, sha="x", score=1.5, n=3, id=i, node="y") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, sha string, score double, n long, id long, node string").repartition(3)
