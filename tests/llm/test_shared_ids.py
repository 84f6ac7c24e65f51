"""One id on several texts in the Jaccard join."""

from llm_cases import package_on_workers  # noqa: F401
from sigflow.llm import jaccard_join


def text(word, n=40):
    return " ".join(f"{word}{i}" for i in range(n))


def test_each_group_keeps_a_representative(spark):
    rows = [
        (3, text("b")),
        (7, text("b") + " end"),  # goes, for 3
        (7, text("a")),  # its component's smallest id: stays
        (9, text("a") + " end"),  # goes, for the 7 above
        (7, text("c")),
        (None, text("a")),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()}
    assert found == {(3, 3), (7, 3), (7, 7), (9, 7), (None, None)}
    kept = sorted(map(tuple, jaccard_join.keep_representatives(docs).collect()), key=str)
    assert kept == sorted([rows[0], rows[2], rows[4], rows[5]], key=str)
