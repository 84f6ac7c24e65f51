"""Ranked search against a plain version."""

import math
import re
from collections import Counter, defaultdict

import pytest

from llm_cases import docs, package_on_workers, texts  # noqa: F401
from sigflow.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    return TERM.findall(low)


def plain(documents, items, top):
    """(item, rank, doc, score) by the contract's words."""
    counts = [(i, Counter(terms(t))) for i, t in documents]
    n_docs = sum(bool(c) for _, c in counts)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item].update(terms(text))
    out = []
    for item, own in wanted.items():
        scored = []
        for i, c in counts:
            n, score = sum(c.values()), 0
            for t in own & c.keys():
                m = 100 - 90 + (90 * n * n_docs) // n_terms
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i, score))
        out += [(item, k, i, s) for k, (_, _, i, s) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:top], 1)]
    return out


ITEMS = [(1, "the QUICK fox, the dog!"), (2, "Naïve ☃ \x85 word"), (3, None), (4, ""), (5, "eins"), (5, "zwei zwei"), (6, "nowhere"), (None, "lazy dog"), (7, "<|endoftext|> x"), (1, "jumps")]


def found(df):
    return [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()]


@pytest.mark.parametrize(("top", "block"), [(10, 1 << 22), (2, 1 << 22), (3, 16)])
def test_equals_plain_version(spark, docs, texts, monkeypatch, top, block):  # noqa: F811
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block)
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, score int")
    got = found(lexical_search.search(docs, items, top))
    assert sorted(got, key=str) == sorted(plain(texts, ITEMS, top), key=str)


def test_scores_that_tie_go_by_id_and_ranks_are_unique(spark):
    rows = [(i, "same words here") for i in (9, 3, 7, 3)] + [(1, "other text")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    got = found(lexical_search.search(docs, items, 3))
    assert [(r, i) for _, r, i, _ in sorted(got)] == [(1, 3), (2, 3), (3, 7)]


def test_long_text_is_scanned_whole(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "SEGMENT", 64)
    machine = lexical_search.TermAutomaton(["the", "äb", "cd" * 50])
    text = "The thethe äb, " * 500 + "cd" * 50 + " the"
    want = Counter(terms(text))
    got = machine.frequencies(lexical_search.folded(text))
    assert got == {0: want["the"], 1: want["äb"], 2: 1}
    assert lexical_search.count_terms(lexical_search.folded(text)) == sum(want.values())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert found(lexical_search.search(none, items)) == []
    assert found(lexical_search.search(docs, items.limit(0))) == []
    assert found(lexical_search.search(docs.filter("doc_id = 2"), items)) == []
