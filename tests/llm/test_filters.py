"""WARC, licences, urls, quality and toxicity."""

import gzip
import hashlib
import io

import duckdb
import numpy as np
import pytest

from conftest import SF001, SF01
from llm_cases import docs, package_on_workers  # noqa: F401
from sigflow.llm import license_rules, quality, queries, toxicity, url_filter, warc
from sigflow.llm.common import read_table
from sigflow.plans.compare import compare, duckdb_connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    out = compare(spark, SF001, name, queries.QUERIES[name], queries.ORACLE_SQL[name], duckdb_connection(SF001))
    assert out.ok, out.detail


# -------------------------------------------------------------------- WARC
def records(n, size=300):
    return [warc.page_record(i, f"http://h/{i}", bytes([65 + i]) * size, None, "2024-01-01T00:00:00Z") for i in range(n)]


def read(data):
    found = list(warc.salvage(io.BytesIO(data)))
    keys = [x.headers.get("x-page-id") for x in found if isinstance(x, warc.Record)]
    return keys, [(x.offset, x.length) for x in found if isinstance(x, warc.Gap)]


@pytest.mark.parametrize("pack", [bytes, warc.compressed, gzip.compress])
def test_salvage_recovers_later_records(pack):
    parts = [pack(r) for r in records(4)]
    whole = b"".join(parts)
    assert read(whole) == (["0", "1", "2", "3"], [])
    first, second = len(parts[0]), len(parts[0]) + len(parts[1])
    for at in (first, first + 12, second - 30):
        broken = bytearray(whole)
        broken[at] ^= 0xFF
        assert read(bytes(broken)) == (["0", "2", "3"], [(first, len(parts[1]))])
    junk = b"junk \x1f\x8b\x08 and WARC/1.1 more"
    assert read(parts[0] + junk + parts[1]) == (["0", "1"], [(first, len(junk))])
    assert read(parts[0] + parts[1][:-5]) == (["0"], [(first, len(parts[1]) - 5)])
    assert read(b"") == ([], [])
    assert read(junk) == ([], [(0, len(junk))])


def test_archives_read_back(spark):
    long, short = "ä" * 600, "s" * 999
    rows = [(1, "http://a/\n", long), (2, None, long), (5, "u", long), (3, "u", short), (4, "u", short), (6, "u", None), (None, "u", long), (7, "u", "b" * 200_000), (7, "u", "b" * 200_000)]
    pages = spark.createDataFrame([(*r, 0, "d") for r in rows], "page_id long, url string, html string, id int, digest string")
    got = sorted(map(tuple, warc.archive_pages(pages).collect()), key=str)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        keeper = 5 if html == long and i != 5 else None
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if keeper else "response", keeper))
    assert got == sorted(want, key=str)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_reader_reports_gaps_and_payloads(spark, scratch):
    parts = [warc.compressed(r) for r in records(3)]
    with open(f"{scratch}/a.warc.gz", "wb") as f:
        f.write(parts[0] + b"?" * 10 + parts[1] + parts[2][:50])
    rows = warc.read_warc(warc.list_warc(spark, scratch)).orderBy("offset").collect()
    assert [(r.kind, r.length) for r in rows] == [("record", len(parts[0])), ("gap", 10), ("record", len(parts[1])), ("gap", 50)]
    assert rows[2].payload == b"B" * 300


# ------------------------------------------------------- licences and urls
def test_license_sequences(spark, docs):
    text = (
        "Licensed under the Apache License, Version 2.0. Some words. You may not use this file except in compliance"
        " with the License.\nReleased under the MIT License.\nreleased  under the MIT license!\n"
    )
    frame = spark.createDataFrame([(1, text, 1), (2, None, 2), (3, "", 3)], "doc_id long, text string, licenses int")
    rows = {r.doc_id: r for r in license_rules.scan_licenses(frame).collect()}
    assert rows[1].sentence_ids == ["apache2.notice", "apache2.mayNotUse", "mit.notice", "mit.notice"]
    assert rows[1].licenses == ["Apache-2.0", "MIT", "MIT"] and rows[1].license == "Apache-2.0 AND MIT"
    assert rows[2].licenses == [] and rows[2].license is None
    assert license_rules.scan_licenses(docs.limit(0)).count() == 0


def test_url_rules_and_terms(spark):
    urls = {
        "http://A.Example.NET/en/x": ("example.net/en/", "allow"),
        "http://example.net/de/": ("net/", "block"),
        "http://example.net?x": (None, "allow"),
        "http://notexample.com/de/": (None, "allow"),
        "https://m.example.com/de/1": ("example.com/de/", "block"),
        "x://org/fr/": ("org/fr/", "allow"),
        "http://h.io/free-casino": (None, "block"),
        "http://h.io/casino/casino": (None, "allow"),
        "http://h.io/xxx.html": (None, "block"),
        "http://h.io/axxx": (None, "allow"),
        "no scheme PORN": (None, "block"),
        "": (None, "allow"),
        None: (None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(pages).collect()}
    assert got == dict(enumerate(urls.values()))


# --------------------------------------------------------- quality, toxicity
def test_quality_counts(spark, docs):
    line = "one two three four five six seven eight"
    text = f"{line}\n{line}\n\n#x | y\n" + " ".join(f"w{i}" for i in range(60))
    rows = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).collect()}
    assert (rows[1].n_words, rows[1].n_dup_lines, rows[1].n_repeat_words, rows[1].n_symbols) == (79, 1, 16, 2)
    assert not rows[1].base_failed and rows[2].base_failed and not rows[2].kept
    assert quality.quality_rules(docs).count() == docs.count()
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.quality_rules(docs.limit(0)).count() == 0


def test_toxicity_learns_and_spares_clean_rows(spark, docs):
    found = toxicity.toxicity(read_table(spark, SF01, "documents"), read_table(spark, SF01, "labels")).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{SF01}/labels.parquet'").df()
    m = found.merge(labels, on="doc_id")
    held = m[m.held_out]
    rank = held.score.rank()
    ones, n = rank[held.toxic == 1], (held.toxic == 1).sum()
    assert (ones.sum() - n * (n + 1) / 2) / (n * (len(held) - n)) > 0.85
    assert held[held.toxic == 0].predicted.mean() < 0.05
    assert found.score.between(0, 1).all() and len(found) == 1000


def test_toxicity_shares_misspellings():
    s = toxicity.Settings()
    texts = [f"some calm words about stone {i} and water" + (" you stupid idiot" if i % 3 == 0 else " you gentle friend") for i in range(120)]
    bags = [toxicity.text_bag(t, s, {}) for t in texts]
    import numpy as np

    model = toxicity.fit(bags, np.array([int(i % 3 == 0) for i in range(120)]), s)
    score = toxicity.Scorer(model.slot_scores(), model.base, s).score
    assert score("some calm words about you stupiid idiott") > 0.5 > score("some calm words about you gentle friends")


def test_toxicity_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(docs, none).collect()
    assert len(rows) == docs.count() and all(r.predicted == 0 for r in rows)
    assert toxicity.keep_clean(docs, none).columns == docs.columns
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


# ------------------------------------------------- toxicity, by brute force
def _loss(model, bags, labels):
    total = 0.0
    for (slot, weight), label in zip(bags, labels, strict=True):
        hidden = sum((w * model.vectors[k].astype(float) for k, w in zip(slot, weight, strict=True)), np.zeros(model.vectors.shape[1]))
        logits = hidden @ model.classes.astype(float) + model.bias.astype(float)
        total += np.log(np.exp(logits).sum()) - logits[label]
    return total


def test_toxicity_step_follows_the_numeric_gradient():
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(0, 0.5, (12, 3)), rng.normal(0, 0.5, (3, 2)), rng.normal(0, 0.5, 2))
    bags = [(np.sort(rng.choice(12, 4, replace=False)).astype(np.int32), rng.random(4)) for _ in range(5)]
    labels = np.array([0, 1, 1, 0, 1])
    before = [a.copy() for a in (model.vectors, model.classes, model.bias)]
    want = []
    for a in (model.vectors, model.classes, model.bias):
        g = np.zeros_like(a)
        for at in np.ndindex(a.shape):
            a[at] += 1e-5
            up = _loss(model, bags, labels)
            a[at] -= 2e-5
            g[at] = (up - _loss(model, bags, labels)) / 2e-5
            a[at] += 1e-5
        want.append(g)
    seen = [np.ones_like(a) for a in before]
    toxicity._step(model, seen, bags, labels, 0.1)
    for a, old, g, rate in zip((model.vectors, model.classes, model.bias), before, want, (0.1, 0.03, 0.03), strict=True):
        assert np.allclose(old - a, rate * g / np.sqrt(1 + g**2), atol=1e-5)


def test_toxicity_score_is_the_average_over_words_and_parts():
    s = toxicity.Settings()
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(0, 1, (s.slots, s.width)).astype(np.float32), rng.normal(0, 1, (s.width, 2)).astype(np.float32), np.array([0.2, -0.1], np.float32))
    scorer = toxicity.Scorer(model.slot_scores(), model.base, s)
    for text in ("Some words, some WORDS again", "naïve Straße ☃", "x", "", "12 34"):
        slot, weight = toxicity.text_bag(text, s, {})
        logits = (weight @ model.vectors[slot] if len(slot) else np.zeros(s.width)) @ model.classes + model.bias
        want = 1 / (1 + np.exp(logits[0] - logits[1]))
        assert abs(scorer.score(text) - want) < 1e-5
