"""Exact dedup, the Jaccard join and the pipeline against brute force."""

import random

import pytest

import corpus_pipeline
from conftest import SF001
from llm_cases import docs, package_on_workers, texts  # noqa: F401
from sigflow.llm import exact_dedup, jaccard_join, quality
from sigflow.llm.common import read_table, staged
from sigflow.llm.components import components


def test_exact_dedup_rows(spark, docs, texts):
    import re

    groups = {}
    for i, t in texts:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    for bits in (60, 4):  # with 4 bits keys collide
        rows = exact_dedup.exact_dedup(docs, key_bits=bits, capacity=64).collect()
        assert len(rows) == len(texts)
        sizes = {(r.doc_id, r.keep_id, r.group_size) for r in rows}
        for own in groups.values():
            least = min(i for i in own if i is not None)
            assert {(i, least, len(own)) for i in own} <= sizes
        assert sum(r.kept for r in rows) == len(groups)
    assert exact_dedup.keep_first(docs).count() == len(groups)
    assert exact_dedup.keep_first(docs).columns == docs.columns
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_directory_doubles():
    sizes = {p: 10 for p in range(16)} | {3: 1000}
    d = exact_dedup.build_directory(sizes, 4, 25)
    assert d.depth == 4 and len(d.slots) == 16 and d.slots == sorted(d.slots, key=d.slots.index)
    load = {}
    for p, n in sizes.items():
        load[d.slots[p]] = load.get(d.slots[p], 0) + n
    assert all(n <= 25 or n == 1000 for n in load.values())


def brute(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {(i, len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n=160):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") + str(r.randint(0, 60))
    passage = [word() for _ in range(40)]
    base = [[word() for _ in range(r.randint(3, 120))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = word()
        if r.random() < 0.3:
            w += passage
        rows.append((i * 7 % 1000, (" " if i % 2 else "\n").join(w)))
    return rows


@pytest.mark.parametrize("most", [400_000, 300])
def test_jaccard_components_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard_join, "BLOCK_NGRAMS", most)  # 300: groups of many blocks
    rows = near_copies(3) + [(2001, None), (2002, ""), (2003, "a b"), (2004, "A  b"), (2005, "x " * 40_000)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, node int").repartition(5)
    got = {tuple(r) for r in jaccard_join.jaccard_components(frame).collect()}
    assert got == brute(rows)


def test_prefix_tree_block_equals_brute_force():
    r = random.Random(2)
    base = [sorted(r.sample(range(400), r.randint(1, 60))) for _ in range(8)]
    sets = []
    for _ in range(120):
        s = set(r.choice(base))
        for _ in range(r.randint(0, 5)):
            s ^= {r.randrange(400)}
        sets.append(sorted(s or {1}))
    up = list(range(len(sets)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            x, y = set(sets[a]), set(sets[b])
            if 100 * len(x & y) >= 75 * len(x | y):
                up[max(find(a), find(b))] = min(find(a), find(b))
    want = [find(i) for i in range(len(sets))]
    forest = list(range(len(sets)))
    for a, b in jaccard_join.join_block(sets, [True] * len(sets), list(range(len(sets)))):
        forest[b] = a
    assert forest == want


def test_jaccard_edges(spark, docs):
    rows = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert rows[1] == rows[2] == rows[3] == 1 and rows[4] == 4 and rows[8] == 7 and rows[None] is None and rows[9] == 9
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0
    assert jaccard_join.keep_representatives(docs).columns == docs.columns


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8), (8, 8), (4, 1), (None, 1)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8)}


def test_pipeline_stages(spark):
    docs = read_table(spark, SF001, "documents")
    columns, kept = docs.columns, [{r.doc_id for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF001), "test-stage")
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.collect()})
        assert kept[-1] <= kept[-2]
        if name == "quality rules":
            good = quality.quality_rules(read_table(spark, SF001, "documents")).filter("kept").collect()
            assert kept[-1] == kept[-2] & {r.doc_id for r in good}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert all(i == c for i, _, c in brute(rows)) and len({t for _, t in rows}) == len(rows)
    out = corpus_pipeline.run(spark, SF001)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == kept[-1]
