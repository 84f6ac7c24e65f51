"""Cross-tokenizer alignment against a quadratic version with both libraries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF001
from llm_cases import docs, package_on_workers, texts  # noqa: F401
from sigflow.llm import cross_align
from sigflow.llm.byte_level import ByteLevelTokenizer, byte_alphabet
from sigflow.llm.common import read_table

JSON = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def spans(lengths):
    ends = np.cumsum([0, *lengths]).tolist()
    return list(zip(ends, ends[1:]))


def plain(rows, both):
    """Per row what the contract asks, by comparing all tokens of a text."""
    a_lib, b_lib = both
    byte = byte_alphabet()
    out, linked, corpus = [], [], Counter()
    for i, text in rows:
        text = text or ""
        ids_a, ids_b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
        bytes_a = [bytes(byte[c] for c in a_lib.id_to_token(t)) for t in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(t) else p.replace("▁", " ").encode() for t in ids_b for p in [b_lib.id_to_piece(t)]]
        want = (" " + text).encode()
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            out.append([i, 0, 0, 0, 0, ""])
            linked.append([])
            continue
        at_a, at_b = spans(map(len, bytes_a)), spans(map(len, bytes_b))
        own = [(x, y) for (s, e), x in zip(at_a, ids_a) for (u, v), y in zip(at_b, ids_b) if s < v and u < e]
        cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups, begin = [], 0
        for c in cuts:
            parts = [",".join(str(x) for (s, e), x in zip(at, ids) if begin <= s and e <= c) for at, ids in ((at_a, ids_a), (at_b, ids_b))]
            groups.append("|".join(parts))
            begin = c
        out.append([i, len(ids_a), len(ids_b), len(cuts), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest()])
        linked.append(own)
        corpus.update(set(own))
    best = defaultdict(int)
    for (x, _), n in corpus.items():
        best[x] = max(best[x], n)
    return sorted((*r, sum(corpus[p] == best[p[0]] for p in own), sum(corpus[p] for p in own)) for r, own in zip(out, linked))


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
SHORT = [
    (1, "The quick brown fox"), (2, "the  quick\tbrown fox \n"), (3, None), (4, ""), (5, " "), (6, "▁x"), (7, "naïve ça ☃ 🙂"),
    (8, "a \x85 b \x00 c"), (9, "<|endoftext|> <s> </s> <unk> <0x41>"), (10, "x" * 300), (11, "3.14159 2024-01-01"), (12, "日本語 テキスト"),
    (13, "The quick brown fox"), (13, "The quick brown fox"), (14, "ﬁ ligature ①"), (15, "▁"), (16, " leading"), (17, "'s 'LL don't"),
]


def result(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


@pytest.mark.parametrize("chunk", [12 << 20, 40])
def test_equals_quadratic_version(spark, both, monkeypatch, chunk):
    monkeypatch.setattr(cross_align, "CHUNK_BYTES", chunk)
    given = spark.createDataFrame([(i, t, 1, "x") for i, t in SHORT], "doc_id long, text string, chunk int, n_a string").repartition(3)
    assert result(cross_align.align_tokens(given, JSON, MODEL)) == plain(SHORT, both)


def test_equals_quadratic_version_on_documents(spark, both):
    rows = read_table(spark, SF001, "documents").filter("length(text) < 1500").select("doc_id", "text")
    assert result(cross_align.align_tokens(rows, JSON, MODEL)) == plain([tuple(r) for r in rows.collect()], both)


def test_edge_rows(docs, texts):  # noqa: F811
    got = cross_align.align_tokens(docs, JSON, MODEL).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted((i for i, _ in texts), key=str)
    assert all((r["n_links"] == 0) == (r["groups_sha256"] == "") for r in got)
    assert cross_align.align_tokens(docs.limit(0), JSON, MODEL).collect() == []


def test_links_and_group_links():
    aligner = cross_align.Aligner(JSON, MODEL)
    texts = [t or "" for _, t in SHORT]
    x = aligner.align(texts)
    blocks = list(x.group_links())
    row, col = (np.concatenate([b[k] for b in blocks]) for k in (0, 1))
    assert len(row) == x.n_group_links().sum()
    assert (x.groups_a.indices[row] == x.groups_b.indices[col]).all()
    held = set(zip(row.tolist(), col.tolist()))
    assert held >= set(zip(x.row.tolist(), x.col.tolist()))
    # The bytes that links share are the texts' bytes.
    assert x.shared.sum() == sum(len(f" {t}".encode()) for t, n in zip(texts, x.n_a) if n)


def test_links_table(spark, both):
    given = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    ids = zip(both[0].encode(" a b").ids, both[1].encode("a b"), strict=True)
    want = [(1, k, k, a, b, 2) for k, (a, b) in enumerate(ids)]
    assert [tuple(r) for r in cross_align.links(given, JSON, MODEL).orderBy("a").collect()] == want


def test_gustavson_equals_dense_product():
    rng = np.random.default_rng(1)
    for most in (1, 7, 1000):
        a, b = rng.random((9, 6)) < 0.4, rng.random((6, 8)) < 0.4
        parts = list(cross_align.gustavson(csr(a), csr(b), most))
        got = np.zeros((9, 8), int)
        for r, c, v in parts:
            got[r, c] = v
        assert (got == a.astype(int) @ b.astype(int)).all()
        assert (cross_align.entries_by_row(csr(a), csr(b)) == (a.astype(int) @ b.astype(int)).sum(1)).all()
        back = csr(a).transposed()
        assert (back.indptr == csr(a.T).indptr).all()
        assert (back.indices == csr(a.T).indices).all()


def csr(dense):
    return cross_align.Csr(np.concatenate(([0], np.cumsum(dense.sum(1)))), np.nonzero(dense)[1], dense.shape[1])


@pytest.mark.parametrize("specials", [True, False])
def test_byte_level_equals_library(specials):
    own = ByteLevelTokenizer(JSON, specials)
    assert own.fast is not None
    samples = [t or "" for _, t in SHORT] + ["<|endoftext|>" * 2 + " a<|endoftext|>", " " * 1_200_000 + "a", "ab  \n\n c" * 20_000, "᠎​  x　 \x1c"]
    for t in samples:
        assert own.encode(t) == own.library.encode(t, add_special_tokens=False).ids
