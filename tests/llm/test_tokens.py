"""Token counts, byte-level BPE and packing against the libraries."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from llm_cases import docs, package_on_workers, texts  # noqa: F401
from sigflow.llm import byte_bpe, packing, token_count
from sigflow.llm.byte_level import ByteLevelTokenizer

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def odd_texts(n=150):
    r = random.Random(5)
    parts = ["the ", "Straße", " ", "  ", "\n", "\t", "▁", "don't", "'s", "☃", "🙂", "1234", "日本語", " ", "\x1c", "#", "<s>", "<|endoftext|>", "é", "\x85", "​", "ab" * 30]
    return ["".join(r.choices(parts, k=r.randint(0, 40))) for _ in range(n)]


def test_token_counts_equal_the_library(spark, docs, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted(map(tuple, token_count.token_counts(docs, PIECES).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t in texts]
    assert got == sorted(want, key=str)
    count = token_count.MergeCounter(PIECES).count
    for t in odd_texts():
        assert count(t) == len(sp.encode(t)), t


def test_byte_bpe_equals_the_library_and_round_trips(spark, docs, texts):
    enc = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in texts:
        ids = enc.encode_ordinary(t or "")
        data = np.array(ids, dtype="<u4").tobytes()
        assert (i, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) in got
    back = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), r.data.decode()) for r in back) == sorted((str(i), t or "") for i, t in texts)


def test_segments_are_safe(monkeypatch):
    enc = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    for t in odd_texts():
        parts = list(byte_bpe.segments(t, 7))
        assert "".join(parts) == t
        assert [x for p in parts for x in enc.encode_ordinary(p)] == enc.encode_ordinary(t)


def packed_rows(df):
    rows = [r.asDict() for r in df.collect()]
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    return rows, by_sequence


def test_packing_holds_each_document_once(spark, docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    rows, sequences = packed_rows(packing.pack(docs, JSON))
    want = []
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        cut = len(ids) % 1024 or 1024
        bounds = [0, *range(cut, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want.append((str(i), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(want) == sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert len(sequences) >= math.ceil(sum(r["length"] for r in rows) / 1024)


def test_parts_encode_like_whole_texts():
    tokenizer = ByteLevelTokenizer(JSON, specials=True)
    for t in odd_texts():
        assert tokenizer.encode(t) == tokenizer.library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(12))
def test_plan_packs_all_and_is_optimal_on_small_cases(seed):
    r = random.Random(seed)
    counts = Counter(r.randint(1, 20) for _ in range(r.randint(1, 9)))
    plan = packing.plan_sequences(counts, 20)
    assert sum((Counter({n: k * times for n, k in Counter(f).items()}) for f, times in plan), Counter()) == counts
    assert all(sum(f) <= 20 for f, _ in plan)
    assert sum(times for _, times in plan) == fewest([n for n, c in counts.items() for _ in range(c)], 20)


def fewest(items, capacity):
    best = len(items)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for i, b in enumerate(bins):
            if b + items[k] <= capacity:
                place(k + 1, [*bins[:i], b + items[k], *bins[i + 1 :]])
        place(k + 1, [*bins, items[k]])

    place(0, [])
    return best


def test_large_plan_reaches_the_bound():
    r = random.Random(1)
    counts = Counter(min(1024, int(r.lognormvariate(5.5, 1.0)) + 1) for _ in range(60_000))
    plan = packing.plan_sequences(counts, 1024)
    assert sum(times for _, times in plan) <= packing.lower_bound(counts, 1024) * 1.001 + 1


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert packing.pack(none, JSON).count() == 0
    assert token_count.token_counts(none, PIECES).count() == 0
    assert byte_bpe.round_trip(none, RANKS, public_tokenizers.PATTERN).count() == 0
