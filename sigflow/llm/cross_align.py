"""Cross-tokenizer alignment by token-byte incidence matrices.

A text's tokens under tokenizer A (byte-level BPE) and under tokenizer B
(sentencepiece) are rows of two incidence matrices over the text's bytes, in
CSR. Gustavson's row products A·Bᵀ give the overlap links: an entry is a pair
of tokens, its value the bytes they share. Where a token of both ends, the
text is cut into groups; the products of the token-group incidence matrices
give the links within groups. Their rows are counted by the symbolic phase
and only made in blocks of bounded size, as a group may hold many tokens.

The texts of a batch are laid end to end, so one product serves them all: a
text's end is an end of both tokenizers, and no link crosses it.

How many documents hold an id pair linked is counted over the whole corpus:

1. Each task walks its documents in chunks of bounded bytes. It writes a
   chunk's distinct id pairs with the chunk's documents that hold them, and
   its documents' links as places in that list, with how often they occur.
2. Spark sums the pairs, finds the highest count of each A id (which has at
   most as many partners as B has ids), and joins both to the chunks' pairs.
3. A chunk's counts go to its documents: sums over links, links that are best.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigflow.llm.byte_level import ByteLevelTokenizer
from sigflow.llm.common import arrow_schema, small_batches, staged, text_or_empty, worker_state

#: Bytes of the texts of a chunk, of a batch that is aligned at once, and
#: entries of a product that are made at once.
CHUNK_BYTES = 12 << 20
BATCH_BYTES = 1 << 20
BLOCK_ENTRIES = 4 << 20
#: Id pairs of an output batch.
PAIRS = 20_000


# --------------------------------------------------------------------- CSR
@dataclass(frozen=True)
class Csr:
    """A matrix of zeros and ones: the columns of row r are
    ``indices[indptr[r] : indptr[r + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    n_cols: int

    @property
    def n_rows(self) -> int:
        return len(self.indptr) - 1

    def sizes(self) -> np.ndarray:
        return np.diff(self.indptr)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(self.n_rows), self.sizes())
        order = np.argsort(self.indices, kind="stable")
        return Csr(_starts(np.bincount(self.indices, minlength=self.n_cols)), rows[order], self.n_rows)


def _starts(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def _ramps(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    out = np.arange(sizes.sum())
    out += np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return out


def incidence(lengths: np.ndarray) -> Csr:
    """Tokens x bytes: the tokens cover the bytes in their order."""
    ends = _starts(lengths)
    return Csr(ends, np.arange(ends[-1]), int(ends[-1]))


def entries_by_row(a: Csr, b: Csr) -> np.ndarray:
    """Symbolic phase of a·b: multiplications in each of a's rows."""
    made = _starts(b.sizes()[a.indices])
    return made[a.indptr[1:]] - made[a.indptr[:-1]]


def gustavson(a: Csr, b: Csr, most: int = BLOCK_ENTRIES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """a·b by rows: for each entry (r, k) of ``a`` the row k of ``b`` is added
    to row r of the product. Blocks of whole rows as (row, column, value), in
    order; a block has about ``most`` multiplications, or is one row."""
    work = _starts(entries_by_row(a, b))
    begin = 0
    while begin < a.n_rows:
        end = max(begin + 1, int(np.searchsorted(work, work[begin] + most, "right")) - 1)
        k = a.indices[a.indptr[begin] : a.indptr[end]]
        sizes = b.indptr[k + 1] - b.indptr[k]
        cols = b.indices[_ramps(b.indptr[k], sizes)]
        rows = np.repeat(np.arange(begin, end), work[begin + 1 : end + 1] - work[begin:end])
        key = rows * b.n_cols + cols
        if len(key) > 1 and (key[1:] < key[:-1]).any():
            key.sort()
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        at = key[first]
        yield at // b.n_cols if b.n_cols else at, at % b.n_cols if b.n_cols else at, np.diff(np.append(first, len(key)))
        begin = end


# --------------------------------------------------------------- tokenizers
class PieceTokenizer:
    """Identifiers and token bytes of a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i in ids for p in [self.model.id_to_piece(i)]]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def lengths(self) -> np.ndarray:
        return np.array([len(t) for t in self.tokens], np.int64)


@dataclass
class Alignment:
    """The links of a batch of texts. Texts without tokens have none."""

    a: np.ndarray  # ids of all texts' tokens under A
    b: np.ndarray
    n_a: np.ndarray  # tokens of each text
    n_b: np.ndarray
    row: np.ndarray  # links: token of A, token of B, bytes in common
    col: np.ndarray
    shared: np.ndarray
    groups_a: Csr  # tokens of A x groups
    groups_b: Csr

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Links between the tokens of a group, in blocks."""
        return gustavson(self.groups_a, self.groups_b.transposed())

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text of a value for each token of A."""
        return np.diff(_starts(values)[_starts(self.n_a)])

    def n_links(self) -> np.ndarray:
        return self.per_text(np.bincount(self.row, minlength=len(self.a)))

    def n_group_links(self) -> np.ndarray:
        return self.per_text(entries_by_row(self.groups_a, self.groups_b.transposed()))

    def n_groups(self) -> np.ndarray:
        of_group = self.groups_a.indices
        ends = np.concatenate((of_group[1:] != of_group[:-1], [True])) if len(of_group) else np.zeros(0, bool)
        return self.per_text(ends.astype(np.int64))


class Aligner:
    """Aligns the tokens of texts under a byte-level BPE file (A, given a
    space and the text) and a sentencepiece model (B, which adds the space)."""

    def __init__(self, a_path: str, b_path: str):
        self.tok_a, self.tok_b = ByteLevelTokenizer(a_path, specials=False), PieceTokenizer(b_path)
        self.len_a, self.len_b = self.tok_a.lengths(), self.tok_b.lengths()
        self.n_b_ids = len(self.len_b)
        # A token of A with what follows it, then one of B.
        self.parts = [f"{i}{end}" for end in ",|" for i in range(len(self.len_a))] + [f"{i}{end}" for end in ",;" for i in range(self.n_b_ids)]

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text under both; none where the tokens' bytes aren't
        the text's with a space before it, under either."""
        found_a, found_b = [], self.tok_b.encode(texts)
        of_a, of_b = self.tok_a.tokens, self.tok_b.tokens
        for i, t in enumerate(texts):
            a: list[int] = []
            if t:
                want = b" " + t.encode()
                if b"".join(map(of_b.__getitem__, found_b[i])) == want:
                    a = self.tok_a.encode(" " + t)
                    if b"".join(map(of_a.__getitem__, a)) != want:
                        a = []
            found_a.append(a)
            if not a:
                found_b[i] = []
        return found_a, found_b

    def align(self, texts: list[str]) -> Alignment:
        found_a, found_b = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in found], np.int64) for found in (found_a, found_b))
        a, b = (np.array([i for own in found for i in own], np.int64) for found in (found_a, found_b))
        by_byte_a, by_byte_b = incidence(self.len_a[a]), incidence(self.len_b[b])
        blocks = list(gustavson(by_byte_a, by_byte_b.transposed()))
        none = np.zeros(0, np.int64)
        row, col, shared = (np.concatenate(x) for x in zip(*blocks, strict=True)) if blocks else (none, none, none)
        ends_a, ends_b = by_byte_a.indptr[1:], by_byte_b.indptr[1:]
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        groups = [Csr(np.arange(len(ends) + 1), np.searchsorted(cuts, ends), len(cuts)) for ends in (ends_a, ends_b)]
        return Alignment(a, b, n_a, n_b, row, col, shared, *groups)

    def group_texts(self, x: Alignment) -> list[str]:
        """Each text's groups: ids of A joined by commas, a bar, ids of B;
        groups joined by semicolons."""
        of_a, of_b = x.groups_a.indices, x.groups_b.indices
        # Places in the merged order: all of A before all of B in a group.
        at_a = np.arange(len(of_a)) + np.searchsorted(of_b, of_a)
        at_b = np.arange(len(of_b)) + np.searchsorted(of_a, of_b, "right")
        last_a, last_b = (np.concatenate((g[1:] != g[:-1], [True] * bool(len(g)))) for g in (of_a, of_b))
        code = np.empty(len(of_a) + len(of_b), np.int64)
        code[at_a] = x.a + last_a * len(self.len_a)
        code[at_b] = 2 * len(self.len_a) + x.b + last_b * self.n_b_ids
        said = list(map(self.parts.__getitem__, code.tolist()))
        at = _starts(x.n_a + x.n_b).tolist()
        return ["".join(said[i:j])[:-1] for i, j in zip(at, at[1:], strict=False)]


# ------------------------------------------------------------------- Spark
def _byte_batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


class _Chunk:
    """The links of a chunk's documents until it is written."""

    def __init__(self):
        self.size = 0
        self.rows: list[dict] = []
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, size: int, row: dict, key: np.ndarray, times: np.ndarray) -> None:
        self.size += size
        self.rows.append(row)
        self.keys.append(key)
        self.times.append(times)

    def written(self, name: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Rows of documents, then of id pairs."""
        pairs, at, docs = np.unique(np.concatenate(self.keys), return_inverse=True, return_counts=True)
        begin = 0
        for row, own, times in zip(self.rows, self.keys, self.times, strict=True):
            places = at[begin : begin + len(own)].astype(np.uint32)
            begin += len(own)
            data = zstandard.compress(np.concatenate([places, times.astype(np.uint32)]).tobytes(), 1)
            yield _batch({"chunk": [name], "docs": [row], "links": [data]}, schema)
        for i in range(0, len(pairs), PAIRS):
            n = len(pairs[i : i + PAIRS])
            columns = {"chunk": np.full(n, name), "place": np.arange(i, i + n), "pair": pairs[i : i + n], "n": docs[i : i + n]}
            yield _batch(columns, schema)


def _batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    n = len(columns["chunk"])
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


_DOC = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_group_links bigint, n_distinct bigint, groups_sha256 string"


def _aligned(rows: DataFrame, a_path: str, b_path: str, kind: str) -> DataFrame:
    """Rows of documents (chunk, docs: arrays by column, links) and of id
    pairs (chunk, place, pair, n)."""
    fields = ", ".join(f"{f.split()[0]}:array<{f.split()[1]}>" for f in [f"id {kind}", *_DOC.split(", ")])
    ddl = f"chunk bigint, docs struct<{fields}>, links binary, place bigint, pair bigint, n bigint"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner: Aligner = worker_state(f"align:{a_path}:{b_path}", lambda: Aligner(a_path, b_path))
        name, chunk = TaskContext.get().partitionId() << 32, _Chunk()
        for batch in small_batches(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in _byte_batches(texts):
                x = aligner.align(texts[i:j])
                of_text = np.repeat(np.arange(j - i), x.n_a)[x.row]
                pair = x.a[x.row] * aligner.n_b_ids + x.b[x.col]
                # One key for a text and an id pair.
                span = len(aligner.len_a) * aligner.n_b_ids
                key, times = np.unique(of_text * span + pair, return_counts=True)
                sha = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in aligner.group_texts(x)]
                distinct = np.bincount(key // span, minlength=j - i)
                row = {"id": ids[i:j], "n_a": x.n_a, "n_b": x.n_b, "n_groups": x.n_groups(), "n_links": x.n_links(), "n_group_links": x.n_group_links(), "n_distinct": distinct}
                row = {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in row.items()} | {"groups_sha256": sha}
                chunk.add(sum(map(len, texts[i:j])), row, key % span, times)
                if chunk.size >= CHUNK_BYTES:
                    yield from chunk.written(name, schema)
                    name, chunk = name + 1, _Chunk()
        if chunk.rows:
            yield from chunk.written(name, schema)

    return rows.mapInArrow(run, ddl)


def _counted(aligned: DataFrame, n_b_ids: int) -> DataFrame:
    """(chunk, place, value): the corpus count of each chunk's id pairs,
    doubled, and one more if it is the highest of its A id."""
    pairs = aligned.filter("pair IS NOT NULL").select("chunk", "place", "pair", "n")
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("a", F.floor(F.col("pair") / n_b_ids))
    # A row per B id at most in a window.
    highest = F.max("count").over(Window.partitionBy("a"))
    value = 2 * F.col("count") + (F.col("count") == highest).cast("long")
    judged = counts.select("pair", value.alias("value"))
    # Both sides grow with the input: never broadcast, whatever its size now.
    return pairs.join(judged.hint("merge"), "pair").select("chunk", "place", "value")


def _summed(both: DataFrame, kind: str) -> DataFrame:
    """The rows of a chunk, counts first, as rows of documents."""
    ddl = f"id {kind}, {_DOC.replace('n_distinct bigint', 'n_best bigint, count_sum bigint')}"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, values, parts = None, np.zeros(0, np.int64), []
        for batch in batches:
            names = batch.column("chunk").to_numpy()
            known = batch.column("value").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.concatenate(([True], (names[1:] != names[:-1]) | (known[1:] != known[:-1]))))
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(names)], strict=True):
                if names[i] != chunk:
                    chunk, parts = names[i], []
                if known[i]:
                    parts.append(batch.column("value").slice(i, j - i).to_numpy())
                    continue
                values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
                parts = [values]
                for docs, links in zip(batch.column("docs").slice(i, j - i).to_pylist(), batch.column("links").slice(i, j - i).to_pylist(), strict=True):
                    at, times = np.frombuffer(zstandard.decompress(links), np.uint32).reshape(2, -1).astype(np.int64)
                    own = values[at]
                    ends = _starts(np.array(docs.pop("n_distinct"), np.int64))
                    best, total = _starts(times * (own & 1)), _starts(times * (own >> 1))
                    docs |= {"n_best": np.diff(best[ends]), "count_sum": np.diff(total[ends])}
                    yield pa.RecordBatch.from_arrays([pa.array(docs[f.name], f.type) for f in schema], schema=schema)

    return both.mapInArrow(run, ddl)


def align_tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_a, n_b (tokens), n_groups, n_links,
    n_group_links, groups_sha256, n_best and count_sum.

    A null or empty text, and one whose tokens' bytes are not those of a
    space and the text under either tokenizer, has no tokens: zeros and an
    empty string. Repeated rows are documents of their own and come back as
    such, as do rows with a null id; an empty table gives an empty result;
    other columns are ignored. Both files must exist on every executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("t"))
    aligned = staged(_aligned(rows, a_path, b_path, kind), "aligned")
    counted = _counted(aligned, len(PieceTokenizer(b_path).tokens))
    by_doc = aligned.filter("docs IS NOT NULL").select("chunk", "docs", "links", F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("value"))
    both = by_doc.unionByName(counted, allowMissingColumns=True)
    dealt = both.repartition("chunk").sortWithinPartitions("chunk", F.asc_nulls_last("place"))
    return _summed(dealt, kind).withColumnRenamed("id", id_col)


def links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The links themselves: id, a (place of A's token), b, a_id, b_id and
    shared (bytes in common), a row per link."""
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"id {kind}, a bigint, b bigint, a_id bigint, b_id bigint, shared bigint"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner: Aligner = worker_state(f"align:{a_path}:{b_path}", lambda: Aligner(a_path, b_path))
        for batch in small_batches(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, t in zip(ids, texts, strict=True):
                x = aligner.align([t])
                columns = {"a": x.row, "b": x.col, "a_id": x.a[x.row], "b_id": x.b[x.col], "shared": x.shared}
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(x.row), schema[0].type), *map(pa.array, columns.values())], schema=schema)

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("t"))
    return rows.mapInArrow(run, ddl).withColumnRenamed("id", id_col)
