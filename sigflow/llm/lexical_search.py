"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items go into one automaton, each guarded by a boundary on
both sides. Every document is scanned once: the automaton's outputs are its
term frequencies, and there is no index of the documents. The scan's counts
(the item terms that a document holds) are written once and read again when
the corpus statistics are known; the automaton's outputs lead to the items
that hold the term, so a document's scores are summed for all items together.

Items go in blocks of bounded size, each with an automaton of its own that is
broadcast, so a broadcast never grows with the documents or the items.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigflow.llm.common import map_rows, staged, text_or_empty, worker_state

#: Code points that are in no term (fixed by the task): ASCII but letters and digits.
NOT_IN_TERMS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of the items' texts in a block.
BLOCK_BYTES = 4 << 20
#: Bytes of a long text scanned at a time, cut at a boundary.
SEGMENT = 1 << 20
#: Parts in which an item's best documents are chosen first.
PARTS = 64

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def folded(text: str) -> bytes:
    """UTF-8 with A-Z in lower case and a space for each byte that is in no
    term. All bytes of other characters than ASCII's are in terms."""
    return text.encode().translate(_FOLD)


def terms_of(text: str) -> list[str]:
    """A text's terms in their order, with repeats."""
    return [t.decode() for t in folded(text).split()]


def count_terms(text: bytes) -> int:
    """Runs of term bytes in a folded text."""
    inside = np.frombuffer(text, np.uint8) != 32
    return int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(inside[:1].sum())


class TermAutomaton:
    """Counts the known terms of a text; a term is found only between two
    boundaries (spaces of the folded text)."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(terms):
            self.automaton.add_word(f" {t.encode().decode('latin-1')} ", i)
        self.empty = not terms
        if terms:
            self.automaton.make_automaton()

    def frequencies(self, text: bytes) -> Counter:
        """Term number -> occurrences in a folded text."""
        found: Counter = Counter()
        begin = 0
        while begin < len(text) and not self.empty:
            end = begin + SEGMENT
            if end < len(text):
                cut = text.find(b" ", end)
                end = cut if cut >= 0 else len(text)
            part = f" {text[begin:end].decode('latin-1')} "
            found.update(map(itemgetter(1), self.automaton.iter(part)))
            begin = end
        return found


def _scan(rows: DataFrame, terms, kind: str) -> DataFrame:
    """A row (id, n, terms, tfs) per document that holds a term, and per task
    a row (term, df) for each known term it met, and one of its own totals
    with the term -1 (df: documents with a term, n: terms)."""
    key = uuid.uuid4().hex

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        machine = worker_state(f"automaton:{key}", lambda: TermAutomaton(terms.value))
        df: Counter = Counter()
        n_docs = n_terms = 0
        for b in batches:
            out: dict[str, list] = {"id": [], "n": [], "terms": [], "tfs": []}
            for i, t in zip(b["id"], b["t"], strict=True):
                text = folded(t)
                n = count_terms(text)
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
                tf = machine.frequencies(text)
                if tf:
                    df.update(tf.keys())
                    own = sorted(tf.items())
                    for name, v in zip(out, (i, n, [x for x, _ in own], [x for _, x in own]), strict=True):
                        out[name].append(v)
            if out["id"]:
                yield {**out, "term": [None] * len(out["id"]), "df": [None] * len(out["id"])}
        none = [None] * (len(df) + 1)
        yield {"id": none, "n": [n_terms, *none[1:]], "terms": none, "tfs": none, "term": [-1, *df], "df": [n_docs, *df.values()]}

    return map_rows(rows, run, f"id {kind}, n long, terms array<int>, tfs array<long>, term int, df long")


class Scores:
    """Scores of documents for the items of a block, in whole numbers."""

    def __init__(self, n_docs: int, n_terms: int, df: dict[int, int], items_of: list[list[int]], n_items: int):
        self.n_docs, self.n_terms, self.n_items = n_docs, n_terms, n_items
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(items_of))]
        self.weight = np.array(weight, np.int64)
        # CSR: the items of each term.
        self.indptr = np.concatenate(([0], np.cumsum([len(x) for x in items_of]))).astype(np.int64)
        self.items = np.array([i for x in items_of for i in x], np.int64)

    def of(self, n: int, terms: list[int], tfs: list[int]) -> np.ndarray:
        """The document's score for each item of the block."""
        m = 10 + 90 * n * self.n_docs // self.n_terms
        at, tf = np.array(terms, np.int64), np.array(tfs, np.int64)
        gain = self.weight[at] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        size = self.indptr[at + 1] - self.indptr[at]
        place = np.repeat(self.indptr[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
        score = np.zeros(self.n_items, np.int64)
        np.add.at(score, self.items[place], np.repeat(gain, size))
        return score


def _best(hits: DataFrame, scores, names, top: int, kind: str, item_kind: str) -> DataFrame:
    """Per task at most ``top`` documents of each item: item, id, score."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        judge: Scores = scores.value
        best: list[list[tuple]] = [[] for _ in range(judge.n_items)]
        # Scores below an item's worst kept one can't enter.
        worst = np.zeros(judge.n_items, np.int64)

        def shrink(item: int) -> None:
            best[item] = sorted(best[item], key=_rank)[:top]
            if len(best[item]) == top:
                worst[item] = max(1, best[item][-1][0])

        for b in batches:
            for i, n, terms, tfs in zip(b["id"], b["n"], b["terms"], b["tfs"], strict=True):
                score = judge.of(n, terms, tfs)
                for item in np.flatnonzero((score > 0) & (score >= worst)).tolist():
                    best[item].append((int(score[item]), i))
                    if len(best[item]) >= 8 * top:
                        shrink(item)
        for item in range(judge.n_items):
            shrink(item)
        flat = [(names.value[item], i, s) for item, own in enumerate(best) for s, i in own]
        if flat:
            item, i, s = map(list, zip(*flat, strict=True))
            yield {"item": item, "id": i, "score": s, "part": [TaskContext.get().partitionId() % PARTS] * len(flat)}

    return map_rows(hits, run, f"item {item_kind}, id {kind}, score long, part int")


def _rank(found: tuple) -> tuple:
    return (-found[0], found[1] is None, found[1])


def search(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item id, rank, document id, score: for each item the ``top`` documents
    with the highest scores above 0, equal scores by document id.

    A null or empty text has no terms: such a document has no score and
    counts in no statistic, such an item has no rows. Rows of ``items`` with
    one id are one item with the terms of all; rows with a null id are one
    item with a null id. Repeated rows of ``docs`` are documents of their
    own, each with a rank; a null document id comes after all others of the
    same score. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("t"))
    asked = items.select(F.col(item_col).alias("item"), text_or_empty(F.col(item_text_col)).alias("t"))
    asked = staged(asked, "search-items")
    total = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = max(1, -(-2 * total // BLOCK_BYTES))
    found = None
    for block in range(n_blocks):
        # Bounded: a block of the items, by the hash of their ids.
        own = asked.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).collect() if total else []
        names, terms, items_of = _block(own)
        if not terms and total:
            continue
        scan = staged(_scan(rows, spark.sparkContext.broadcast(terms), kind), "search-scan")
        counts = scan.filter("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
        df = {r["term"]: (r["df"], r["n"]) for r in counts.collect()}  # a row per term of the block
        n_docs, n_terms = df.get(-1, (0, 0))
        judge = Scores(n_docs or 0, n_terms or 0, {t: x for t, (x, _) in df.items()}, items_of, len(names))
        shared = spark.sparkContext.broadcast(judge), spark.sparkContext.broadcast(names)
        best = _best(scan.filter("term IS NULL").select("id", "n", "terms", "tfs"), *shared, top, kind, item_kind)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], f"item {item_kind}, id {kind}, score long, part int")
    order = F.desc("score"), F.asc_nulls_last("id")
    for keys in (("item", "part"), ("item",)):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return found.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _block(rows: list) -> tuple[list, list[str], list[list[int]]]:
    """The items' names, their terms and the items of each term."""
    names: dict = {}
    numbers: dict[str, int] = {}
    items_of: list[set[int]] = []
    for r in rows:
        item = names.setdefault(r["item"], len(names))
        for t in terms_of(r["t"]):
            at = numbers.setdefault(t, len(numbers))
            if at == len(items_of):
                items_of.append(set())
            items_of[at].add(item)
    return list(names), list(numbers), [sorted(x) for x in items_of]
