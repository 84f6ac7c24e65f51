"""Toxicity scores: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with marks at both ends) and of
itself; its vector is the average of its parts' vectors, a text's vector the
average of its words'. Vectors and softmax are trained jointly, in numpy, so
a misspelling or an unseen form shares the vectors of its n-grams. The parts
count in the averages by their gain, which grows with how unevenly the
sample's toxic and other texts have them: parts of words that all texts have
would otherwise drown the rest.

The model is fitted on a bounded sample of labelled rows (``Settings.rows``,
chosen by a hash of the id). It scores every row, over the whole text.
"""

from __future__ import annotations

import re
import typing
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import map_rows, new_name, text_or_empty, worker_state

WORDS = re.compile(r"[^\W\d_]+").findall
#: Remembered words per worker.
REMEMBERED = 300_000


@dataclass(frozen=True)
class Settings:
    """``rows``: labelled rows that the fit uses, at most."""

    rows: int = 6_000
    slots: int = 1 << 17
    n_min: int = 3
    n_max: int = 5
    width: int = 8
    epochs: int = 16
    batch: int = 64
    rate: float = 3.0
    #: Parts in fewer of the sample's texts keep no vector.
    min_texts: int = 3
    #: The gain is the log ratio of the classes' shares of texts with the
    #: part (``smooth`` texts added), to this power; less than ``least`` is 0.
    power: int = 4
    smooth: float = 0.5
    least: float = 0.02
    seed: int = 7


def grams(word: str, s: Settings) -> set[str]:
    """A word's parts: itself and its character n-grams; long words have the
    n-grams of every place too."""
    marked = f"<{word}>"
    found = {marked}
    for n in range(s.n_min, s.n_max + 1):
        found.update([marked[i : i + n] for i in range(len(marked) - n + 1)])
    return found


def parts(word: str, s: Settings) -> list[int]:
    """Slots of a word's parts."""
    return [zlib.crc32(g.encode()) % s.slots for g in grams(word, s)]


def text_bag(text: str, s: Settings, memory: dict) -> tuple[np.ndarray, np.ndarray]:
    """Slots and their weights in the text's average (weights sum to 1)."""
    words = Counter(WORDS(text.lower()))
    slots, weights = [], []
    for w, n in words.items():
        own = memory.get(w)
        if own is None:
            own = memory[w] = np.array(parts(w, s), dtype=np.int64)
        slots.append(own)
        weights.append(np.full(len(own), n / len(own)))
    if not slots:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    slot, at = np.unique(np.concatenate(slots), return_inverse=True)
    weight = np.bincount(at, np.concatenate(weights)) / words.total()
    return slot.astype(np.int32), weight.astype(np.float32)


@dataclass
class Model:
    """Vectors of the slots and of the two classes."""

    vectors: np.ndarray
    classes: np.ndarray
    bias: np.ndarray

    def slot_scores(self) -> np.ndarray:
        """What a slot adds to the difference of the classes' logits."""
        return self.vectors @ (self.classes[:, 1] - self.classes[:, 0])

    @property
    def base(self) -> float:
        return float(self.bias[1] - self.bias[0])


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, s: Settings) -> Model:
    """Joint training by Adagrad on shuffled batches; deterministic. With
    one class or no rows at all the model answers with what it saw (0 when it
    saw nothing)."""
    model = Model(np.zeros((s.slots, s.width), np.float32), np.zeros((s.width, 2), np.float32), np.zeros(2, np.float32))
    share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.01
    model.bias[1] = np.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        return model
    gain = gains([slot for slot, _ in bags], labels, s)
    known = gain > 0
    bags = [(slot[k := known[slot]], weight[k] * gain[slot[k]]) for slot, weight in bags]
    rng = np.random.default_rng(s.seed)
    model.vectors[known] = rng.normal(0, 0.05, (int(known.sum()), s.width))
    model.classes[:] = rng.normal(0, 0.5, (s.width, 2))
    # Large first sums keep the steps of rare parts short.
    seen = [np.full_like(a, x) for a, x in ((model.vectors, 1.0), (model.classes, 0.01), (model.bias, 0.01))]
    for epoch in range(s.epochs):
        rate = s.rate * (1 - epoch / s.epochs)
        order = rng.permutation(len(bags))
        for begin in range(0, len(order), s.batch):
            rows = order[begin : begin + s.batch]
            _step(model, seen, [bags[i] for i in rows], labels[rows], rate)
    model.vectors *= gain[:, None]
    return model


def gains(slots: list[np.ndarray], labels: np.ndarray, s: Settings) -> np.ndarray:
    """Of each slot, how much it counts in an average."""
    texts = np.zeros((2, s.slots))
    for slot, label in zip(slots, labels, strict=True):
        texts[label, slot] += 1
    of = np.bincount(labels, minlength=2)
    # As many texts are added to a class as it is larger than the smaller.
    add = s.smooth * of / of.min()
    share = (texts + add[:, None]) / (of + 2 * add)[:, None]
    gain = np.abs(np.log(share[1] / share[0])) ** s.power
    return np.where((texts.sum(0) >= s.min_texts) & (gain > s.least), gain, 0).astype(np.float32)


def _step(model: Model, seen: list[np.ndarray], bags: list, labels: np.ndarray, rate: float) -> None:
    slot = np.concatenate([b[0] for b in bags])
    weight = np.concatenate([b[1] for b in bags])
    row = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    own, at = np.unique(slot, return_inverse=True)
    # The batch as a matrix over the slots that it has.
    x = np.zeros((len(bags), len(own)), np.float32)
    x[row, at] = weight
    hidden = x @ model.vectors[own]
    logits = hidden @ model.classes + model.bias
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(bags)), labels] -= 1
    to_vectors = x.T @ (p @ model.classes.T)
    to_classes, to_bias = hidden.T @ p, p.sum(0)
    seen[0][own] += to_vectors**2
    model.vectors[own] -= rate * to_vectors / np.sqrt(seen[0][own])
    for a, g, k in ((model.classes, to_classes, 1), (model.bias, to_bias, 2)):
        seen[k] += g**2
        a -= 0.3 * rate * g / np.sqrt(seen[k])


class PartScores(dict):
    """Score of each part: its slot's."""

    def __init__(self, slot_scores: np.ndarray, s: Settings):
        super().__init__()
        self.slot_scores, self.slots = slot_scores.tolist(), s.slots

    def __missing__(self, part: str) -> float:
        value = self[part] = self.slot_scores[zlib.crc32(part.encode()) % self.slots]
        return value


class Scorer(dict):
    """Score of each word, the average over its parts; ``score`` takes a
    text. Words and parts are remembered within bounds, across tasks."""

    def __init__(self, slot_scores: np.ndarray, base: float, s: Settings):
        super().__init__()
        self.part_scores, self.base, self.settings = PartScores(slot_scores, s), base, s

    def __missing__(self, word: str) -> float:
        own = grams(word, self.settings)
        value = self[word] = sum(map(self.part_scores.__getitem__, own)) / len(own)
        return value

    def score(self, text: str) -> float:
        words = WORDS(text.lower())
        total = sum(map(self.__getitem__, words))
        if len(self) > REMEMBERED:
            self.clear()
        if len(self.part_scores) > REMEMBERED:
            self.part_scores.clear()
        logit = self.base + (total / len(words) if words else 0.0)
        return float(1 / (1 + np.exp(-np.clip(logit, -60, 60))))


# -------------------------------------------------------------------- Spark
def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on rows with a label (the larger of several) that are not held
    out. The sample's ids are at most ``settings.rows`` rows, so they may be
    broadcast; its bags meet in one task that trains and returns the model,
    whose size does not depend on the input."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("id")).agg((F.max("toxic") > 0).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(settings.rows)
    rows = docs.select(F.col("doc_id").alias("id"), text_or_empty(F.col("text")).alias("t"))
    rows = rows.join(F.broadcast(sample), "id")

    def to_bags(batches: Iterator[dict]) -> Iterator[dict]:
        memory: dict = {}
        for b in batches:
            for begin in range(0, len(b["t"]), 200):
                part = slice(begin, begin + 200)
                bags = [text_bag(t, settings, memory) for t in b["t"][part]]
                if len(memory) > REMEMBERED // 3:
                    memory.clear()
                yield {"id": b["id"][part], "label": b["label"][part], "slots": [x.tobytes() for x, _ in bags], "weights": [x.tobytes() for _, x in bags]}

    def to_model(batches: Iterator[dict]) -> Iterator[dict]:
        data: dict = {}
        for b in batches:
            for i, label, slots, weights in zip(b["id"], b["label"], b["slots"], b["weights"], strict=True):
                # Rows that share an id: one of them.
                held = (label, np.frombuffer(slots, np.int32), np.frombuffer(weights, np.float32))
                if i not in data or slots > data[i][1].tobytes():
                    data[i] = held
        held = [data[i] for i in sorted(data)]
        model = fit([x[1:] for x in held], np.array([x[0] for x in held], np.int64), settings)
        yield {"name": ["vectors", "classes", "bias"], "value": [a.tobytes() for a in (model.vectors, model.classes, model.bias)]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    bags = map_rows(rows, to_bags, f"id {kind}, label int, slots binary, weights binary")
    out = {r["name"]: r["value"] for r in map_rows(bags.repartition(1), to_model, "name string, value binary").collect()}
    read = lambda name, shape: np.frombuffer(out[name], np.float32).reshape(shape)
    return Model(read("vectors", (-1, settings.width)), read("classes", (settings.width, 2)), read("bias", 2))


def score_udf(spark, model: Model, settings: Settings = Settings()):
    """A column function: text -> score. The model goes out as one number
    per slot."""
    values = spark.sparkContext.broadcast(model.slot_scores().astype(np.float32))
    base, key = model.base, f"toxicity:{id(model)}:{zlib.crc32(model.vectors.tobytes())}"

    @F.pandas_udf("double")
    def score(texts: typing.Iterator[pd.Series]) -> typing.Iterator[pd.Series]:
        scorer = worker_state(key, lambda: Scorer(values.value, base, settings))
        for t in texts:
            yield pd.Series([scorer.score(x) for x in t], dtype="float64")

    return score


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts have the score of the bias alone. A null id is not
    held out and takes no part in the fit; repeated rows are each scored. An
    empty table gives an empty result; without labels the score is that of a
    rare class (0.01). Other columns are ignored.
    """
    score = score_udf(docs.sparkSession, train(docs, labels, settings), settings)
    rows = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), score(text_or_empty(F.col("text"))).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows with a score below 0.5, all columns as they were."""
    score = score_udf(docs.sparkSession, train(docs, labels, settings), settings)
    name = new_name(docs, "score")
    return docs.withColumn(name, score(text_or_empty(F.col("text")))).filter(F.col(name) < 0.5).drop(name)
