"""Exact de-duplication with an extendible-hash index on shared files.

1. A histogram of the texts' hash prefixes gives the directory: one bucket at
   first; a bucket with more text than ``capacity`` splits, and the directory
   doubles where the bucket already uses all its bits. A bucket is a range of
   keys.
2. Tasks combine equal texts of their own rows, so that a text which fills a
   third of the table leaves each task a bounded number of times.
3. Each owner task gets whole buckets in key order. Texts with the same key
   form a chain and are compared byte by byte; the entries are written as the
   index to the shared folder.
4. Rows look their text up in the index; Spark splits a hot key there.

The directory has at most 2 ** MAX_DEPTH slots whatever the input. A bucket
that is overfull at that depth (one text with very many copies, or a very
large table) is processed like any other: owners hold one chain at a time.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import map_rows, new_name, staged, text_or_empty

MAX_DEPTH = 18
#: Bytes of text in a bucket, at least.
CAPACITY = 4 << 20
#: Bytes of text that a task combines before it passes entries on.
COMBINE_BYTES = 32 << 20
KEY_BITS = 60


def normalized(text: Column) -> Column:
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " ")


def key_of(sha: Column, bits: int = KEY_BITS) -> Column:
    """The first ``bits`` bits of a hexadecimal hash, as a long."""
    first = F.conv(F.substring(sha, 1, KEY_BITS // 4), 16, 10).cast("long")
    return F.shiftright(first, KEY_BITS - bits)


@dataclass
class Directory:
    """Slots of an extendible hash: slot -> bucket, by the key's top bits.
    The slots of a bucket are neighbours, so a bucket is a range of keys."""

    depth: int = 0
    slots: list[int] = field(default_factory=lambda: [0])
    #: Of each bucket: the bits it uses, its first slot.
    local: list[int] = field(default_factory=lambda: [0])
    first: list[int] = field(default_factory=lambda: [0])

    def split(self, bucket: int) -> int:
        """Split a bucket in two, doubling the directory if it must; the
        number of the new bucket, which gets the upper half."""
        if self.local[bucket] == self.depth:
            self.slots = [b for b in self.slots for _ in range(2)]
            self.first = [2 * slot for slot in self.first]
            self.depth += 1
        self.local[bucket] += 1
        new, half = len(self.local), 1 << (self.depth - self.local[bucket])
        middle = self.first[bucket] + half
        self.slots[middle : middle + half] = [new] * half
        self.local.append(self.local[bucket])
        self.first.append(middle)
        return new


def build_directory(sizes: dict[int, int], bits: int, capacity: int) -> Directory:
    """Split overfull buckets, given the size of each ``bits``-bit prefix."""
    d = Directory()
    summed = [0, *itertools.accumulate(sizes.get(prefix, 0) for prefix in range(1 << bits))]
    # Bucket, its first prefix, its number of prefixes.
    todo = [(0, 0, 1 << bits)]
    while todo:
        bucket, first, width = todo.pop()
        if width == 1 or summed[first + width] - summed[first] <= capacity:
            continue
        new = d.split(bucket)
        half = width // 2
        todo += [(bucket, first, half), (new, first + half, half)]
    return d


def directory_of(keys: DataFrame, key_bits: int, capacity: int) -> Directory:
    """From rows (key, size): sizes by prefix are summed in Spark, first at
    MAX_DEPTH bits, then at some bits more than the buckets need; only the
    latter come to the driver."""
    bits = min(MAX_DEPTH, key_bits)
    prefix = F.shiftright("key", key_bits - bits).cast("int")
    fine = staged(keys.groupBy(prefix.alias("prefix")).agg(F.sum("size").alias("size")), "dedup-histogram")
    total = fine.agg(F.sum("size")).first()[0] or 0
    capacity = max(capacity, total >> 16)
    few = min(bits, 3 + math.ceil(math.log2(max(total / capacity, 1))))
    coarse = fine.groupBy(F.shiftright("prefix", bits - few).alias("p")).agg(F.sum("size").alias("size"))
    return build_directory({r["p"]: r["size"] for r in coarse.collect()}, few, capacity)


def _combined(slots: list[int], shift: int):
    """Equal texts of a task's rows as one entry: bucket, smallest id, rows,
    rows with that id."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held: dict[tuple, list] = {}
        size = 0

        def out() -> dict:
            return {
                "bucket": [slots[k >> shift] for k, _, _ in held],
                "key": [k for k, _, _ in held],
                "sha": [s for _, s, _ in held],
                "norm": [t for _, _, t in held],
                "least": [v[0] for v in held.values()],
                "n": [v[1] for v in held.values()],
                "n_least": [v[2] for v in held.values()],
            }

        for b in batches:
            for key, sha, norm, own in zip(b["key"], b["sha"], b["norm"], b["id"], strict=True):
                value = held.get((key, sha, norm))
                if value is not None:
                    _merge(value, own, 1, 1)
                    continue
                held[key, sha, norm] = [own, 1, 1]
                size += len(norm) + 200
                if size > COMBINE_BYTES:
                    yield out()
                    held, size = {}, 0
        if held:
            yield out()

    return run


def _merge(value: list, least, n: int, n_least: int) -> None:
    """Null ids are larger than all others."""
    value[1] += n
    if least == value[0]:
        value[2] += n_least
    elif least is not None and (value[0] is None or least < value[0]):
        value[0], value[2] = least, n_least


def _owned(batches: Iterator[dict]) -> Iterator[dict]:
    """Index entries of an owner's buckets, whose rows come in key order. All
    that is held is the chain of one key."""
    key, chain = None, []

    def out(rows: list) -> dict:
        names = ("key", "sha", "place", "keep_id", "group_size", "n_keep")
        return dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))

    ready: list[tuple] = []

    def close() -> None:
        ready.extend((key, sha, place, *v) for place, (_, sha, v) in enumerate(chain))

    for b in batches:
        for k, sha, norm, least, n, n_least in zip(b["key"], b["sha"], b["norm"], b["least"], b["n"], b["n_least"], strict=True):
            if k != key:
                close()
                key, chain = k, []
            for text, _, value in chain:
                if text == norm:
                    _merge(value, least, n, n_least)
                    break
            else:
                if any(s == sha for _, s, _ in chain):
                    raise ValueError(f"two texts with the hash {sha}")
                chain.append((norm, sha, [least, n, n_least]))
        if len(ready) > 10_000:
            yield out(ready)
            ready = []
    close()
    if ready:
        yield out(ready)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = KEY_BITS, capacity: int = CAPACITY) -> DataFrame:
    """The index, written to the shared folder and read back: bucket order,
    (key, sha, place in the chain, keep_id, group_size, n_keep: rows of the
    group with that id)."""
    kind = docs.schema[id_col].dataType.simpleString()
    text = docs.select(F.col(id_col).alias("id"), normalized(F.col(text_col)).alias("norm"))
    hashed = text.withColumn("sha", F.sha2("norm", 256))
    keyed = hashed.withColumn("key", key_of(F.col("sha"), key_bits))
    directory = directory_of(keyed.select("key", F.octet_length("norm").alias("size")), key_bits, capacity)
    entry = f"bucket int, key long, sha string, norm string, least {kind}, n long, n_least long"
    combined = _combined(directory.slots, key_bits - directory.depth)
    entries = map_rows(keyed.select("key", "sha", "norm", "id"), combined, entry)
    owned = entries.repartition(len(directory.local), "bucket").sortWithinPartitions("bucket", "key")
    schema = f"key long, sha string, place int, keep_id {kind}, group_size long, n_keep long"
    return staged(map_rows(owned, _owned, schema), "dedup-index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. Of equal texts the row with the smallest id
    stays; a null id is larger than all others. Of repeated rows (same id,
    equal texts) one counts as kept. An empty table gives an empty result;
    other columns are ignored.
    """
    index = build_index(docs, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("id"), F.sha2(normalized(F.col(text_col)), 256).alias("sha"))
    found = rows.join(index.drop("key", "place"), "sha")
    is_keeper = F.col("id").eqNullSafe(F.col("keep_id"))
    names = [F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")]
    if index.filter("n_keep > 1").isEmpty():
        return found.withColumn("kept", is_keeper).select(*names)
    plain = found.filter(~is_keeper | (F.col("n_keep") == 1)).withColumn("kept", is_keeper)
    # Rows of the same id and text are all alike: count them, then mark one.
    again = found.filter(is_keeper & (F.col("n_keep") > 1)).groupBy("id", "keep_id", "group_size", "sha").count()
    again = again.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
    return plain.select(*names).unionByName(again.withColumn("kept", F.col("nth") == 1).select(*names))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that stay, all columns as they were; of rows with the same id
    and equal texts, one (any)."""
    index = build_index(docs, id_col, text_col, **options)
    sha, keep = new_name(docs, "sha"), new_name(docs, "keep_id")
    keys = index.select(F.col("sha").alias(sha), F.col("keep_id").alias(keep), "n_keep")
    own_sha = F.sha2(normalized(F.col(text_col)), 256)
    keeper = [F.col(sha) == own_sha, F.col(id_col).eqNullSafe(F.col(keep))]
    once = docs.join(keys.filter("n_keep = 1").drop("n_keep"), keeper, "left_semi")
    if keys.filter("n_keep > 1").isEmpty():
        return once
    again = docs.join(keys.filter("n_keep > 1").drop("n_keep"), keeper).dropDuplicates([sha])
    return once.unionByName(again.select(*docs.columns))
