"""N-gram Jaccard join with a prefix tree.

Documents are sets of distinct word 5-grams; two link when their Jaccard
similarity is 0.75 or more. The result is each document's set size and its
component under the links.

1. Each set gets a 128-bit signature. Equal sets are one node from here on.
   The same pass counts, over all documents, the words and the n-grams by
   hash slot, in tables of a fixed size. They estimate how often an n-gram
   occurs: by chance, from its words, and in repeated passages, from its own
   slot. The global order is (estimate, hash), rare n-grams first. Any such
   order gives the same links; the counts only make it a good one.
2. Two sets that link have at least 0.75 n n-grams of each in common, so
   they share k of the first n - ceil(0.75 n) + k n-grams of each (k is 1 and
   a twentieth of the smaller size). These prefixes are gathered by n-gram;
   the sets of like size that share one form a group with its smallest node
   as leader. Groups with the same leader are one: a set is sent once per
   leader. Any two sets that can link are in a common group. A set that
   shares fewer n-grams of its prefix with all others than a link needs isn't
   sent, nor is one that shares too few with a leader, all as a pair.
3. Large groups are dealt into blocks of bounded size, each with the leader.
   In a block, the sets are stored in a prefix tree in the global order; each
   set walks the tree, sharing what paths have in common, and leaves a subtree
   when the overlap so far and the n-grams left cannot reach the bound, or
   when all its sets are already in the walker's component.
4. Where a group has several blocks, its sets are compared across them unless
   they are in one component by then: the sets outside the group's largest
   component are sent, in blocks again, to all of its blocks. No pair is left
   out, and the pairs within a component are never listed.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigflow.llm.common import map_rows, new_name, staged, text_or_empty, worker_state
from sigflow.llm.components import components

NGRAM = 5
#: Prefixes are longer by one in so many n-grams, and links then need so
#: many more common ones.
MORE = 20
#: Slots of the count tables.
NGRAM_BITS = 22
WORD_BITS = 20
SLICES = 20
#: Prefix n-grams per group of postings, n-grams of a block's sets: sizes of
#: work. Groups of postings, at least and at most: two sets give a row for each
#: group that has an n-gram of both, so with fewer groups the rows would grow
#: with the groups. Partitions of postings, at most.
POSTINGS = 400_000
GROUPS = 256, 1 << 22
PARTITIONS = 1 << 15
BLOCK_NGRAMS = 400_000
REMEMBERED = 300_000

_NGRAM_MASK = np.uint64((1 << NGRAM_BITS) - 1)
_WORD_MASK = np.uint64((1 << WORD_BITS) - 1)
#: An ordered n-gram: the class of its estimate, then its hash.
_HASH_BITS = np.uint64(56)
_LOW = np.uint64(0xFFFFFFFF)
#: Sets whose sizes differ by a class of 2 or more can't link.
_SIZE_BASE = 1.34
# Odd multipliers, one for each place in an n-gram.
_PLACES = [np.uint64(xxhash.xxh3_64_intdigest(b"place", seed=i) | 1) for i in range(NGRAM)]


# -------------------------------------------------------------------- sets
class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of a UTF-8 text's words, A-Z in lower case, and of its
    n-grams in their order; with fewer words the whole sequence is the only
    n-gram."""
    words = text.lower().split()
    known = worker_state("word-hashes", _WordHashes)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(known) > REMEMBERED:
        known.clear()
    if not len(h):
        return h, h
    width = min(len(h), NGRAM)
    n = len(h) - width + 1
    mixed = np.full(n, width, np.uint64)
    for i in range(width):
        mixed += h[i : i + n] * _PLACES[i]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return h, mixed


def _distinct(a: np.ndarray) -> np.ndarray:
    a = np.sort(a)
    return a[np.concatenate(([True], a[1:] != a[:-1]))] if len(a) > 1 else a


def signature(ngrams: np.ndarray) -> bytes:
    return hashlib.blake2b(ngrams.tobytes(), digest_size=16).digest()


def node_of(sig: bytes, n: int) -> int:
    """A set's node: the class of its size, then 56 bits of its signature."""
    return int(math.log(n, _SIZE_BASE)) << 56 | int.from_bytes(sig[:7], "little")


class Order:
    """The global order, from the count tables. All in whole numbers (16ths
    of a binary logarithm), so that every task finds the same."""

    def __init__(self, counts: np.ndarray):
        ngrams, words = counts[: 1 << NGRAM_BITS], counts[1 << NGRAM_BITS :]
        self.total = _log16(np.array([words.sum()]))[0]
        self.words = _log16(words)
        # Slots that stand out hold n-grams of repeated passages.
        frequent = ngrams > 4 * ngrams.mean() + 8
        self.ngrams = np.where(frequent, self.classes(_log16(ngrams)), 0).astype(np.uint8)

    @staticmethod
    def classes(log16: np.ndarray) -> np.ndarray:
        return np.clip((log16 + 80 * 16) >> 3, 0, 255)

    def ordered(self, h: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """Distinct n-grams, given by the hashes of a text's words and
        n-grams, in the global order: whole numbers that increase with it."""
        logs = self.words[(h & _WORD_MASK).astype(np.int64)]
        width = len(h) - len(mixed) + 1
        chance = sum(logs[i : i + len(mixed)] for i in range(width)) - (width - 1) * self.total
        level = np.maximum(self.classes(chance), self.ngrams[(mixed & _NGRAM_MASK).astype(np.int64)])
        return _distinct(level.astype(np.uint64) << _HASH_BITS | mixed >> np.uint64(8))


def _log16(counts: np.ndarray) -> np.ndarray:
    return np.rint(16 * np.log2(counts.astype(np.float64) + 1)).astype(np.int32)


def prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1 + n // MORE


# -------------------------------------------------------------------- tree
class Forest:
    """Union-find over places 0 ... n - 1, seeded with known components."""

    def __init__(self, seeds: list):
        first: dict = {}
        self.up = [first.setdefault(s, i) for i, s in enumerate(seeds)]

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i


class PrefixTree:
    """Sets in the global order; a subtree with one set is that set.

    A node is [children by n-gram, sets that end here, smallest and largest
    size of its sets, one of its sets if all were in one component when last
    seen, else -1].
    """

    def __init__(self, sets: list[list[int]], forest: Forest):
        self.sets, self.forest = sets, forest
        self.root = self._node()

    @staticmethod
    def _node() -> list:
        return [{}, [], 1 << 60, 0, None]

    def insert(self, i: int) -> None:
        own = self.sets[i]
        node, depth = self.root, 0
        while True:
            self._count(node, i)
            if depth == len(own):
                node[1].append(i)
                return
            child = node[0].get(own[depth])
            if child is None:
                node[0][own[depth]] = i
                return
            if isinstance(child, int):
                other, child = child, self._node()
                self._count(child, other)
                rest = self.sets[other]
                if len(rest) == depth + 1:
                    child[1].append(other)
                else:
                    child[0][rest[depth + 1]] = other
                node[0][own[depth]] = child
            node, depth = child, depth + 1

    def _count(self, node: list, i: int) -> None:
        n = len(self.sets[i])
        node[2], node[3] = min(node[2], n), max(node[3], n)
        if node[4] is None:
            node[4] = i
        elif node[4] >= 0 and self.forest.find(node[4]) != self.forest.find(i):
            node[4] = -1

    def link(self, i: int) -> None:
        """Join set ``i`` with the component of every set that links with
        it."""
        own = self.sets[i]
        size = len(own)
        place = {g: k for k, g in enumerate(own)}
        self._walk(self.root, i, size, place, 0, 0, -1)

    def _walk(self, node, i, size, place, depth, overlap, last) -> None:
        # Explicit stack: paths are as long as sets.
        stack = [(node, depth, overlap, last)]
        find, up = self.forest.find, self.forest.up
        while stack:
            node, depth, overlap, last = stack.pop()
            if isinstance(node, int):
                other = self.sets[node]
                n = len(other)
                if 7 * (overlap + min(n - depth, size - 1 - last)) < 3 * (size + n):
                    continue
                a, b = find(node), find(i)
                if a != b and 7 * (overlap + sum(map(place.__contains__, other[depth:]))) >= 3 * (size + n):
                    up[max(a, b)] = min(a, b)
                continue
            children, ends, low, high, one = node
            if 7 * (overlap + min(high - depth, size - 1 - last)) < 3 * (size + low):
                continue
            if one is not None and one >= 0 and find(one) == find(i):
                continue
            for j in ends:
                a, b = find(j), find(i)
                if a != b and 7 * overlap >= 3 * (size + len(self.sets[j])):
                    up[max(a, b)] = min(a, b)
            later = []
            for g, child in children.items():
                k = place.get(g)
                if k is None:
                    stack.append((child, depth + 1, overlap, last))
                else:
                    later.append((child, depth + 1, overlap + 1, k))
            stack += later  # matching children first


def join_block(sets: list[list[int]], members: list[bool], seeds: list) -> list[tuple[int, int]]:
    """(first, other) pairs of places that the block's links connect. Sets
    that are not members only walk the tree (they are compared with each
    other elsewhere); equal seeds are connected beforehand."""
    forest = Forest(seeds)
    before = [forest.find(i) for i in range(len(sets))]
    tree = PrefixTree(sets, forest)
    walkers = not all(members)
    order = sorted(range(len(sets)), key=lambda i: (not members[i], len(sets[i]), i))
    for i in order:
        if not (walkers and members[i]):
            tree.link(i)
        if members[i]:
            tree.insert(i)
    return [(forest.find(i), i) for i in range(len(sets)) if forest.find(i) != before[i]]


# ------------------------------------------------------------------- Spark
def _fingerprints(rows: DataFrame, kind: str) -> DataFrame:
    """A row (id, key, n, sig, node) per document, and per task rows (part, slice,
    counts) of its n-grams and words by slot."""
    n_slots = (1 << NGRAM_BITS) + (1 << WORD_BITS)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        counts = np.zeros(n_slots, np.int32)
        grams, words = counts[: 1 << NGRAM_BITS], counts[1 << NGRAM_BITS :]
        held: list[tuple] = []

        def count() -> None:
            for table, mask, k in ((words, _WORD_MASK, 0), (grams, _NGRAM_MASK, 1)):
                slot, n = np.unique((np.concatenate([x[k] for x in held]) & mask).astype(np.uint32), return_counts=True)
                table[slot] += n.astype(np.int32)
            held.clear()

        for b in batches:
            sizes, sigs, many = [], [], 0
            none = [None] * len(b["t"])
            for t in b["t"]:
                h, mixed = _hashes(t.encode())
                s = _distinct(mixed)
                sizes.append(len(s))
                sigs.append(signature(s) if len(s) else None)
                held.append((h, s))
                many += len(h)
                if many > 1 << 20:
                    count()
                    many = 0
            if held:
                count()
            nodes = [x and node_of(x, n) for x, n in zip(sigs, sizes, strict=True)]
            yield {"id": b["id"], "key": b["key"], "n": sizes, "sig": sigs, "node": nodes, "part": none, "slice": none, "counts": none}
        if counts.any():
            data = [zlib.compress(x.tobytes(), 1) for x in counts.reshape(SLICES, -1)]
            none = [None] * SLICES
            part = [TaskContext.get().partitionId()] * SLICES
            yield {"id": none, "key": none, "n": none, "sig": none, "node": none, "part": part, "slice": list(range(SLICES)), "counts": data}

    return map_rows(rows, run, f"id {kind}, key string, n long, sig binary, node long, part int, slice int, counts binary")


#: Tables that are summed at a time.
FAN_IN = 64


def _slot_counts(fingerprints: DataFrame) -> np.ndarray:
    """The slots' counts over all documents, tables of fixed size: slices are
    summed in Spark, FAN_IN tables at a time, in as many rounds as it takes."""

    def add(kind: type):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            total: np.ndarray = 0
            for x in pdf["counts"]:
                total = total + np.frombuffer(zlib.decompress(x), kind).astype(np.int64)
            return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "part": pdf["part"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})

        return run

    rows = fingerprints.filter("slice IS NOT NULL").select("slice", "part", "counts")
    tables, kind = (rows.agg(F.max("part")).first()[0] or 0) + 1, np.int32
    while kind is np.int32 or tables > 1:
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        rows = rows.groupBy("slice", "part").applyInPandas(add(kind), "slice int, part int, counts binary")
        tables, kind = -(-tables // FAN_IN), np.int64
    out = np.zeros((SLICES, ((1 << NGRAM_BITS) + (1 << WORD_BITS)) // SLICES), np.int64)
    for r in rows.collect():
        out[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return out.reshape(-1)


def _postings(rows: DataFrame, order, n_groups: int) -> DataFrame:
    """The prefixes' n-grams dealt by hash to groups: rows (r, low half of the
    n-grams, nodes). Equal sets of a task are dealt once."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        seen: set[int] = set()
        grams, nodes, many = [], [], 0

        def dealt() -> dict:
            g, owner = np.concatenate(grams), np.concatenate(nodes)
            r = ((g >> np.uint64(24) & _LOW) * np.uint64(n_groups) >> np.uint64(32)).astype(np.int64)
            by = np.argsort(r, kind="stable")
            r, g, owner = r[by], (g[by] & _LOW).astype(np.uint32), owner[by]
            cuts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
            ends = [*cuts[1:].tolist(), len(r)]
            return {
                "r": r[cuts].tolist(),
                "grams": [g[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)],
                "nodes": [owner[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)],
            }

        for b in batches:
            for t in b["t"]:
                h, mixed = _hashes(t.encode())
                s = _distinct(mixed)
                if not len(s) or (node := node_of(signature(s), len(s))) in seen:
                    continue
                seen.add(node)
                own = order.value.ordered(h, mixed)
                own = own[: prefix_length(len(own))]
                grams.append(own)
                nodes.append(np.full(len(own), node, np.int64))
                many += len(own)
                if many > 1 << 20:
                    yield dealt()
                    grams, nodes, many = [], [], 0
        if many:
            yield dealt()

    return map_rows(rows, run, "r int, grams binary, nodes binary")


def _memberships(postings: DataFrame, n_parts: int) -> DataFrame:
    """(leader, node, shared, more): the nodes that share a prefix n-gram
    with a leader, the smallest node of theirs, and the leader itself; how
    many n-grams, and whether three nodes or more share one of them. N-grams
    that agree in the dealt bits count as one, which only adds rows."""

    def pairs(grams: list[bytes], nodes: list[bytes]) -> dict | None:
        g = np.frombuffer(b"".join(grams), np.uint32)
        owner = np.frombuffer(b"".join(nodes), np.int64)
        by = np.lexsort((owner, g))
        g, owner = g[by], owner[by]
        once = np.concatenate(([True], (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])))
        g, owner = g[once], owner[once]
        size_class = owner >> 56
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (size_class[1:] - size_class[:-1] > 1)))
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(g)))
        first, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        found = size > 1
        if not found.any():
            return None
        leader, node, several = owner[first[found]], owner[found], size[found] > 2
        by = np.lexsort((node, leader))
        leader, node, several = leader[by], node[by], several[by]
        ends = np.flatnonzero(np.concatenate(([True], (leader[1:] != leader[:-1]) | (node[1:] != node[:-1]))))
        shared = np.diff(np.append(ends, len(leader)))
        return {"leader": leader[ends], "node": node[ends], "shared": shared, "more": np.logical_or.reduceat(several, ends)}

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        r, grams, nodes = None, [], []
        for b in batches:
            for own, g, n in zip(b["r"], b["grams"], b["nodes"], strict=True):
                if own != r:
                    if grams and (out := pairs(grams, nodes)):
                        yield out
                    r, grams, nodes = own, [], []
                grams.append(g)
                nodes.append(n)
        if grams and (out := pairs(grams, nodes)):
            yield out

    dealt = postings.repartition(n_parts, "r").sortWithinPartitions("r")
    found = map_rows(dealt, run, "leader long, node long, shared long, more boolean")
    return found.groupBy("leader", "node").agg(F.sum("shared").alias("shared"), F.max("more").alias("more"))


def _candidates(groups: DataFrame, sized: DataFrame) -> DataFrame:
    """(leader, rep, set, node, n) of the memberships that a link may need."""
    # A partner has three quarters of the size, at least.
    enough = F.col("all") > F.floor(3 * F.col("n") / (4 * MORE))
    shared = groups.groupBy("node").agg(F.sum("shared").alias("all"))
    alive = staged(shared.join(sized, "node").filter(enough).drop("all"), "candidates")
    leader = alive.select(F.col("node").alias("leader"), F.col("n").alias("m"))
    member = groups.join(alive, "node").join(leader, "leader", "left")
    less, greater = F.least("n", "m"), F.greatest("n", "m")
    pair = (4 * less >= 3 * greater) & (F.col("shared") > F.floor(less / MORE))
    kept = F.col("more") | (F.col("leader") == F.col("node")) | (pair & F.col("m").isNotNull())
    return member.filter(kept).select("leader", "rep", "set", "node", "n").distinct()


def _packed_words(rows: DataFrame) -> DataFrame:
    """(id, words): each text's words, compressed for the two shuffles that
    carry them and for the blocks that hold them."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield {"id": b["id"], "words": [zlib.compress(b" ".join(t.encode().lower().split()), 1) for t in b["t"]]}

    return map_rows(rows, run, "id bigint, words binary")


_BLOCK = ["leader", "block", "walk"]


def _linked(assigned: DataFrame, order) -> DataFrame:
    """Links (a, b) of the assigned sets, put into a prefix tree block by
    block. ``assigned``: rep (an id), set (what the links name), node, seed,
    member, leader, block, walk, words."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        key, block = None, []

        def links() -> dict | None:
            places: dict[bytes, int] = {}
            sets, members, seeds, names = [], [], [], []
            for name, node, seed, member, words in block:
                h, mixed = _hashes(zlib.decompress(words))
                s = _distinct(mixed)
                sig = signature(s)
                # Another row with this id may have another text; the leader
                # may be there as a member too.
                if not len(s) or node_of(sig, len(s)) != node:
                    continue
                if sig in places:
                    members[places[sig]] |= member
                    continue
                places[sig] = len(sets)
                sets.append(order.value.ordered(h, mixed).tolist())
                members.append(member)
                seeds.append(seed)
                names.append(name)
            found = join_block(sets, members, seeds) if len(sets) > 1 else []
            return {"a": [names[i] for i, _ in found], "b": [names[j] for _, j in found]} if found else None

        for b in batches:
            for i, own in enumerate(zip(b["leader"], b["block"], b["walk"], strict=True)):
                if own != key:
                    if len(block) > 1 and (out := links()):
                        yield out
                    key, block = own, []
                block.append((b["set"][i], b["node"][i], b["seed"][i], b["member"][i], b["words"][i]))
        if len(block) > 1 and (out := links()):
            yield out

    dealt = assigned.repartition("leader", "block", "walk").sortWithinPartitions(*_BLOCK, "rep")
    return map_rows(dealt, run, "a long, b long")


def _own_block() -> Column:
    """Blocks of a set: the leader is in every one, another set in one."""
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    one = F.array(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    return F.explode(F.when(F.col("node") == F.col("leader"), every).otherwise(one))


def _across_blocks(placed: DataFrame, known: DataFrame, order) -> DataFrame | None:
    """Links between the blocks of groups that have several, of sets that
    are not in one component yet; None if there are no such sets. Only these
    groups' words are sent again."""
    member = placed.filter("blocks > 1").select("rep", "set", "node", "n", "leader", "blocks").distinct()
    several = member.join(known.withColumnRenamed("node", "set"), "set", "left")
    several = staged(several.withColumn("seed", F.coalesce("component", "set")), "several")
    if several.isEmpty():
        return None
    sizes = several.groupBy("leader", "seed").agg(F.sum("n").alias("own"))
    first = Window.partitionBy("leader").orderBy(F.desc("own"), "seed")
    # One row per component of a group; the largest stays where it is.
    others = sizes.withColumn("nth", F.row_number().over(first)).filter("nth > 1").select("leader", "seed")
    walkers = staged(several.join(others, ["leader", "seed"], "left_semi"), "walkers")
    if walkers.isEmpty():
        return None
    groups = walkers.groupBy("leader").agg(F.sum("n").alias("walking"), F.max("blocks").alias("blocks"))
    groups = groups.withColumn("walks", F.ceil(F.col("walking") / BLOCK_NGRAMS).cast("int"))
    walks = walkers.join(groups.select("leader", "walks"), "leader")
    walks = walks.withColumn("walk", F.pmod(F.xxhash64("node"), F.col("walks")).cast("int"))
    walks = walks.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    stay = several.join(groups.select("leader", "walks"), "leader").withColumn("block", _own_block())
    stay = stay.withColumn("walk", F.explode(F.sequence(F.lit(0), F.col("walks") - 1)))
    names = ("rep", "set", "node", "seed", "leader", "block", "walk")
    assigned = walks.select(*names, F.lit(False).alias("member")).unionByName(stay.select(*names, F.lit(True).alias("member")))
    words = placed.filter("blocks > 1").select("leader", "set", "words")
    # Both sides grow with the input: never broadcast, whatever its size now.
    return _linked(words.join(assigned.hint("merge"), ["leader", "set"]), order)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    A null or empty text, or one without words, has the empty set, links with
    nothing and is its own component. A row with a null id has its set size
    and a null component and takes no part in links. Repeated rows have the
    same component; rows that share an id but not a text are placed by their
    own text. An empty table gives an empty result; other columns are
    ignored. Ids are integers.
    """
    found = _placed(docs, id_col, text_col, F.lit(None).cast("string"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _placed(docs: DataFrame, id_col: str, text_col: str, key: Column) -> DataFrame:
    """(id, key, n, component) of each row; ``key`` is an expression of it."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(F.col(text_col)).alias("t"), key.alias("key"))
    prints = staged(_fingerprints(rows, "bigint"), "sets")
    own = prints.filter("slice IS NULL").select("id", "key", "n", "sig", "node")
    order = spark.sparkContext.broadcast(Order(_slot_counts(prints)))

    # The node is part of the signature, the set's size goes with it.
    reps = own.filter("n > 0 AND id IS NOT NULL").groupBy("sig", "node", "n").agg(F.min("id").alias("rep"))
    # Sets of texts that share an id are told apart by a number of their own.
    reps = staged(reps.withColumn("set", F.monotonically_increasing_id()), "reps")

    total = own.agg(F.sum("n")).first()[0] or 0
    n_parts = int(max(1, -(-total // (3 * POSTINGS))))
    n_groups = min(max(n_parts, GROUPS[0]), GROUPS[1])
    known_rows = rows.filter("id IS NOT NULL").select("id", "t")
    groups = staged(_memberships(_postings(known_rows.select("t"), order, n_groups), min(n_parts, PARTITIONS)), "groups")
    member = staged(_candidates(groups, reps.select("rep", "set", "node", "n")), "members")
    sizes = member.groupBy("leader").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    member = member.join(sizes.drop("sets"), "leader").withColumn("blocks", F.ceil(F.col("size") / BLOCK_NGRAMS).cast("int"))
    # Both sides grow with the input: never broadcast, whatever its size now.
    texts = _packed_words(known_rows).join(member.drop("size").hint("merge"), F.col("id") == F.col("rep")).drop("id")
    placed = staged(texts, "placed")
    assigned = placed.withColumns({"block": _own_block(), "seed": F.col("set"), "walk": F.lit(0), "member": F.lit(True)})
    links = staged(_linked(assigned, order), "links")
    found = components(links)
    more = _across_blocks(placed, found, order)
    if more is not None:
        found = components(links.unionByName(more))

    by_sig = reps.join(found.withColumnRenamed("node", "set"), "set", "left")
    by_sig = by_sig.select("sig", "rep", F.coalesce("component", "set").alias("set"))
    least = by_sig.groupBy("set").agg(F.min("rep").alias("component"))
    by_sig = by_sig.join(least, "set").select("sig", "component")
    out = own.drop("node").join(by_sig, "sig", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select("id", "key", "n", component.alias("component"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is their component's, all columns as
    they were, and the rows with a null id. Of repeated rows all stay (exact
    copies are for ``exact_dedup``). Rows go by id and text, so each text
    that shares an id with another is judged by its own component."""
    sha = F.sha2(text_or_empty(F.col(text_col)).cast("binary"), 256)
    found = _placed(docs, id_col, text_col, sha)
    lost = found.filter("id <> component").select(F.col("id").alias("gone"), F.col("key").alias("gone_key")).distinct()
    gone = staged(lost, "gone")
    gone = gone.toDF(new_name(docs, "gone"), new_name(docs, "gone_key"))
    return docs.join(gone, (F.col(id_col) == F.col(gone.columns[0])) & (sha == F.col(gone.columns[1])), "left_anti")
