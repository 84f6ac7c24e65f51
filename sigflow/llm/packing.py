"""Best-fit packing of token pieces into sequences, by bin completion.

Spark tokenises the documents, cuts the long ones and counts the pieces of
each length. The plan needs only that histogram, which has at most
``capacity`` rows whatever the input: it lists fillings (lengths that share a
sequence) and how often each is used. Pieces of one length are alike, so each
piece then finds its sequence by its rank among them.

The plan starts from best-fit decreasing. While it uses more sequences than
the lower bound, bins are completed around the largest remaining piece: first
single descents, which take the filling of fewest pieces among those that waste
little and so keep the short pieces for later bins, then a short search like
the last step. If none reaches the bound, the linear relaxation over all
fillings (column generation, a knapsack by dynamic programming finds the next
filling) gives prices of the lengths, a stronger bound and, rounded, another
plan. If that changed the plan or the bound and they still differ, a
branch-and-bound search completes the bin of the largest remaining piece again:
all undominated fillings in order of waste, each as often as the counts allow
and then fewer times, branches dropped by their waste and by the prices of what
is left. The relaxation has a budget of pivots, the search one of nodes and
enumerated fillings; the best plan found counts.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigflow.llm.byte_level import ByteLevelTokenizer
from sigflow.llm.common import map_rows, staged, text_or_empty, worker_state

#: Search budget: nodes, and fillings enumerated, both in all. Fillings of a
#: node are listed this many first, four times as many when those are tried.
NODES = 4_000
LISTED = 200_000
FILLINGS = 4
#: Nodes of a first search without the relaxation's prices.
DIVE = 4_000
#: Tokens that a bin may waste in a descent, one descent for each.
WASTES = (8, 4, 16, 2, 32, 1, 64)
#: Pivots of the linear relaxations, in all.
PIVOTS = 4_000


# ------------------------------------------------------------------ tokens
def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str, text_col: str, with_ids: bool = False) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, and its place
    among the pieces of its length (``part`` and ``nth`` in the part). A
    document longer than ``capacity`` is cut; its first piece has the rest."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        tokenizer: ByteLevelTokenizer = worker_state(f"byte-level:{tokenizer_path}", lambda: ByteLevelTokenizer(tokenizer_path, specials=True))
        end = np.array([end_id], dtype="<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), Counter()
        names = ("id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids")
        for b in batches:
            out: dict[str, list] = {n: [] for n in names}
            for own, text in zip(b["id"], b["t"], strict=True):
                ids = np.array(tokenizer.encode(text), dtype="<u4").tobytes() + end
                total = len(ids) // 4
                start, length = 0, total % capacity or capacity
                k = 0
                while start < total:
                    data = ids[4 * start : 4 * (start + length)]
                    row = (own, k, start, length, zlib.crc32(data), part, seen[length], data if with_ids else None)
                    for n, v in zip(names, row, strict=True):
                        out[n].append(v)
                    seen[length] += 1
                    start, length, k = start + length, capacity, k + 1
            yield out

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("t"))
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long, ids binary"
    out = map_rows(rows, run, schema)
    return out if with_ids else out.drop("ids")


# -------------------------------------------------------------------- plan
Plan = list[tuple[tuple[int, ...], int]]


def sequences(plan: Plan) -> int:
    return sum(times for _, times in plan)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by pieces too
    long to share with another that long."""
    total = sum(n * c for n, c in counts.items())
    best = -(-total // capacity)
    for small in sorted({n for n in counts if 2 * n <= capacity} | {0}):
        large = sum(c for n, c in counts.items() if n > capacity - small)
        middle = [(n, c) for n, c in counts.items() if 2 * n > capacity and n <= capacity - small]
        low = sum(n * c for n, c in counts.items() if small <= n and 2 * n <= capacity)
        half = sum(c for _, c in middle)
        room = half * capacity - sum(n * c for n, c in middle)
        best = max(best, large + half + max(0, -(-(low - room) // capacity)))
    return best


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Pieces by falling length, each into the fullest sequence with room.
    Alike sequences are handled together."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {capacity: []}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r, groups in open_.items() if r >= length and groups), default=None)
            if room is None:
                room, filling, n = capacity, (), -(-left // (capacity // length))
            else:
                filling, n = open_[room].pop()
            each = min(room // length, left)
            used = min(n, left // each)
            if used < n and room < capacity:
                open_[room].append((filling, n - used))
            rest = room - each * length
            open_.setdefault(rest, []).append((filling + (length,) * each, used))
            left -= each * used
    return [g for groups in open_.values() for g in groups]


def _reach(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """Bit sets of the sums, up to ``room``, that lengths[i:] can make."""
    mask = (1 << (room + 1)) - 1
    sums = [1] * (len(lengths) + 1)
    for i in range(len(lengths) - 1, -1, -1):
        s, left, step = sums[i + 1], min(counts[lengths[i]], room // lengths[i]), 1
        while left > 0:
            step = min(step, left)
            s |= (s << (lengths[i] * step)) & mask
            left -= step
            step *= 2
        sums[i] = s
    return sums


def fillings(counts: dict[int, int], room: int, most: int, left: list[int]) -> list[tuple[int, ...]]:
    """The first ``most`` undominated fillings of ``room``, least waste first,
    larger pieces first among equals; fewer only if there are no more or
    ``left`` (fillings that may still be enumerated) is used up."""
    lengths = sorted((n for n, c in counts.items() if c and n <= room), reverse=True)
    if not lengths:
        return [()]
    sums = _reach(lengths, counts, room)
    found: list[tuple[int, ...]] = []

    def fill(i: int, target: int, chosen: tuple[int, ...]) -> None:
        if not target:
            left[0] -= 1
            if not _dominated(chosen, counts, room):
                found.append(chosen)
            return
        while i < len(lengths) and sums[i] >> target & 1:
            n = lengths[i]
            for k in range(min(counts[n], target // n), 0, -1):
                if sums[i + 1] >> (target - k * n) & 1:
                    fill(i + 1, target - k * n, chosen + (n,) * k)
                if len(found) >= most or left[0] <= 0:
                    return
            i += 1

    for target in range(room, 0, -1):
        if sums[0] >> target & 1:
            fill(0, target, ())
            if len(found) >= most or left[0] <= 0:
                break
    return found


def _dominated(chosen: tuple[int, ...], counts: dict[int, int], room: int) -> bool:
    """Whether an unused piece fits besides, or could stand for one or two
    of the chosen and leave less room."""
    waste = room - sum(chosen)
    if not waste:
        return False
    used = Counter(chosen)
    free = [n for n, c in counts.items() if c > used[n]]
    singles = {0, *used}
    sums = singles | {a + b for a in used for b in used if a != b or used[a] > 1}
    return any(s < n <= s + waste or (s and n == s and s not in used) for s in sums for n in free)


def _pair(lengths: list[int], left: dict[int, int], room: int, waste: int) -> tuple[int, ...]:
    """Two pieces that fill ``room`` best, if they waste at most ``waste``;
    the larger first piece among equals."""
    found: tuple[int, ...] = ()
    low, high, best = 0, bisect_right(lengths, room) - 1, room - waste - 1
    while low <= high and best < room:
        a, b = lengths[high], lengths[low]
        if a + b > room:
            high -= 1
            continue
        if a + b > best and (a != b or left[a] > 1):
            best, found = a + b, (a, b)
        low += 1
    return found


def _few_pieces(lengths: list[int], left: dict[int, int], room: int, waste: int) -> tuple[int, ...]:
    """Of the fillings that waste at most ``waste`` one of fewest pieces, up
    to three; none of those: the first filling of least waste. ``lengths``
    are the rising lengths that ``left`` counts."""
    if not lengths or lengths[0] > room:
        return ()
    top = bisect_right(lengths, room) - 1
    if room - lengths[top] <= waste:
        return (lengths[top],)
    if pair := _pair(lengths, left, room, waste):
        return pair
    for i in range(top, bisect_left(lengths, -(-(room - waste) // 3)) - 1, -1):
        a = lengths[i]
        left[a] -= 1
        others = lengths[: i + 1] if left[a] else lengths[:i]
        pair = _pair(others, left, room - a, waste)
        left[a] += 1
        if pair:
            return (a, *pair)
    return (fillings(left, room, 1, [LISTED]) or [()])[0]


def descend(counts: dict[int, int], capacity: int, waste: int) -> Plan:
    """One descent of the search: the largest piece's bin gets the filling of
    ``_few_pieces``, as often as the counts allow."""
    left, lengths, plan = dict(counts), sorted(counts), []
    while lengths:
        largest = lengths[-1]
        left[largest] -= 1
        if not left[largest]:
            lengths.pop()
        filling = (largest, *_few_pieces(lengths, left, capacity - largest, waste))
        left[largest] += 1
        if left[largest] == 1:
            lengths.append(largest)
        need = Counter(filling)
        times = min(left[n] // k for n, k in need.items())
        plan.append((filling, times))
        for n, k in need.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
                lengths.pop(bisect_left(lengths, n))
    return plan


def _fullest(lengths: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float | int, np.ndarray]:
    """The greatest worth of a filling, and how often it has each length."""
    order = np.argsort(lengths)
    size, value = lengths[order], worth[order]
    best = np.zeros(capacity + 1, worth.dtype)
    last = np.full(capacity + 1, -1)
    fits = np.searchsorted(size, np.arange(capacity + 1), side="right")
    for c in range(int(size[0]), capacity + 1):
        k = fits[c]
        with_ = best[c - size[:k]] + value[:k]
        i = int(with_.argmax())
        best[c], last[c] = (with_[i], i) if with_[i] > best[c - 1] else (best[c - 1], -1)
    times, c = np.zeros(len(lengths), np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            times[order[last[c]]] += 1
            c -= int(size[last[c]])
    return best[capacity].item(), times


@dataclass(frozen=True)
class Prices:
    """Whole-number prices of the lengths; no filling is worth more than
    ``most``, so pieces need their worth over ``most`` sequences."""

    of: dict[int, int]
    most: int

    def bound(self, counts: dict[int, int]) -> int:
        return -(-sum(self.of.get(n, 0) * c for n, c in counts.items()) // self.most)


def _first_basis(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A filling per length (columns, lengths falling) and how often each is
    used: each the least waste with the largest length left, used until one
    of its lengths is spent and not used again."""
    place = {n: i for i, n in enumerate(sorted(counts, reverse=True))}
    left = {n: float(counts[n]) for n in place}
    basis, uses = np.diag([capacity // n for n in place]), np.zeros(len(place))
    while left:
        largest = next(iter(left))
        any_ = {n: capacity for n in left}
        each = Counter((largest, *(fillings(any_, capacity - largest, 1, [LISTED]) or [()])[0]))
        spent = min(each, key=lambda n: left[n] / each[n])
        times = left.pop(spent) / each[spent]
        basis[:, place[spent]] = 0
        for n, k in each.items():
            basis[place[n], place[spent]] = k
            if n != spent:
                left[n] = max(0.0, left[n] - k * times)
        uses[place[spent]] = times
    return basis, uses


def relaxed(counts: dict[int, int], capacity: int, pivots: list[int], enough: int) -> tuple[list[tuple[tuple[int, ...], float]], Prices]:
    """Fillings and how often the linear relaxation uses each, and prices.
    The simplex method over all fillings, the best one entering, until the
    bound is ``enough``; stopped by the budget, the uses are feasible and the
    prices valid all the same."""
    lengths = np.array(sorted(counts, reverse=True), dtype=np.int64)
    need = np.array([counts[int(n)] for n in lengths], dtype=float)
    basis, uses = _first_basis(counts, capacity)
    inverse = np.linalg.inv(basis)
    best, kept = 0.0, inverse.sum(axis=0)
    for step in count(1):
        price = inverse.sum(axis=0)
        worth, times = _fullest(lengths, price.clip(0), capacity)
        value = float(price.clip(0) @ need) / max(worth, 1.0)
        if value > best:
            best, kept = value, price
        # No filling improves, or the bound has reached the uses.
        if worth <= 1 + 1e-9 or np.ceil(best - 1e-3) >= min(enough, uses.sum() - 1e-6) or pivots[0] <= 0:
            break
        pivots[0] -= 1
        change = inverse @ times
        ratio = np.where(change > 1e-9, uses / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = times
        if step % 200:
            row = inverse[out] / change[out]
            inverse -= np.outer(change, row)
            inverse[out] = row
        else:
            inverse = np.linalg.inv(basis)
        uses = (uses - ratio[out] * change).clip(0)
        uses[out] = ratio[out]
    whole = np.floor(kept.clip(0) * (1 << 30)).astype(np.int64)
    prices = Prices(dict(zip(lengths.tolist(), whole.tolist(), strict=True)), max(1, _fullest(lengths, whole, capacity)[0]))
    names = lengths.tolist()
    used = [(tuple(n for n, k in zip(names, basis[:, j].tolist(), strict=True) for _ in range(k)), float(uses[j])) for j in range(len(names))]
    return used, prices


def round_relaxed(counts: dict[int, int], capacity: int, best: Plan, pivots: list[int]) -> tuple[Plan, Prices]:
    """The relaxation's fillings as often as its uses rounded down; then those
    nearest to one more; the relaxation of what is left goes on alike."""
    first: Prices | None = None
    left, plan = dict(counts), []
    while left:
        size = sum(c for _, c in best)
        used, prices = relaxed(left, capacity, pivots, size - sum(c for _, c in plan))
        first = first or prices
        if first.bound(counts) >= size:
            break
        used.sort(key=lambda g: g[1] - int(g[1] + 1e-6), reverse=True)
        taken = 0
        for extra in (False, True):
            for rank, (filling, n) in enumerate(used):
                if extra and rank and n - int(n + 1e-6) < 0.75:
                    break
                each = Counter(filling)
                times = min([1 if extra else int(n + 1e-6), *(left.get(x, 0) // k for x, k in each.items())])
                if times > 0:
                    plan.append((filling, times))
                    taken += times
                    for x, k in each.items():
                        left[x] -= k * times
        left = {n: c for n, c in left.items() if c}
        rest = best_fit_decreasing(left, capacity)
        if sum(c for _, c in plan) + sum(c for _, c in rest) < sum(c for _, c in best):
            best = [*plan, *rest]
        if not taken or pivots[0] <= 0:
            break
    return best, first


def complete_bins(counts: dict[int, int], capacity: int, best: Plan, bound: int, nodes: int = NODES, prices: Prices | None = None) -> Plan:
    """Branch and bound over the completions of the largest piece's bin. If it
    ends within its budget, no plan uses fewer sequences."""
    total = sum(n * c for n, c in counts.items())
    size = sum(c for _, c in best)
    left, listed = [nodes], [LISTED]
    # Fewest sequences with which the same pieces were left over.
    known: dict[int, int] = {}
    # Each entry: counts, plan, sequences, waste so far, (filling, times)
    # still to try from the last on, fillings listed so far (None: all are).
    stack: list[list] = [[dict(counts), [], 0, 0, [], 0]]
    while stack and left[0] > 0 and listed[0] > 0 and size > bound:
        state = stack[-1]
        now, plan, n_used, waste, tries, n_listed = state
        allowed = (size - 1) * capacity - total
        if not tries:
            if n_listed is None:
                stack.pop()
                continue
            if not n_listed:
                left[0] -= 1
            largest = max(now, default=0)
            if not largest:
                if n_used < size:
                    best, size = list(plan), n_used
                stack.pop()
                continue
            now[largest] -= 1
            most = 4 * n_listed or FILLINGS
            found = fillings(now, capacity - largest, most, listed)
            now[largest] += 1
            state[4] = [((largest, *f), None) for f in found[n_listed:]][::-1]
            state[5] = most if len(found) >= most else None
            continue
        filling, times = tries.pop()
        need = Counter(filling)
        lost = capacity - sum(filling)
        if waste + lost > allowed:
            # Those listed later waste as much or more.
            stack.pop()
            continue
        if times is None:
            times = min(now[n] // k for n, k in need.items())
            if lost:
                times = min(times, (allowed - waste) // lost)
        if times > 1:
            tries.append((filling, times - 1))
        if waste + lost * times > allowed:
            continue
        after = {n: c - need.get(n, 0) * times for n, c in now.items()}
        after = {n: c for n, c in after.items() if c}
        if prices and n_used + times + prices.bound(after) >= size:
            continue
        key = hash(frozenset(after.items()))
        if known.get(key, size) <= n_used + times:
            continue
        known[key] = n_used + times
        stack.append([after, [*plan, (filling, times)], n_used + times, waste + lost * times, [], 0])
    return best


def plan_sequences(counts: dict[int, int], capacity: int, nodes: int = NODES) -> Plan:
    """(lengths of a sequence, number of such sequences) for a histogram."""
    counts = {int(n): int(c) for n, c in counts.items() if c}
    best = best_fit_decreasing(counts, capacity)
    bound = lower_bound(counts, capacity)
    if sequences(best) <= bound:
        return best
    for waste in WASTES:
        best = min(best, descend(counts, capacity, waste), key=sequences)
        if sequences(best) <= bound:
            return best
    best = complete_bins(counts, capacity, best, bound, min(nodes, DIVE))
    if sequences(best) <= bound:
        return best
    better, prices = round_relaxed(counts, capacity, best, [PIVOTS])
    stronger = max(bound, prices.bound(counts))
    if sequences(better) <= stronger or (sequences(better) == sequences(best) and stronger == bound):
        # Proven, or the search would only repeat itself.
        return better
    return complete_bins(counts, capacity, better, stronger, nodes, prices)


def _slots(plan: Plan) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, in order of (length, rank): from
    rank ``low`` on, to sequences from ``base`` on, at ``offset``."""
    rank: Counter = Counter()
    rows, base = [], 0
    for filling, times in plan:
        offset = 0
        for n in filling:
            rows.append((n, rank[n], base, offset))
            rank[n] += times
            offset += n
        base += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    return dict(zip(("length", "low", "base", "offset"), cols, strict=True))


#: Ranks per length are below this.
_RANKS = 1 << 48


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, sequence_id,
    offset (and ids with ``with_ids``).

    A null or empty text is one piece, the end id. Repeated rows and null ids
    are documents of their own; an empty table gives an empty result; other
    columns are ignored. ``tokenizer_path`` must exist on every executor.
    """
    cut = staged(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids), "pieces")
    per_part = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(plan_sequences(counts, capacity))
    names = [c for c in cut.columns if c not in ("part", "nth")]

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        keys = slots["length"] * _RANKS + slots["low"]
        for b in batches:
            if b["length"]:
                rank = np.array(b["rank"], dtype=np.int64)
                k = np.searchsorted(keys, np.array(b["length"], dtype=np.int64) * _RANKS + rank, side="right") - 1
                b["sequence_id"] = slots["base"][k] + rank - slots["low"][k]
                b["offset"] = slots["offset"][k]
                yield b

    ranked = cut.join(before, ["part", "length"]).select(*names, (F.col("before") + F.col("nth")).alias("rank"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in cut.select(*names).schema]
    out = map_rows(ranked, run, ", ".join([*fields, "sequence_id long", "offset long"]))
    return out.withColumnRenamed("id", id_col)
