"""Token counts by byte-pair merging with a heap and a linked list.

A text's count is the number of its initial symbols less the number of
merges; no token identifier is made. The vocabulary is a sentencepiece BPE
model with byte fallback: a symbol outside the vocabulary counts one for each
of its UTF-8 bytes.

A text is cut where no piece of the vocabulary can reach across (before a
run of word marks that follows something else, and around characters that
are in no piece), so each unit merges on its own and short units' counts are
remembered within bounds.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import map_rows, text_or_empty, worker_state

MARK = "▁"
#: Units up to this many characters are remembered, so many at most.
REMEMBERED_CHARS = 48
REMEMBERED_UNITS = 700_000


class MergeCounter(dict):
    """Maps a unit to its number of tokens; ``count`` takes a whole text."""

    def __init__(self, model_path: str):
        import sentencepiece

        super().__init__()
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = range(sp.get_piece_size())
        if not any(map(sp.is_byte, ids)):
            raise ValueError("the model has no byte fallback")
        plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        if any(map(sp.is_unused, plain)):
            raise ValueError("models with unused pieces are not supported")
        #: Lower merges first.
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("a piece has a word mark after another character")
        self.normalize = sp.normalize
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in self.rank))
        self.units = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else "")).findall

    def count(self, text: str) -> int:
        if not text:
            return 0
        n = sum(map(self.__getitem__, self.units(self.normalize(text))))
        if len(self) > REMEMBERED_UNITS:
            self.clear()
        return n

    def __missing__(self, unit: str) -> int:
        n = self.merged(unit)
        if len(unit) <= REMEMBERED_CHARS:
            self[unit] = n
        return n

    def merged(self, unit: str) -> int:
        """Initial symbols less merges."""
        rank = self.rank
        count = len(unit)
        for c in unit:
            if c not in rank:
                count += len(c.encode()) - 1
        symbols = list(unit)
        last = len(symbols) - 1
        if not last:
            return count
        after = list(range(1, last + 2))
        before = list(range(-1, last))
        heap = []
        for i in range(last):
            pair = symbols[i] + symbols[i + 1]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            left = symbols[i]
            j = after[i]
            # An entry is stale when either side has merged meanwhile.
            if left is None or j > last or left + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, None
            count -= 1
            k = after[i] = after[j]
            if k <= last:
                before[k] = i
                new = pair + symbols[k]
                if new in rank:
                    heapq.heappush(heap, (rank[new], i, new))
            h = before[i]
            if h >= 0:
                new = symbols[h] + pair
                if new in rank:
                    heapq.heappush(heap, (rank[new], h, new))
        return count


def counter(model_path: str) -> MergeCounter:
    return worker_state(f"merge-counter:{model_path}", lambda: MergeCounter(model_path))


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit.

    Null or empty text: 0 bytes, 0 tokens. Null ids and repeated rows are
    returned as they come; an empty table gives an empty result; other
    columns are ignored. ``model_path`` must exist on every executor.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        count = counter(model_path).count
        for b in batches:
            n = [count(t) for t in b["t"]]
            yield {"id": b["id"], "n_bytes": b["n"], "n_tokens": n, "over_limit": [x > limit for x in n]}

    text = text_or_empty(F.col(text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text.alias("t"), F.octet_length(text).cast("long").alias("n"))
    out = map_rows(rows, run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
