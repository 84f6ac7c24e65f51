"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Long texts are cut at boundaries that no match of the pattern can cross
(before an ASCII space that follows a character which is not white space), so
the identifiers are those of the whole text and memory stays bounded.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import map_rows, text_or_empty, worker_state

#: Characters per segment of a long text.
SEGMENT = 1 << 16
# Unicode's white space, and characters some engines count too.
MAYBE_SPACE = r"\t-\r\x1c-\x20\x85\xa0 ᠎ -​    ⁠　﻿"
_CUT = re.compile(f"[^{MAYBE_SPACE}](?=[ \n\t])")


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Pieces of ``text``, cut only at safe boundaries, of ``size``
    characters and on to the next boundary. Text without one stays whole."""
    begin = 0
    while len(text) - begin > size:
        cut = _CUT.search(text, begin + size - 1)
        if not cut:
            break
        yield text[begin : cut.end()]
        begin = cut.end()
    yield text[begin:] if begin else text


def encoding(rank_path: str, pattern: str):
    """The tiktoken encoding of a rank file, made once per Python worker."""

    def make():
        import tiktoken

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return worker_state(f"tiktoken:{rank_path}:{pattern}", make)


def encode_text(enc, text: str) -> np.ndarray:
    parts = [np.array(enc.encode_ordinary(s), dtype="<u4") for s in segments(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def decode_ids(enc, ids: np.ndarray) -> bytes:
    """Raw bytes; nothing is replaced when they are not valid UTF-8."""
    return enc.decode_bytes(ids.tolist())


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (binary, little-endian unsigned 32-bit) of each row's whole
    text. Null or empty text: no ids. Repeated rows and null ids come back as
    they are; an empty table gives an empty result."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        enc = encoding(rank_path, pattern)
        for b in batches:
            yield {"id": b["id"], "ids": [encode_text(enc, t).tobytes() for t in b["t"]]}

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("t"))
    return map_rows(rows, run, f"id {kind}, ids binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """id, data (binary): the bytes of each row's ids. Null ids: no bytes."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        enc = encoding(rank_path, pattern)
        for b in batches:
            yield {"id": b["id"], "data": [decode_ids(enc, np.frombuffer(x or b"", dtype="<u4")) for x in b["ids"]]}

    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("id"), "ids")
    return map_rows(rows, run, f"id {kind}, data binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: each text encoded, its ids
    decoded again, in one pass. Defined as ``encode`` and ``decode``."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        enc = encoding(rank_path, pattern)
        for b in batches:
            ids = [encode_text(enc, t) for t in b["t"]]
            yield {
                "id": b["id"],
                "n_tokens": [len(x) for x in ids],
                "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(decode_ids(enc, x)).hexdigest() for x in ids],
            }

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("t"))
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(rows, run, schema).withColumnRenamed("id", id_col)
