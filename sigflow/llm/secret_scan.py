"""Secret scans: patterns, and novelty against a primed zstandard compressor.

Three patterns (assignments, access keys, long hexadecimal runs) give the
base findings. Beyond them, each long token after a word that announces a
secret is a candidate. It is compressed behind the identifier dictionary and
the code that surrounds it; its marginal compressed bytes are what the frame
has more than one without it. Names, paths, placeholders and repeats are made
of what the dictionary or the surroundings hold, and cost little; a random
string costs about a byte for each character, and is reported.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import map_rows, text_or_empty, worker_state

# The base patterns, by kind in the order of the findings.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 8, 16, 32

#: Words that announce a secret.
SENSITIVE = (
    "access", "account_key", "apikey", "api_key", "api-key", "auth", "bearer", "certificate", "client_id",
    "credential", "cookie", "dsn", "encryption", "hmac", "jwt", "key", "license_key", "login", "nonce", "oauth",
    "passphrase", "passwd", "password", "pin", "private", "pwd", "salt", "secret", "session", "signature",
    "signing", "ssh", "token", "webhook",
)
#: Words of identifiers, configuration and placeholders: the dictionary that
#: every candidate is compressed behind. The most telling come last, where
#: the compressor reaches them with the shortest offsets.
IDENTIFIERS = (
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 9876543210 zyxwvutsrqponmlkjihgfedcba",
    "import return class public static void function const let var def self this null none true false lambda",
    "string integer boolean double float object array list dict map set bytes buffer char long short unsigned",
    "application/json text/html charset=utf-8 Content-Type Content-Length User-Agent Accept-Encoding keep-alive",
    "http:// https:// www. .com/ .org/ .net/ .html index.php?id= /api/v1/ /api/v2/ /usr/local/bin/ /etc/ /var/lib/ /home/",
    "localhost 127.0.0.1 0.0.0.0 example.com user@example.com admin root guest default development production staging test",
    "SELECT FROM WHERE INSERT UPDATE DELETE CREATE TABLE PRIMARY KEY NOT NULL VARCHAR INTEGER TIMESTAMP",
    "2019-01-01 2020-01-01 2021-01-01 2022-01-01 2023-01-01 2024-01-01 2025-01-01 T00:00:00Z +00:00 UTC",
    "created_at updated_at deleted_at timestamp datetime date_time first_name last_name user_name username user_id",
    "account_id customer_id order_id product_id session_id request_id response_id transaction_id message_id client_id",
    "get_ set_ is_ has_ add_ remove_ update_ delete_ create_ find_ load_ save_ read_ write_ open_ close_ start_ stop_",
    "config configuration settings options parameters arguments environment variable property attribute element",
    "connection database server client host port timeout retry interval maximum minimum default_value max_length min_length",
    "service manager handler factory provider controller repository adapter listener builder helper utility context session",
    "encoder decoder encrypt decrypt hash digest signature certificate public_key private_key primary_key foreign_key",
    "access_token refresh_token id_token auth_token bearer_token csrf_token api_key secret_key client_secret access_key_id",
    "authorization authentication authenticate credentials password_hash password_reset old_password new_password passphrase",
    "getElementById addEventListener querySelector toString valueOf hasOwnProperty XMLHttpRequest setTimeout",
    "your_api_key_here YOUR_SECRET_KEY insert_token_here changeme CHANGE_ME placeholder example sample dummy redacted",
    "xxxxxxxxxxxxxxxx XXXXXXXXXXXXXXXX **************** ---------------- 0000000000000000 1111111111111111 ................",
)


@dataclass(frozen=True)
class Novelty:
    """How candidates are chosen and judged. A candidate has ``least``
    characters or more, a letter and a digit, and has a sensitive word on its
    line in the ``reach`` characters before it. It is reported if its
    marginal compressed bytes are ``percent`` per cent of its length or more.
    ``window`` characters on each side are its surroundings."""

    least: int = 16
    reach: int = 48
    window: int = 1024
    percent: int = 80


class Scanner:
    """Finds the spans of a text: (kind, start, end), in code points."""

    def __init__(self, novelty: Novelty):
        import zstandard

        self.novelty = novelty
        self.zstd = zstandard
        self.assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE).finditer
        self.access = re.compile(ACCESS).finditer
        self.hex = re.compile(HEX[:-1] + "{%d,}" % HEX_CHARS).finditer  # runs are whole: the shorter fail
        self.tokens = re.compile("[A-Za-z0-9+/_=-]{%d,}" % novelty.least).finditer
        self.announced = re.compile("|".join(map(re.escape, SENSITIVE)), re.ASCII | re.IGNORECASE).search
        self.identifiers = " ".join(IDENTIFIERS).encode()

    def base(self, text: str) -> list[tuple[str, int, int]]:
        found = [("assign", *m.span()) for m in self.assign(text) if len(m[2]) >= ASSIGN_CHARS]
        if "AKIA" in text:
            found += [("access", *m.span()) for m in self.access(text) if len(m[0]) >= ACCESS_CHARS]
        found += [("hex", *m.span()) for m in self.hex(text)]
        return sorted(found, key=_place)

    def candidates(self, text: str) -> Iterator[tuple[int, int]]:
        """Long tokens behind a sensitive word."""
        for m in self.tokens(text):
            start = m.start()
            if not _mixed(m[0]):
                continue
            line = text[max(0, start - self.novelty.reach) : start].rpartition("\n")[2]
            if self.announced(line):
                yield start, m.end()

    def marginal(self, before: str, candidate: str, after: str) -> int:
        """Compressed bytes that the candidate adds to its surroundings."""
        # Copies of the candidate nearby don't make it less of a secret.
        around = (after.replace(candidate, " ") + "\n" + before.replace(candidate, " ")).encode()
        primed = self.zstd.ZstdCompressionDict(self.identifiers + b"\n" + around, dict_type=self.zstd.DICT_TYPE_RAWCONTENT)
        press = self.zstd.ZstdCompressor(level=3, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False)
        return len(press.compress(candidate.encode())) - len(press.compress(b""))

    def novel(self, text: str, known: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Incompressible candidates that no base finding overlaps."""
        spans = sorted((s, e) for _, s, e in known)
        reach = self.novelty.window
        found, i = [], 0
        for start, end in self.candidates(text):
            while i < len(spans) and spans[i][1] <= start:
                i += 1
            if any(s < end and start < e for s, e in spans[i : i + len(KINDS)]):
                continue
            own = self.marginal(text[max(0, start - reach) : start], text[start:end], text[end : end + reach])
            if 100 * own >= self.novelty.percent * (end - start):
                found.append(("novel", start, end))
        return found

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        found = self.base(text)
        return sorted(found + self.novel(text, found), key=_place)


def _place(span: tuple[str, int, int]) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def _mixed(token: str) -> bool:
    return any(map(str.isdigit, token)) and any(map(str.isalpha, token))


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan_secrets(docs: DataFrame, novelty: Novelty = Novelty(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, spans (array of kind, start, end, in code
    points, the end exclusive; by start, then by kind as in ``KINDS``).

    Null or empty text: no spans. Null ids and repeated rows come back as
    they are; an empty table gives an empty result; other columns are
    ignored. Texts are scanned whole; a candidate's surroundings are a window
    of fixed size on each side.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        scanner: Scanner = worker_state(f"secrets:{novelty}", lambda: Scanner(novelty))
        for b in batches:
            found = map(scanner.scan, b["t"])
            yield {"id": b["id"], "spans": [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in own] for own in found]}

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("t"))
    out = map_rows(rows, run, f"id {kind}, spans array<struct<kind:string,start:int,end:int>>")
    return out.withColumnRenamed("id", id_col)


def secret_digest(found: DataFrame) -> DataFrame:
    """The result of ``scan_secrets`` as counts of the base kinds, a SHA-256
    of the base findings and all findings as text (kind:start:end, joined by
    commas); the other columns as they are."""

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != KINDS[-1])
    return found.select(
        *[c for c in found.columns if c != "spans"],
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
