"""URL filter: host and path rules, then a weighted vocabulary.

The longest rule that fits decides. A url without one is judged by its
vocabulary: an Aho-Corasick automaton finds the terms of the lower-cased url
that stand between boundaries (no ASCII letter or digit beside them); one
strict term blocks it, and so do soft terms of ``min_soft`` distinct entries.
Forms of one word (``bet``, ``bets``) are one entry.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import map_rows, worker_state
from sigflow.llm.url_terms import SOFT, STRICT, entry, terms

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


@dataclass(frozen=True)
class Vocabulary:
    """Terms are lower-case; a url is blocked by one strict term or by soft
    terms of ``min_soft`` distinct entries. ``entry`` gives a term's entry."""

    strict: tuple[str, ...] = terms(STRICT)
    soft: tuple[str, ...] = terms(SOFT)
    min_soft: int = 2
    entry: Callable[[str], str] = entry


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str = field(default="block")

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty for null or without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_column(host: Column, path: Column, rules: tuple[Rule, ...], pick) -> Column:
    """``pick`` of the longest rule whose host is the url's or a parent of it
    and whose path begins the url's; null without one. Of equally long rules
    the first in alphabetical order."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(pick(r))).otherwise(out)
    return out


class TermFinder:
    """The automaton of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.min_soft = vocabulary.min_soft
        self.automaton = ahocorasick.Automaton()
        strict = frozenset(vocabulary.strict)
        for term in {*vocabulary.strict, *vocabulary.soft}:
            self.automaton.add_word(term, (len(term), vocabulary.entry(term), term in strict))
        self.automaton.make_automaton()

    def hits(self, url: str) -> tuple[set[str], set[str]]:
        """Distinct entries of strict and of soft terms with a boundary on
        both sides. A term of both kinds counts as strict."""
        strict: set[str] = set()
        soft: set[str] = set()
        text = url.translate(_TO_LOWER)
        for end, (length, word, is_strict) in self.automaton.iter(text):
            begin = end - length
            if (begin < 0 or text[begin] not in _WORD) and (end + 1 == len(text) or text[end + 1] not in _WORD):
                (strict if is_strict else soft).add(word)
        return strict, soft


_TO_LOWER = str.maketrans(UPPER, LOWER)
_WORD = frozenset(LOWER + "0123456789")


def filter_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    vocabulary: Vocabulary = Vocabulary(),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, n_strict, n_soft
    (entries found).

    Null urls and urls without ``://`` have an empty host and path, so no
    rule fits; a url without ``://`` is still judged by its terms, a null one
    is allowed. Null ids and repeated rows come back as they are; an empty
    table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        finder = worker_state(f"terms:{vocabulary!r}", lambda: TermFinder(vocabulary))
        for b in batches:
            found = [finder.hits(u or "") for u in b.pop("url")]
            b["n_strict"] = [len(strict) for strict, _ in found]
            b["n_soft"] = [len(soft) for _, soft in found]
            b["verdict"] = [
                v or ("block" if strict or len(soft) >= finder.min_soft else "allow")
                for v, (strict, soft) in zip(b["verdict"], found, strict=True)
            ]
            yield b

    kind = pages.schema[id_col].dataType.simpleString()
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    host, path = F.col("host"), F.col("path")
    rows = rows.select(
        "*",
        rule_column(host, path, rules, lambda r: r.text).alias("rule"),
        rule_column(host, path, rules, lambda r: r.verdict).alias("verdict"),
    )
    schema = f"id {kind}, host string, path string, rule string, verdict string, n_strict int, n_soft int"
    return map_rows(rows, run, schema).withColumnRenamed("id", id_col)
