"""Quality rules: a table of thresholds compiled into Spark expressions.

Each rule bounds the ratio of two counts of a text; all counts are built-in
functions, without user functions. Ratios are compared as whole numbers
(``1000 * numerator`` against ``bound * denominator``), so no rounding takes
part.

Arrays that a lambda reads at several places are bound as the variable of an
outer ``transform`` over a one-element array. Written as plain columns they
would be put into the lambda by the optimizer and computed per element.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import new_name, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
TRAILING = ".,;:!?"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent function words of English, German, French, Spanish.
STOP_WORDS = (
    "a an and are as at be by for from has have in is it not of on or that the this to was were with "
    "das dem den der des die ein eine einer für im ist mit nicht sich sie und von zu "
    "au aux avec ce dans des du elle est et il la le les ne pas par pour que qui sur un une "
    "al como con de del el en es la las lo los no para por que se su un una y"
).split()


@dataclass(frozen=True)
class Threshold:
    """Keep where ``low <= 1000 * part / whole <= high``; a rule with
    ``from_words`` speaks of texts of that many words or more."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    from_words: int = 0


THRESHOLDS = (
    Threshold("mean_word_chars", "word_chars", "n_words", low=1_500, high=20_000),
    Threshold("symbol_ratio", "n_symbols", "n_words", high=250),
    Threshold("exclamation_ratio", "n_exclaims", "n_words", high=400),
    Threshold("stop_word_ratio", "n_stop_words", "n_words", low=5, from_words=100),
    Threshold("duplicate_line_ratio", "n_dup_lines", "n_lines", high=500),
    Threshold("bullet_line_ratio", "n_bullet_lines", "n_lines", high=900),
    Threshold("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", high=500),
)
#: Counts that ``statistics`` gives, all bigint.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_exclaims", "n_stop_words",
    "n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines", "n_repeat_words",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _windows(words: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of each run of WINDOW words."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(1)))
    return F.transform(starts, lambda i: make(F.slice(words, i, WINDOW)))


def _covered(windows: Column) -> Column:
    """Words in windows found twice or more: windows sorted by text, those
    equal to a neighbour kept, the union of their places measured."""
    keyed = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        def has_twin(x: Column, j: Column) -> Column:
            same = lambda k: F.coalesce(F.get(s, k)["w"] == x["w"], F.lit(False))
            return same(j - 1) | same(j + 1)

        return F.array_sort(F.transform(F.filter(s, has_twin), lambda x: x["i"].cast("long")))

    zero = F.lit(0).cast("long")
    return F.aggregate(
        let(keyed, repeated),
        F.struct(zero.alias("end"), zero.alias("words")),
        lambda acc, i: F.struct(
            (i + WINDOW).alias("end"), (acc["words"] + i + WINDOW - F.greatest(i, acc["end"])).alias("words")
        ),
        lambda acc: acc["words"],
    )


def repeat_words(words: Column) -> Column:
    """Number of words in 8-word windows that the text has twice or more. The
    windows' hashes tell most texts without any; the rest compares the
    windows' words."""
    hashes = _windows(words, lambda w: F.xxhash64(w))
    any_twice = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    exact = _covered(_windows(words, lambda w: F.array_join(w, " ")))
    return F.when((F.size(words) > WINDOW) & any_twice, exact).otherwise(F.lit(0).cast("long"))


def _word_counts(w: Column) -> Column:
    stop = F.filter(w, lambda x: F.lower(F.rtrim(x, F.lit(TRAILING))).isin(STOP_WORDS))
    return F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.size(stop).cast("long").alias("n_stop_words"),
        repeat_words(w).alias("n_repeat_words"),
    )


def _line_counts(lines: Column) -> Column:
    count = lambda pattern: F.size(F.filter(lines, lambda x: x.rlike(pattern)))
    return F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        count(r"^[\x20\x09-\x0D]*[-*•]").cast("long").alias("n_bullet_lines"),
        count(r"(\.\.\.|…)[\x20\x09-\x0D]*$").cast("long").alias("n_ellipsis_lines"),
    )


def statistics(text: Column) -> Column:
    """A struct of COUNTS for a text (null: empty)."""
    text = text_or_empty(text)

    def of(t: Column) -> Column:
        words = let(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), _word_counts)
        lines = let(F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)), _line_counts)
        chars = F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long")
        parts = F.struct(words.alias("w"), lines.alias("l"))
        return let(
            parts,
            lambda p: F.struct(
                p["w"]["n_words"].alias("n_words"),
                chars.alias("word_chars"),
                without(t, SYMBOLS).cast("long").alias("n_symbols"),
                without(t, "!").cast("long").alias("n_exclaims"),
                p["w"]["n_stop_words"].alias("n_stop_words"),
                p["l"]["n_lines"].alias("n_lines"),
                p["l"]["n_dup_lines"].alias("n_dup_lines"),
                p["l"]["n_bullet_lines"].alias("n_bullet_lines"),
                p["l"]["n_ellipsis_lines"].alias("n_ellipsis_lines"),
                p["w"]["n_repeat_words"].alias("n_repeat_words"),
            ),
        )

    return let(text, of)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def passes(s: Column, table: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """All thresholds of the table. A whole of 0 passes (0 against 0)."""
    ok = F.lit(True)
    for t in table:
        part, whole = 1000 * s[t.part], s[t.whole]
        held = F.lit(True)
        if t.low is not None:
            held = held & (part >= t.low * whole)
        if t.high is not None:
            held = held & (part <= t.high * whole)
        ok = ok & (held | (s["n_words"] < t.from_words))
    return ok


def quality_rules(
    docs: DataFrame, table: tuple[Threshold, ...] = THRESHOLDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, COUNTS, base_failed, kept.

    A null or empty text has no words and fails the base rule. Null ids and
    repeated rows come back as they are; an empty table gives an empty
    result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col), statistics(F.col(text_col)).alias("s"))
    s = F.col("s")
    failed = base_failed(s)
    counts = [s[c].alias(c) for c in COUNTS]
    return rows.select(id_col, *counts, failed.alias("base_failed"), (~failed & passes(s, table)).alias("kept"))


def keep_good(docs: DataFrame, table: tuple[Threshold, ...] = THRESHOLDS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    s = new_name(docs, "quality")
    with_counts = docs.withColumn(s, statistics(F.col(text_col)))
    return with_counts.filter(~base_failed(F.col(s)) & passes(F.col(s), table)).drop(s)
