"""The operators' queries, with production parameters, each over its whole
table, and DuckDB SQL for those that SQL expresses.

Without SQL: op3 (a trained model), op4, op5, op8 and op13 (tokenizers;
packing), op11 (a compressor); ``tests/llm`` hold them against the libraries,
brute force, round trips, held-out labels and bounds.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sigflow.llm import byte_bpe, cross_align, exact_dedup, jaccard_join, lexical_search, license_rules, packing, quality, secret_scan, token_count, toxicity, url_filter, warc
from sigflow.llm.common import read_table, workers_find_package

CONTEXT_TOKENS = 4096
SEQUENCE_TOKENS = 1024
END_ID = 2
TOP = 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return read_table(spark, sf_dir, name)


def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records, read back by the salvage reader."""
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of each document by sentence rules."""
    found = license_rules.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "concat_ws(' ', sentence_ids) AS sentence_ids", "size(licenses) AS n_places", "license")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for each document."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document by heap-based merging."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_count.token_counts(_table(spark, sf_dir, "documents"), path, CONTEXT_TOKENS)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document encoded and decoded again."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for each page's url."""
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document."""
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.quality_rules(read_table(spark, sf_dir, "documents")).select(*names)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), path, SEQUENCE_TOKENS, END_ID)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each document under the similarity join."""
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of each document."""
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document by patterns and by novelty."""
    return secret_scan.secret_digest(secret_scan.scan_secrets(_table(spark, sf_dir, "documents")))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical_search.search(_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), TOP)


def op13_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between two tokenizers' tokens of each document."""
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return cross_align.align_tokens(_table(spark, sf_dir, "documents"), *paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc_salvage,
        op2_license_scans,
        op3_toxicity,
        op4_token_counts,
        op5_byte_bpe,
        op6_url_filter,
        op7_quality_rules,
        op8_best_fit_packing,
        op9_ngram_jaccard_join,
        op10_exact_dedup,
        op11_secret_scan,
        op12_ranked_search,
        op13_cross_align,
    )
}


# --------------------------------------------------------------------- SQL
def _strings(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS b
  FROM pages
), k AS (SELECT d, max(page_id) AS stays FROM p WHERE b >= 1000 GROUP BY d)
SELECT page_id, b AS payload_bytes, p.d AS payload_digest,
  CASE WHEN stays <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN stays <> page_id THEN stays END AS refers_to
FROM p LEFT JOIN k ON p.d = k.d AND b >= 1000
"""



def _license_sql() -> str:
    """The rules in their order, each replacing what it matches in the text
    of identifiers by a bar, so that none is used twice."""
    known = ", ".join(f"('{name}', '{sentence}')" for sentence, name in [*license_rules.VARIANTS.items(), *((t, n) for n, t in license_rules.SENTENCES.items())])
    steps, at = [], "ids"
    for i, rule in enumerate(license_rules.RULES):
        pattern = "".join(f"<{name}>" for name in rule.sentences)
        steps.append(f"r{i} AS (SELECT *, replace({at}, '{pattern}', '|') AS s{i}, (length({at}) - length(s{i})) // {len(pattern) - 1} AS c{i} FROM {f'r{i - 1}' if i else 'g'})")
        at = f"s{i}"
    last = len(steps) - 1
    names = ", ".join(f"CASE WHEN c{i} > 0 THEN '{rule.license}' END" for i, rule in enumerate(license_rules.RULES))
    places = " + ".join(f"c{i}" for i in range(len(steps)))
    return rf"""
WITH known(name, sentence) AS (VALUES {known}),
s AS (
  SELECT doc_id, unnest(split) AS raw, generate_subscripts(split, 1) AS nth
  FROM (
    SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '[.;:!?]([\x20\x09-\x0D])', chr(10) || '\1', 'g'), chr(10)) AS split
    FROM documents
  )
), f AS (
  SELECT doc_id, nth, name FROM s JOIN known ON trim(regexp_replace(lower(raw), '[^a-z0-9]+', ' ', 'g')) = sentence
), n AS (
  SELECT doc_id, string_agg('<' || name || '>', '' ORDER BY nth) AS ids, string_agg(name, ' ' ORDER BY nth) AS names FROM f GROUP BY doc_id
), g AS (SELECT doc_id, coalesce(ids, '') AS ids, coalesce(names, '') AS names FROM documents LEFT JOIN n USING (doc_id)),
{", ".join(steps)}
SELECT doc_id, names AS sentence_ids, CAST({places} AS INTEGER) AS n_places,
  nullif(array_to_string(list_sort(list_distinct(list_filter([{names}], lambda x: x IS NOT NULL))), ' AND '), '') AS license
FROM r{last}
"""


def _word_forms(terms: tuple[str, ...]) -> str:
    """Per entry its terms as alternatives of a pattern."""
    forms: dict[str, list[str]] = {}
    for t in terms:
        forms.setdefault(url_filter.Vocabulary().entry(t), []).append(t)
    return _strings("|".join(f) for f in forms.values())


_URL_SQL = f"""
WITH u AS (
  SELECT page_id, url,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
    translate(coalesce(url, ''), '{url_filter.UPPER}', '{url_filter.LOWER}') AS low
  FROM pages
), r(rhost, rpath, verdict) AS (VALUES {", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in url_filter.RULES)}),
fits AS (
  SELECT page_id, host, path, low, rhost || rpath AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST, rhost || rpath) AS nth
  FROM u LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
), terms AS (
  SELECT *,
    CAST(len(list_filter({_word_forms(url_filter.Vocabulary().strict)}, lambda t: regexp_matches(low, '(^|[^a-z0-9])(' || t || ')([^a-z0-9]|$)'))) AS INTEGER) AS n_strict,
    CAST(len(list_filter({_word_forms(url_filter.Vocabulary().soft)}, lambda t: regexp_matches(low, '(^|[^a-z0-9])(' || t || ')([^a-z0-9]|$)'))) AS INTEGER) AS n_soft
  FROM fits WHERE nth = 1
)
SELECT page_id, host, path, rule, n_strict, n_soft,
  coalesce(verdict, CASE WHEN n_strict > 0 OR n_soft >= {url_filter.Vocabulary().min_soft} THEN 'block' ELSE 'allow' END) AS verdict
FROM terms
"""


def _thresholds_sql() -> str:
    checks = []
    for t in quality.THRESHOLDS:
        held = [f"1000 * {t.part} >= {t.low} * {t.whole}"] if t.low is not None else []
        held += [f"1000 * {t.part} <= {t.high} * {t.whole}"] if t.high is not None else []
        checks.append(f"(({' AND '.join(held)}) OR n_words < {t.from_words})")
    return " AND ".join(checks)


_QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT r, i, array_to_string(words[i : i + 7], ' ') AS win
  FROM (SELECT r, words, unnest(range(1, CAST(len(words) AS BIGINT) - 6)) AS i FROM w)
), twice AS (
  SELECT r, i FROM windows JOIN (SELECT r, win FROM windows GROUP BY r, win HAVING count(*) > 1) USING (r, win)
), covered AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY r
), c AS (
  SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_exclaims,
    len(list_filter(words, lambda x: list_contains({_strings(quality.STOP_WORDS)}, lower(rtrim(x, '{quality.TRAILING}'))))) AS n_stop_words,
    len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered USING (r)
), b AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_thresholds_sql()} AS kept
FROM b
"""

_JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(CAST(len(words) AS BIGINT) - 3, CASE WHEN len(words) > 0 THEN 2 ELSE 1 END))) AS i FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
    JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN least ON least.a = d.doc_id
"""

_DEDUP_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

_SEARCH_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), size AS (
  SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d
), t AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY r, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term), size
), m AS (
  SELECT r, doc_id, 10 + (90 * CAST(len(terms) AS BIGINT) * n_docs) // n_terms AS m FROM d, size
), s AS (
  SELECT item_id, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM t JOIN w USING (term) JOIN m USING (r) JOIN i USING (term) GROUP BY item_id, r
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM s JOIN m USING (r) WHERE score > 0
)
WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc_salvage": _WARC_SQL,
    "op2_license_scans": _license_sql(),
    "op6_url_filter": _URL_SQL,
    "op7_quality_rules": _QUALITY_SQL,
    "op9_ngram_jaccard_join": _JACCARD_SQL,
    "op10_exact_dedup": _DEDUP_SQL,
    "op12_ranked_search": _SEARCH_SQL,
}
