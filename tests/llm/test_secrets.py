"""Secret scans: the base against a plain scan, the novelty on examples."""

import hashlib
import random
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import docs, package_on_workers, texts  # noqa: F401
from sigflow.llm import secret_scan
from sigflow.llm.secret_scan import Novelty, Scanner

WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
GROUP = set(string.ascii_letters + string.digits + "+/_.=-")


def plain_base(text):
    """The three kinds by hand, character by character."""
    low = "".join(c.lower() if c in string.ascii_uppercase else c for c in text)
    found, at = [], 0
    while at < len(text):
        word = next((w for w in WORDS if low.startswith(w, at)), None)
        end = _assigned(text, at + len(word)) if word else None
        if end:
            if end[1] - end[0] >= 8:
                found.append((at, 0, end[1]))
            at = end[1]
        else:
            at += 1
    for kind, first, chars, least in ((1, "AKIA", set(string.ascii_uppercase + string.digits), 16), (2, "", set("0123456789abcdef"), 32)):
        at = 0
        while at < len(text):
            end = at + len(first)
            if text.startswith(first, at):
                while end < len(text) and text[end] in chars:
                    end += 1
                if end > at + len(first):
                    if end - at >= least:
                        found.append((at, kind, end))
                    at = end
                    continue
            at += 1
    return [(secret_scan.KINDS[k], a, b) for a, k, b in sorted(found)]


def _assigned(text, at):
    """Where group 2 begins and ends, behind the word that ends at ``at``."""
    at += text[at : at + 1] in ('"', "'") and at < len(text)
    while text[at : at + 1] == " ":
        at += 1
    if text[at : at + 1] not in (":", "=") or at >= len(text):
        return None
    at += 1
    while text[at : at + 1] == " ":
        at += 1
    at += text[at : at + 1] in ('"', "'") and at < len(text)
    end = at
    while end < len(text) and text[end] in GROUP:
        end += 1
    return (at, end) if end > at else None


PIECES = ["password", "PassWD", "secret", "tOken", "api_key", "APIKEY", "apı", "ſecret", "=", ":", " ", "  ", "'", '"', "\n", "abcdefgh", "AKIA", "ABCDEFGH12", "0123456789abcdef", "é", "🙂", "-", ".", "x"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_base_equals_plain_scan(parts):
    text = "".join(parts)
    assert Scanner(Novelty()).base(text) == plain_base(text)


def test_base_spans_stay_and_novel_ones_are_new(docs, texts):  # noqa: F811
    got = {r["doc_id"]: r for r in secret_scan.secret_digest(secret_scan.scan_secrets(docs)).collect()}
    for i, t in texts:
        want = plain_base(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(secret_scan.spans_text(want).encode()).hexdigest()
        assert got[i]["n_novel"] == 0
    assert len(docs.collect()) == len(texts)


def novel(text):
    found = Scanner(Novelty()).scan(text)
    assert found == sorted(found, key=secret_scan._place)
    return [text[a:b] for kind, a, b in found if kind == "novel"]


def test_random_strings_in_sensitive_places_are_novel():
    rng = random.Random(5)
    for n in (16, 20, 40, 64):
        key = "".join(rng.choices(string.ascii_letters, k=n - 2)) + "7Q"
        assert novel(f"client credential is {key} for now") == [key]
        assert novel(f'"Authorization": "Bearer {key}"\nnext') == [key]
        # A copy nearby doesn't make it known, and both are reported.
        assert novel(f"signature {key}\nsession {key}\n") == [key, key]
        # No sensitive word before it, or on another line.
        assert novel(f"version {key} released") == []
        assert novel(f"credential\n{key}") == []


@pytest.mark.parametrize(
    "text",
    [
        "auth with your_api_key_here_1",
        "credential xxxxxxxxxxxxxxxxxxxx1",
        "session customer_account_id_2",
        "private /usr/local/bin/session_handler_2",
        "def load_signing_material_2024(): pass\nsignature load_signing_material_2024",
        "pin 0000000000000000a",
        "credential verylongwordwithoutanydigit",
    ],
)
def test_what_surroundings_explain_is_not_novel(text):
    # The second occurrence of a name is judged by what stands around it.
    code = "def load_signing_material_2023(): pass\n" + text
    assert novel(code) == []


def test_base_findings_are_not_reported_twice():
    key = "aB3dE5gH7jK9mN1pQ3sT5v"
    text = f"secret_token = {key}"
    assert [k for k, _, _ in Scanner(Novelty()).scan(text)] == ["assign"]


def test_very_long_text():
    text = "word " * 200_000 + "credential Zq8vT3kLm0PxWc7RyB2n" + " 0" * 100_000 + "a" * 40
    assert Scanner(Novelty()).scan(text) == [("novel", 1_000_011, 1_000_031), ("hex", len(text) - 41, len(text))]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert secret_scan.secret_digest(secret_scan.scan_secrets(none)).collect() == []
