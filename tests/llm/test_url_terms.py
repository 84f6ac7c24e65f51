"""The vocabulary of the url filter."""

import re

import pytest

from sigflow.llm.url_filter import TermFinder, Vocabulary, filter_urls
from sigflow.llm.url_terms import entry


def test_terms_are_words_of_one_kind():
    v = Vocabulary()
    assert len(v.strict) > 150 and len(v.soft) > 250 and not set(v.strict) & set(v.soft)
    assert all(re.fullmatch("[a-z0-9]+", t) for t in (*v.strict, *v.soft))


@pytest.mark.parametrize(
    ("url", "blocked"),
    [
        ("http://h.io/gamblers/roulette", True),
        ("http://h.io/online-pharmacies?q=tramadol", True),
        ("http://h.io/sportsbooks", True),
        ("http://h.io/replica-watches/discounts", True),
        ("http://popups.adservers.h.io/", True),
        ("http://h.io/torrents/list", True),
        ("http://h.io/how-to-stop-spam", False),
        ("http://h.io/music/track/7?utm_source=x", False),
        ("http://h.io/essex/therapist", False),
        ("http://h.io/loan/loans", False),
        ("http://h.io/bet/bets?betting=1", False),
        ("http://h.io/casino/casinos", False),
        ("http://h.io/ads/advertising", False),
        ("http://h.io/casino/loans", True),
        ("http://h.io/BETTING/Bonuses", True),
        ("http://h.io/" + "loans-" * 100_000 + "x", False),
    ],
)
def test_general_urls(url, blocked):
    v = Vocabulary()
    strict, soft = TermFinder(v).hits(url)
    assert (bool(strict) or len(soft) >= v.min_soft) == blocked


def test_forms_of_a_word_are_one_entry():
    groups = ["loan loans", "bet bets betting bettor bettors", "gamble gambles gambling gambler gamblers", "win wins winner winners winning winnings",
              "ad ads adverts advertising advertisements", "scam scams scammer", "lottery lotteries lotto", "bonus bonuses", "prize prizes", "track tracked trackers"]
    assert [len({entry(t) for t in g.split()}) for g in groups] == [1] * len(groups)
    assert len({entry(g.split()[0]) for g in groups}) == len(groups)
    for apart in ("click cash", "casino crack", "drug drugstore", "gift giftcard", "slot slimming", "cialis cannabis", "deal diet", "pill pills pixel"):
        words = apart.split()
        assert len({entry(t) for t in words}) == (2 if len(words) == 3 else len(words))


def test_edge_rows(spark):
    rows = [(None, "http://h.io/casino/loans"), (1, None), (1, None), (2, "http://h.io/casino/casinos")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS host", "'x' AS id")
    got = sorted(((r.page_id, r.verdict, r.n_soft) for r in filter_urls(pages).collect()), key=str)
    assert got == [(1, "allow", 0), (1, "allow", 0), (2, "allow", 1), (None, "block", 2)]
    assert filter_urls(pages.limit(0)).count() == 0
