import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import DATA, needs_data
from tidemill.llm.queries import QUERIES
from tidemill.llm.urls import RULES, UNWANTED, Finder, Rule, RuleBook, Vocabulary, judged, split


def test_split():
    assert split("HTTP://User@WWW.Example.com:80/En/x?q=/#/y") == ("user@www.example.com:80", "/En/x")
    assert split("x://h?a/b") == ("h", "") and split("x://h#a/b") == ("h", "") and split("x://") == ("", "")
    assert split("no scheme/at all") == ("", "") and split("a://b://c/d") == ("b:", "//c/d") and split("s://ÄB.de/É") == ("Äb.de", "/É")


def test_the_longest_rule_wins_for_hosts_and_subdomains():
    book = RuleBook(RULES)
    text = lambda url: getattr(book.rule(*split(url)), "text", None)
    assert text("http://example.com/en/1") == "example.com/en/" and text("http://m.example.com/en/1") == "example.com/en/"
    assert text("http://a.www.example.com/en/") == "www.example.com/en/" and text("http://example.com/de/1") == "com/"
    assert text("http://myexample.com/en/1") == "com/" and text("http://com/") == "com/" and text("http://com") is None and text("http://x.com?a") is None
    assert text("http://x.net/es/") == "net/es/" and text("http://x.net/es") is None and text("http://x.org/es/") is None
    tied = RuleBook([Rule("allow", "b.c/x"), Rule("block", "c/xyz"), Rule("allow", "c/xyz")])
    assert tied.rule("b.c", "/xyz").text == "b.c/x" and tied.rule("a.c", "/xyz").verdict == "block"
    with pytest.raises(ValueError):
        RuleBook([Rule("maybe", "c/")])


def test_boundaries_and_weights():
    find = Finder(Vocabulary(("casino",), ("free", "bets", "bet", "Win")))
    assert find.hits("http://CASINO.x/casino1/1casino/casino") == {"casino": 2} and find.hits("http://freebets/betsé") == {"bets": 1}
    assert find.hits("free-bets/bet_win") == {"free": 1, "bets": 1, "bet": 1, "win": 1} and find.hits("") == {}
    assert Finder(Vocabulary((), ())).hits("free") == {}
    for wrong in (Vocabulary(("",), ()), Vocabulary((), ("a",), limit=1)):
        with pytest.raises(ValueError):
            wrong.weights()


@settings(max_examples=150)
@given(st.text(alphabet="abAB-./:é1 ", max_size=30))
def test_hits_are_those_of_a_regular_expression(url):
    terms = ("ab", "a", "b", "aba", "a-b")
    low = "".join(c.lower() if c in "AB" else c for c in url)
    want = {t: n for t in terms if (n := len(re.findall(f"(?<![a-z0-9])(?={re.escape(t)}(?![a-z0-9]))", low)))}
    assert Finder(Vocabulary(terms[:1], terms[1:])).hits(url) == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "http://casino.org/"), (3, "http://a.org/" + "x" * 200_000 + "/casino/"), (4, "http://free.org/x?free#free"), (4, "http://free.org/x?free#free"), (5, "free win"), (6, "https://casino.com/")]
    pages = spark.createDataFrame([(i, u, "v", "r") for i, u in rows], "page_id long, url string, verdict string, host string").repartition(3)
    got = judged(pages).collect()
    of = {r.page_id: r for r in got}
    assert len(got) == len(rows) and (of[1].host, of[1].path, of[1].rule, of[1].verdict) == (of[2].host, of[2].path, of[2].rule, of[2].verdict) == ("", "", None, "allow")
    assert of[None].verdict == of[3].verdict == of[5].verdict == "block" and of[4].verdict == "allow" and of[4].soft_hits == 1
    assert (of[6].rule, of[6].verdict, of[6].strict_hits) == ("com/", "allow", 1)
    assert judged(pages.limit(0)).count() == 0


@needs_data
def test_query(spark):
    got = QUERIES["op11_urls"](spark, DATA).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    assert {r.page_id for r in got} == pages.keys() and len(got) == len(pages)
    bad = Finder(UNWANTED)
    for r in got:
        if r.rule is None:
            assert r.verdict == ("block" if sum(bad.weights[t] for t in bad.hits(pages[r.page_id])) >= 2 else "allow")
