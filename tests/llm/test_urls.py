"""URL filters against a plain version."""

import re

import pytest

from tally.llm.queries import op11_url_filter
from tally.llm.url_filter import RULES, VOCABULARY, Rule, RuleBook, Vocabulary, url_filter, url_words
from tests.llm.awkward import collected

FIELDS = "page_id long, url string, html string, host string, path string, rule string, verdict string, id long, scanned string, weight string"

URLS = [
    "http://Blog.Example.COM/en/1?x=casino#porn",
    "https://www.example.com/en/7",
    "https://www.example.com/EN/7",
    "http://example.com/en/",
    "http://badexample.com/en/",
    "http://example.com",
    "http://com/",
    "http://COM?x",
    "ftp://shop.example.net/es/a",
    "ftp://shop.example.net/fr",
    "http://net/fr/x#y",
    "http://casino.example.org/",
    "http://casinos-r-us.org/",
    "http://mycasino.org/en",
    "http://alphabets.org/freedom",
    "http://free-bets.org/",
    "http://free.org/free/FREE",
    "http://a.org/cheap%20pills",
    "http://a.org/%C3%A9casino%c3%a9",
    "http://a.org/ads/track?casino",
    "http://a.org/win/free/cheap",
    "http://a.org/win/free",
    "http://paris.org/sports/paris_sportifs/free",
    "http://user@host.org:80/casino",
    "http:///no-host/casino",
    "://x/y",
    "mailto:casino@x.org",
    "no scheme at all",
    "CASINO://x.org/",
    "http://Éxample.org/cafécasino",
    "http://a.org/line\nbreak\ncasino",
    "",
    None,
]


def plain(url):
    text = url or ""
    host = path = ""
    scanned = re.split("[?#]", text)[0]
    if "://" in text:
        rest = text.split("://", 1)[1]
        raw = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(raw) :])[0]
        host, scanned = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw), raw + path
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in scanned)
    low = re.sub("%[0-7][0-9a-f]", " ", re.sub("%[89a-f][0-9a-f]", "é", low))
    words = re.sub("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", " ", f" {low} ")
    met = [w for t, w in VOCABULARY.weights.items() if f" {t} " in words]
    verdict = rule.verdict if rule else "block" if sum(met) >= VOCABULARY.limit else "allow"
    return host, path, rule.name if rule else None, verdict, sum(w >= VOCABULARY.limit for w in met), sum(w < VOCABULARY.limit for w in met), sum(met)


COLUMNS = ("host", "path", "rule", "verdict", "n_strict", "n_soft", "weight")


def pages(spark, urls):
    rows = [(None if n == 3 else n, u, "<html>", "h", "p", "r", "v", 1, "s", "w") for n, u in enumerate(urls)]
    return spark.createDataFrame(rows, FIELDS)


def test_every_kind_of_url(spark):
    urls = [*URLS, *URLS[:5]]  # repeated rows too
    got = collected(url_filter(pages(spark, urls)))
    expected = [(None if n == 3 else n, *plain(u)) for n, u in enumerate(urls)]
    assert sorted(((r["page_id"], *(r[c] for c in COLUMNS)) for r in got), key=repr) == sorted(expected, key=repr)
    assert set(got[0]) == {"page_id", *COLUMNS}


@pytest.mark.parametrize(
    ("url", "verdict"),
    [
        ("http://casino.org/", "block"),  # strict
        ("http://mycasino.org/", "allow"),  # no boundary
        ("http://free-bets.org/", "block"),  # two soft ones
        ("http://bets.org/bets/bets", "allow"),  # one soft one, three times
        ("http://win.org/free", "allow"),  # two light ones
        ("http://casino.example.com/fr/", "allow"),  # a rule comes first
    ],
)
def test_verdicts(spark, url, verdict):
    assert [r["verdict"] for r in collected(url_filter(pages(spark, [url])))] == [verdict]


def test_long_url_and_empty_table(spark):
    long = "http://a.org/" + "free/" * 100_000 + "x.x" * 100_000 + "/casino"
    (row,) = collected(url_filter(pages(spark, [long])))
    assert (row["verdict"], row["n_strict"], row["n_soft"], row["weight"]) == ("block", 1, 1, 13)
    assert url_filter(pages(spark, [])).count() == 0
    dots = "http://" + "a." * 200_000 + "com/"
    assert [r["rule"] for r in collected(url_filter(pages(spark, [dots])))] == ["com/"]


def test_own_rules_and_words(spark):
    vocabulary = Vocabulary({"red": 2, "blue": 2, "red blue": 3, "stop": 4}, limit=4)
    rules = [Rule("block", "a.org", "/x"), Rule("allow", "org", "/x/y")]
    urls = ["http://b.org/red/blue", "http://b.org/red/red", "http://b.org/stop", "http://a.org/x/y", "http://a.org/x/z", "http://a.org/w"]
    got = {r["page_id"]: r for r in collected(url_filter(pages(spark, urls + ["http://c.net/"]).withColumnRenamed("page_id", "k"), rules, vocabulary, id_column="k").withColumnRenamed("k", "page_id"))}
    assert [got[i]["verdict"] for i in (0, 1, 2, 5, 6)] == ["block", "allow", "block", "allow", "allow"]
    assert got[0]["weight"] == 7  # overlapping terms all count
    assert got[4]["rule"] == "a.org/x"
    assert collected(url_filter(pages(spark, ["http://x.org/casino"]), (), Vocabulary({})))[0]["verdict"] == "allow"
    with pytest.raises(ValueError):
        Vocabulary({"Two  Words": 1})


def test_longest_rule_wins_and_the_longer_host_among_equals():
    book = RuleBook([Rule("a", "com", "/a/"), Rule("b", "a.com", "/"), Rule("c", "x.a.com", "/")])
    assert book.fitting("a.com", "/a/").host == "a.com"
    assert book.fitting("x.a.com", "/a/").host == "x.a.com"
    assert book.fitting("com", "/a/b").host == "com"
    assert book.fitting("acom", "/") is None and RuleBook([]).fitting("com", "/") is None


def test_words_of_a_url():
    assert url_words("Http://A-b_c.D%2Fe%C3%A9f") == "http a b c d e\x80\x80f"


def test_query_reads_two_columns(spark):
    found = op11_url_filter(spark, "/root/testdata/sf0.001")
    assert "html" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
