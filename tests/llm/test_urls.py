import re

import pytest

from stillroom.llm.urls import Pattern, Prefix, judge, unfiled

PREFIXES = [Prefix("allow", "org"), Prefix("block", "example.org", "/es/"), Prefix("block", "example.org", "/en/1"), Prefix("allow", "com", "/fr/"), Prefix("block", "com", "/de/"), Prefix("block", "xn-ä.de", "/")]
PATTERNS = [Pattern(p) for p in (r"\bspam-farm\b", r"/wp-login\b", r"(casino|pills)", r"\bx[0-9]+y\b", r"/a/?b/", r"\b(bets|wins)\b", r"/(x|q)/(ab|cd)/")]

URLS = [
    None, "", "no scheme.example.org/es/1", "https://example.org/es/1", "HTTPS://WWW.Example.ORG/es/1", "https://badexample.org/es/1", "https://example.org/ES/1", "http://a.example.org/en/123?x#y",
    "http://example.org/en/2", "http://example.org", "http://example.org?/es/", "http://example.org#/es/", "http://org/x", "http://a.com/fr/x", "http://a.com/de/x", "http://a.com/es/x", "http://com/fr/x",
    "http://spam-farm.net/", "http://SPAM-FARM.net/", "http://spam-farms.net/", "http://x.net/wp-login.php", "http://x.net/xwp-login", "http://my.casinos.net", "http://q.net/x12y", "http://q.net/x12yz", "http://q.net/ab/",
    "http://spam-farm.com/fr/x", "a://b://c/d", "http://xn-ä.de/1", "http://h.net/p?u=http://other.org/z", "http://h.net/\nline", "http://all.bets.net", "http://all-wins.net/bets", "http://allbets.net", "http://h.net/q/cd/", "http://h.net/q/ce/", "://org/", "http:///path", "http://user@example.org:80/es/", "x" * 100_000,
]


def host_and_path(url):
    if url is None or "://" not in url:
        return "", ""
    host, rest = re.match(r"([^/?#]*)(.*)", url.split("://", 1)[1], re.S).groups()
    return host.translate({i: i + 32 for i in range(65, 91)}), re.match(r"[^?#]*", rest)[0]


def expected(url):
    host, path = host_and_path(url)
    fitting = [p for p in PREFIXES if (host == p.host or host.endswith("." + p.host)) and path.startswith(p.path)]
    small = (url or "").translate({i: i + 32 for i in range(65, 91)})
    patterns = sorted(p.regex for p in PATTERNS if url is not None and re.search(p.regex, small, re.A))
    best = max(fitting, key=lambda p: len(p.name), default=None)
    return host, path, best and best.name, best.verdict if best else "block" if patterns else "allow", patterns


def test_against_every_rule_on_every_url(spark):
    rows = [(i, u, "x", 1) for i, u in enumerate(URLS)] + [(None, u, "x", 1) for u in URLS[:5]] + [(3, URLS[3], "x", 1)] * 2
    found = judge(spark.createDataFrame(rows, "page_id long, url string, token string, rule_id int"), PREFIXES, PATTERNS).collect()
    assert sorted(((r["page_id"], *tuple(r)[1:]) for r in found), key=str) == sorted(((i, *expected(u)) for i, u, *_ in rows), key=str)


@pytest.mark.parametrize(("regex", "tokens"), [(r"\bspam-farm\b", {"spam", "farm"}), (r"(a|b)", set()), (r"\bx[0-9]+y\b", set()), (r"/a/?b/", set()), (r"\.good\.", {"good"}), (r"good", set()), (r"/part?/", set())])
def test_literal_tokens(regex, tokens):
    assert Pattern(regex).tokens() == tokens


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert [tuple(r) for r in judge(pages, [], []).collect()] == [(1, "a.org", "/x", None, "allow", [])]
    assert judge(pages.filter("false"), PREFIXES, PATTERNS).count() == 0


def test_groups_of_words_are_filed_apart():
    assert [p.regex for p in Pattern(r"\b(a|b-c)\b/(x|y)\b").alternatives()] == [r"\ba\b/x\b", r"\ba\b/y\b", r"\bb-c\b/x\b", r"\bb-c\b/y\b"]
    assert [p.regex for p in Pattern(r"\b(a|b)?\b").alternatives()] == [r"\b(a|b)?\b"]
    assert unfiled([Pattern(r"\b(a|b)\b"), Prefix("allow", "org"), Pattern(r"\(a|b\)")]) == [r"\(a|b\)"] and unfiled([Pattern("x|y")]) == ["x|y"]


ODD_URLS = [
    "http://my.casinos.net/x", "http://casino-royal.net", "http://xcasino.net", "http://h.net/casinos", "https://a.b.PILLSHOP.net:80/", "http://h.net/?u=http://pillsx.net", "://pills", "http://bets.net", "http://h.net/wp-login.php",
    "http://h.net/x/wp-login", "http://h.net/wp-logins", "http://h.net/calendar/2024/01/02/x", "http://h.net/calendar/2024/1/02", "http://h.net/xcalendar/2024/01/02", "http://cheap-pills.com", "http://h.net/my-cheap-pills-x",
    "http://casinos.example.org/fr/x", "http://h.net/ads-x.track", "http://ébets.net", "http://éspam-farmé.net/", "http://h.net/_bets_", None, "casinos", "wp-login", "http://h.net", "http://h.net/paq-pbq/", "http://goodx.net",
]


def test_registered_patterns_on_odd_urls_against_sql(spark, tmp_path):
    """Words that only begin a host's label, and the patterns of login pages and calendars, are judged as well."""
    import duckdb

    from oracle import compare
    from stillroom.llm.queries import SQL, op9_url_rules

    rows = [(i, u, "") for i, u in enumerate(ODD_URLS)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    found = op9_url_rules(spark, str(tmp_path))
    assert compare(found, con, SQL["op9_url_rules"]) == ""
    blocked = {r["page_id"] for r in found.collect() if r["verdict"] == "block"}
    assert [ODD_URLS[i] for i in sorted(blocked)] == [ODD_URLS[i] for i in (0, 1, 4, 5, 6, 7, 8, 9, 11, 14, 15, 17, 18, 19)]


def test_beginnings_and_parts_that_may_be_left_out(spark):
    from stillroom.llm.queries import URL_PATTERNS

    first = Pattern(URL_PATTERNS[0])
    assert [p.regex for p in first.alternatives()] == [rf"://{x}{w}[^/?#]*" for x in ("", r"[^/?#]*\.") for w in ("casino", "pills")]
    assert [p.keys() for p in first.alternatives()] == [{"casino*"}, {"pills*"}] * 2 and unfiled([first]) == []
    odd = [Pattern(p) for p in (*URL_PATTERNS, r"/(p(a|b)q-?)+/", r"\bgood\.?x", r"/(a|b)\1/", r"\bcalen[a-z]+\b")]
    rows = [(i, u) for i, u in enumerate([*ODD_URLS, "http://h.net/aa/", "http://h.net/ab/"])]
    found = judge(spark.createDataFrame(rows, "page_id long, url string"), [], odd).collect()
    blocked = {i: sorted(p.regex for p in odd if u is not None and re.search(p.regex, u.translate({i: i + 32 for i in range(65, 91)}), re.A)) for i, u in rows}
    assert {r["page_id"]: r["blocked_by"] for r in found} == blocked
