"""URL filter: against plain matching of every rule, and SQL."""

from caselens.llm import urlfilter
from caselens.llm.queries import ORACLE, QUERIES
from oracle_compare import differences, oracle_connection

URLS = [
    None, "", "no scheme", "://", "http://", "http://ORG/", "http://x.org", "http://x.org/",
    "http://Sub.Example.ORG/es/1?x", "http://example.org/es", "http://example.org/en/12",
    "http://example.org/en/2", "http://notexample.org/en/1", "http://a.com/fr/x#y",
    "http://a.com/de/", "http://com/de/", "http://a.com/DE/", "https://casino.example.net/a",
    "https://my-casino.net", "https://casinos.net/", "a://b://c.org/x", "http://u@x.org:80/a",
    "http://ads-track.x.net/?a", "http://x.net/casino", "http://x.org?a://b.com/de/", "x\ny://z.org/",
    "http://free-bets.x.com/fr/1", "http://spam.com/en/",
]


def plain(url, rules):
    head, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    return host, path


def verdict(host, path):
    best = ""
    for rule in urlfilter.SITES:
        site, slash, start = rule.name.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith(slash + start):
            best = max(best, rule.name, key=len)
    if best:
        return best, next(r.verdict for r in urlfilter.SITES if r.name == best)
    labels = [label.split("-") for label in host.split(".")]
    spam = {"casino", "bets", "pills", "viagra", "spam", "adult", "xxx", "porn"}
    bad = any(spam & set(label) or "ads-track" in "-".join(label) for label in labels)
    return None, "block" if bad else "allow"


def test_odd_urls(spark):
    rows = [(i % 20, u, None, "r") for i, u in enumerate(URLS * 2)] + [(None, "http://x.org/", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, token string")
    found = urlfilter.judge(pages, urlfilter.SITES + urlfilter.SPAM_HOSTS).collect()
    wanted = []
    for page_id, url, _, _ in rows:
        host, path = plain(url, urlfilter.SITES)
        wanted.append((page_id, host, path, *verdict(host, path)))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
    assert urlfilter.judge(pages.limit(0), urlfilter.SITES).collect() == []


def test_ties_rules_without_literals_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    same = [urlfilter.Rule("b", "a[.]net", "allow", ("net",), 5),
            urlfilter.Rule("a", "a[.]net", "block", ("net",), 5)]
    assert [r.rule for r in urlfilter.judge(pages, tuple(same)).orderBy("page_id").collect()] == ["a", None]
    every = urlfilter.Rule("all", ".*", "block", (), 1)
    assert {r.verdict for r in urlfilter.judge(pages, (every,)).collect()} == {"block"}
    assert {r.verdict for r in urlfilter.judge(pages, ()).collect()} == {"allow"}


def test_literals_are_whole_tokens():
    assert urlfilter.site_rule("example.org/en/1", "block").literals == ("example", "org", "en")
    assert urlfilter.site_rule("com/de/", "block").literals == ("com", "de")


def test_query_matches_sql(spark, data):
    name = "op2_url_filter"
    assert differences(QUERIES[name](spark, data), oracle_connection(data), ORACLE[name]) == ""
