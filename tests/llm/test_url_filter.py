import pytest

from demandloom.llm import url_filter
from demandloom.llm.queries import URL_RULES

RULES = "host string, path string, verdict string"


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


URLS = [
    None, "", "no scheme", "http://", "http://NET", "http://a.net/", "https://x.Example.NET/en/1?q#f",
    "http://example.net/en", "http://notexample.net/en/1", "http://example.com/de/", "http://de.example.com/de/x",
    "ftp://org/fr/", "http://a.b.org/fr/ü", "http://x.org?/fr/", "http://x.org#/fr/", "http://net./", "://net/x",
    "http://a..net/", "http://-net/", "http://net-a.net/x", "http://" + "a." * 60 + "net/" + "p" * 5000,
]


@pytest.mark.parametrize("blocks", [None, 7])
def test_same_as_trying_every_rule(spark, rows, blocks):
    rules = [*URL_RULES, ("www.example.net", "/en/a/", "block"), ("example.net", "/", "allow"),
             ("net", "/en/abc/def/gh", "allow"), ("a.b.org", "/fr/", "block"), ("org", "", "block")]
    urls = URLS + [f"http://{h}{p}" for h in ("www.example.net", "a.www.example.net", "b.org", "a.b.org", "net", "0.net")
                   for p in ("", "/", "/en/", "/en/a/b", "/en/abc/def/ghi", "/fr/x", "/de/")]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    made = url_filter.judge(pages, spark.createDataFrame(rules, RULES), blocks=blocks)
    assert rows(made, "page_id", "host", "path", "rule", "verdict") == sorted(
        ((i, *brute(u, rules)) for i, u in enumerate(urls)), key=repr)


def test_repeated_rows_rules_and_clashing_columns(spark, rows):
    pages = spark.createDataFrame(
        [(1, "http://a.net/", "x", "y")] * 3 + [(None, "http://b.de/", "x", "y")],
        "page_id long, url string, host string, key string")
    rules = [("NET", "/", "allow"), ("net", "/", "block"), ("net", "/", "allow"), (None, "/", "block"),
             ("de", None, "block"), ("", "/", "block")]
    made = url_filter.judge(pages, spark.createDataFrame(rules, RULES))
    assert rows(made, "page_id", "key", "host", "rule", "verdict") == sorted(
        [(1, "y", "a.net", "net/", "block")] * 3 + [(None, "y", "b.de", "de", "block")], key=repr)


def test_empty_tables(spark):
    rules = spark.createDataFrame(URL_RULES, RULES)
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert url_filter.judge(pages.limit(0), rules).collect() == []
    assert url_filter.judge(pages, rules.limit(0)).select("rule", "verdict").collect() == [(None, "allow")]
