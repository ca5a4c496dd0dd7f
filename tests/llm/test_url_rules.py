"""URL rules against a plain loop over all rules."""

import random
from collections import Counter

import pytest
from episodica.llm import url_rules

SHAPE = "page_id long, url string, host string, row string, key string, verdict string, part int"


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    best = None
    for h, p, verdict in rules:
        h = (h or "").lower()
        p = p or ""
        if h and (not p or p.startswith("/")) and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h) + len(p), len(h), verdict, h + p))
    return host, path, best and best[3], best[2] if best else default


def odd_urls():
    draw = random.Random(3)
    hosts = ["net", "a.net", "b.a.net", "xa.net", "NET", "org", "www.org", "net:80", "", "a..net", "é.org", "a.b.c.d.e.f.net"]
    paths = ["", "/", "/en/", "/en", "/en/x", "/en/x/y?q=/de/", "/de/#://", "?a://b", "#/en/", "/En/", "/\U0010ffff/", "/en/\n"]
    urls = [f"http://{draw.choice(hosts)}{draw.choice(paths)}" for _ in range(400)]
    return urls + [None, "", "net/", "://net/", "http://net/" + "x" * 200_000, "http://" + "a." * 3000 + "net/en/", *["http://b.a.net/en/x"] * 300]


RULES = [
    ("net", "/", "block"), ("net", "/", "allow"), ("A.net", "/en/", "allow"), ("a.net", "", "block"), ("b.a.net", "/en/x", "block"), ("b.a.net", "/en/x", "block"),
    ("org", "/en", "block"), ("www.org", "/", "allow"), ("org", "/\U0010ffff", "block"), ("", "/", "block"), (None, "/", "block"), ("net", "en/", "block"), ("e.f.net", None, "block"),
]


@pytest.mark.parametrize("seed", range(2))
def test_equals_a_loop_over_all_rules(spark, tmp_path, seed):
    draw = random.Random(seed)
    rules = RULES if not seed else [(".".join(draw.choice("ab") for _ in range(draw.randint(1, 4))), "/" + "".join(draw.choice("xy/") for _ in range(draw.randint(0, 5))), draw.choice(["allow", "block"])) for _ in range(300)]
    urls = odd_urls() if not seed else ["h://" + ".".join(draw.choice("ab") for _ in range(draw.randint(1, 5))) + "/" + "".join(draw.choice("xy/") for _ in range(draw.randint(0, 7))) for _ in range(1500)]
    spark.createDataFrame([(i, u, "h", "r", "k", "v", 1) for i, u in enumerate(urls)], SHAPE).repartition(3).write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    found = url_rules.judged(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert Counter((r["row"]["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()) == Counter((i, *plain(u, rules)) for i, u in enumerate(urls))


def test_no_rules_no_pages_and_kept_rows(spark, tmp_path):
    spark.createDataFrame([(1, "http://a.net/", "h", "r", "k", "v", 1)] * 2 + [(2, "http://a.org/", "h", "r", "k", "v", 1)], SHAPE).write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert {r["verdict"] for r in url_rules.judged(pages, rules.limit(0), default="other").collect()} == {"other"}
    assert url_rules.judged(pages.limit(0), rules).collect() == []
    assert [r["page_id"] for r in url_rules.allowed(pages, rules).collect()] == [2]
    assert url_rules.allowed(pages, rules).columns == pages.columns


def test_ranges_split_a_hot_url(spark):
    keys = spark.range(4000).selectExpr("'net.a./' AS key", "id AS salt")
    bounds = url_rules.range_bounds(keys, 8)
    assert len(bounds) == 7 and {head for head, _ in bounds} == {"net.a./"}
