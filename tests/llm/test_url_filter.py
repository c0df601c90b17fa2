from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import queries, url_filter

RULES = [("com", "/", "allow"), ("a.com", "/x", "block"), ("www.a.com", "/x", "allow"), ("net", "", "block")]


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host):]).group()


def brute_key(url):
    host, path = brute_parts(url)
    host = re.sub(r"(:(80|443)?)?$", "", re.sub(r"^[^@]*@", "", host), count=1)
    host = re.sub(r"^www\.", "", host)
    path = re.sub(r"/$", "", re.sub("/+", "/", path))
    asked = re.match(r"[^?#]*\?([^#]*)", url.split("://", 1)[1]) if "://" in (url or "") else None
    kept = sorted(x for x in (asked.group(1).split("&") if asked else []) if x and not re.match(r"(utm_[a-z]+|gclid|fbclid)=", x))
    return host and host + path + ("?" + "&".join(kept) if kept else "")


def brute(urls, listed):
    keys = {brute_key(u) for u in listed} - {""}
    out = []
    for u in urls:
        host, path = brute_parts(u)
        fit = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
        verdict = best[2] if best else "block" if brute_key(u) in keys else "allow"
        out.append((host, path, best and best[0] + best[1], verdict))
    return out


def some_urls(rng, n):
    hosts = ["a.com", "WWW.A.com", "b.org", "www.b.org:80", "u@b.org", "c.b.org", "net", "x.net", "xnet", "ü.org", ""]
    paths = ["", "/", "/x", "/x/", "//x//y/", "/X", "x", "/é/"]
    ends = ["", "?", "?b=1&a=2", "?a=2&b=1&utm_source=q", "#top", "?a#b?c", "/?q=://", "#://"]
    return [rng.choice(["http://", "https://", "x://", ""]) + rng.choice(hosts) + rng.choice(paths) + rng.choice(ends) for _ in range(n)]


@pytest.mark.parametrize("blocks", [url_filter.MAX_BLOCKS, 1])
def test_equals_brute_force_with_a_full_filter_too(spark, monkeypatch, blocks):
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", blocks)
    rng = random.Random(3)
    urls = [*some_urls(rng, 600), None, "", "://", "no scheme", "http://b.org/" + "y" * 200_000]
    listed = [*some_urls(rng, 60), None, "", *[f"http://z{i}.org/" for i in range(500)]]
    pages = spark.createDataFrame([(i, u, "c", "d", "e") for i, u in enumerate(urls)], "page_id int, url string, HOST string, cm_key string, rule string")
    found = url_filter.judge(pages, spark.createDataFrame([(u,) for u in listed], "url string"), RULES).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found} == dict(enumerate(brute(urls, listed)))
    assert len(found) == len(urls) and all(r["cm_key"] == "d" for r in found)


def test_repeated_rows_of_a_hot_url_all_stay(spark):
    pages = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "http://h.org/").otherwise(F.concat(F.lit("http://h.org/"), "id")).alias("url"))
    listed = pages.where("id = 0").unionByName(pages.where("id = 7"))
    found = url_filter.judge(pages, listed).groupBy("verdict").count().collect()
    assert {r["verdict"]: r["count"] for r in found} == {"block": 1001, "allow": 1999}


def test_empty_tables(spark):
    pages = spark.createDataFrame([("http://a.org",)], "url string")
    empty = pages.where("url is null")
    assert [r["verdict"] for r in url_filter.judge(pages, empty).collect()] == ["allow"]
    assert url_filter.judge(empty, pages, RULES).count() == 0


def test_many_rules_are_refused(spark):
    pages = spark.createDataFrame([("http://a.org",)], "url string")
    with pytest.raises(ValueError):
        url_filter.judge(pages, pages, [("a", str(i), "allow") for i in range(url_filter.MAX_RULES + 1)])


def test_query_has_its_columns_and_no_python_in_its_plan(spark):
    found = queries.op12_url_filter(spark, "/root/testdata/sf0.001")
    assert set(found.columns) == {"page_id", "host", "path", "rule", "verdict"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
