from __future__ import annotations

import re

from snapmart.llm import url_filter as U
from tests.llm.spark_fixture import with_clashing_columns


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name)) if fits else None


URLS = [None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.ORG/es/", "http://a.example.org/es/x?q=1", "http://example.org", "http://org/", "http://borg/", "http://x.com/fr/a#b", "http://x.com/fr", "http://x.com?/fr/", "http://É.com/de/", "a://b://c/d", "http://example.org/en/12", "http://example.org/en/2", "http://xexample.org/en/1", "http://x.net/a\nb/c", "http://cheap-pills.example.net/en/4", "https://tionsh.example.net/en/4", "http://" + "a" * 50_000 + ".net/" + "b" * 50_000]


def test_rules_and_parts_against_brute_force(spark):
    rows = list(enumerate(URLS)) + [(None, "http://x.com/de/"), (3, URLS[5]), (3, URLS[5])]
    df = with_clashing_columns(spark.createDataFrame(rows, "page_id bigint, url string"))
    got = U.judge_urls(df, "page_id").collect()
    want = [(i, *brute(u)) for i, u in rows]
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in got) == sorted((str(i), h, p, str(r.name if r else None)) for i, h, p, r in want)
    for r in got:
        assert r.rule is None or r.verdict == {u.name: u.verdict for u in U.RULES}[r.rule]
        assert (r.chance is None) == (r.rule is not None) and r.verdict in ("allow", "block")
    verdict = {r.page_id: r.verdict for r in got}
    assert verdict[0] == verdict[1] == "allow" and verdict[19] == "block" and verdict[20] == "allow"
    assert U.judge_urls(df.limit(0), "page_id").collect() == []


def test_held_out_accuracy(spark, sf_check):
    """Trained on half of the hosts' URLs, tested on URLs never seen."""
    pages = spark.read.parquet(f"{sf_check}/pages.parquet")
    train, test = pages.filter("page_id % 2 = 0"), pages.filter("page_id % 2 = 1")
    weights = U.train(train)
    host, path = U.host_and_path(test.url)
    rows = test.select(host.alias("host"), path.alias("path")).withColumn("label", U.weak_label()).collect()
    right = [(U.chance(weights, r.host, r.path) >= U.BLOCK_AT) == bool(r.label) for r in rows]
    assert sum(right) >= 0.95 * len(right)


def test_new_spellings_are_judged():
    weights = U.fit([(h.split("://")[1].split("/")[0], "/", m) for h, m in U.SEEDS])
    assert U.chance(weights, "best-casino-wins.example.net", "/") > 0.5
    assert U.chance(weights, "cheap-pillz.example.org", "/") > 0.5
    assert U.chance(weights, "news.example.org", "/") < 0.5
