import math
from collections import Counter, defaultdict

import pandas as pd
import pytest

from pointframe.llm import queries as Q
from pointframe.llm import url_filter as U


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:end], rest[end:]
    cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:cut]


def slow_rule(host, path):
    fits = [(len(h + p), v, h + p) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_query_parts_and_rules(spark, sf):
    pages = pd.read_parquet(f"{sf}/pages.parquet").set_index("page_id")
    got = Q.op7_url_filter(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.host, r.path) == slow_parts(pages.url[r.page_id])
        verdict, rule = slow_rule(r.host, r.path)
        assert r.rule == rule and r.verdict in ("allow", "block") and (rule is None or r.verdict == verdict)


def slow_ratio(train, url, order):
    """Interpolated Witten-Bell probabilities, straight from their definition."""
    total = 0.0
    norm = lambda u: "^" * order + u.lower() + "$"
    for sign, own in ((1, [u for u, a in train if a]), (-1, [u for u, a in train if not a])):
        counts = defaultdict(Counter)
        for u in own:
            s = norm(u)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    counts[s[i - k : i]][s[i]] += 1
        s = norm(url)
        for i in range(order, len(s)):
            p = 1 / U._ALPHABET
            for k in range(order + 1):
                c = counts.get(s[i - k : i])
                if c:
                    p = (c[s[i]] + len(c) * p) / (sum(c.values()) + len(c))
            total += sign * math.log(p)
    return total / (len(url) + 1)


def test_ratio_equals_definition(spark):
    train = [("http://good.example/abc", True), ("http://good.example/abd?x=17", True), ("http://bad.test/spam", False), ("http://bad.test/spam/spam#a", False), ("x", False)]
    asked = ["http://good.example/new", "http://bad.test/spam", "", "ftp://zzz/ÄÖ", "HTTP://GOOD.example/9"]
    for order in (0, 2, 4):
        model = U.train(spark.createDataFrame(train, "url string, allow boolean"), order)
        got = {r.url: r.score for r in U.ratio(spark.createDataFrame([(u,) for u in asked], "url string"), model, order).collect()}
        for u in asked:
            assert got[u] == pytest.approx(slow_ratio(train, u, order), abs=1e-9)


def test_rare_grams_count_as_unseen(spark):
    urls = spark.createDataFrame([(f"http://a.example/{i}", i % 2 == 0) for i in range(400)], "url string, allow boolean")
    sizes = [U.train(urls, 3, m).count() for m in (10**6, 500, 20)]
    assert sizes[0] > sizes[1] > sizes[2] and sizes[2] <= 2 * 2 * 4 * 20


def test_held_out_agreement(spark):
    """URLs that rules decide, judged by models that never saw them: most verdicts agree."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    host, path = U.host_and_path("url")
    d = pages.select("url").distinct().withColumn("host", host).withColumn("path", path)
    _, verdict = U.matching_rule("host", "path", U.RULES)
    d = d.withColumn("verdict", verdict).where("verdict is not null").selectExpr("url", "verdict = 'allow' as allow", "pmod(xxhash64(url), 5) as part").cache()
    model = U.train(d.where("part > 1").select("url", "allow"), 6)
    scored = U.ratio(d.where("part = 0").select("url"), model, 6).join(d, "url").toPandas()
    edge = U.calibrate(U.ratio(d.where("part = 1").select("url"), model, 6).join(d, "url").select("score", "allow"))
    assert ((scored.score >= edge) == scored.allow).mean() > 0.82


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://COM/en/x"), (5, "a://b://www.Example.com/en/7?x"), (6, "http://xcom/en/"), (None, "http://a.net/de/1#/de/"), (6, "http://xcom/en/")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' as host", "'p' as path", "'v' as verdict", "1 as score")
    got = {(r.page_id, r.host, r.path, r.rule) for r in U.filter_urls(df).collect()}
    assert got == {(1, "", "", None), (2, "", "", None), (3, "", "", None), (4, "com", "/en/x", "com/en/"), (5, "b:", "//www.Example.com/en/7", None), (6, "xcom", "/en/", None), (None, "a.net", "/de/1", "net/de/")}
    assert U.filter_urls(df).count() == 8
    one_kind = U.filter_urls(df.where("page_id = 4 or page_id = 6")).collect()
    assert {r.verdict for r in one_kind if r.rule is None} == {"allow"}
    assert U.filter_urls(df.limit(0)).count() == 0


def test_rare_grams_of_large_inputs_bear_on_scores(spark, monkeypatch):
    train = [(f"http://{'good' if i % 2 else 'bad'}{i * 7919 % 5003}.example/p{i * i % 9973}", i % 2 == 1) for i in range(3000)]  # beyond 30,000 characters a class
    train.append(("http://zyxw.test/rare", False))
    asked = ["http://zyxw.test/rarer", "http://good12.example/p3", "", "http://bad77.example/zyxw"]
    model = U.train(spark.createDataFrame(train, "url string, allow boolean"), 3)
    for share in (10**6, 5):  # nearly all keys are hot; nearly none
        monkeypatch.setattr(U, "_HOT", share)
        got = {r.url: r.score for r in U.ratio(spark.createDataFrame([(u,) for u in asked], "url string"), model, 3).collect()}
        for u in asked:
            assert got[u] == pytest.approx(slow_ratio(train, u, 3), abs=1e-9)
