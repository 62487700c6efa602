import re

import pytest
from pyspark.sql import functions as F

from icuflow.llm import queries, urls


def brute_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for kind, h, p in urls.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[1])):
            best = (kind, h + p)
    return host, path, best[1] if best else None, best[0] if best else None


CASES = [None, "", "no scheme", "http://", "HTTP://Example.ORG/es/1", "http://example.org/en/12?x=/es/", "http://a.example.org/en/2", "ftp://x.com/fr/#q",
         "http://com/de/", "http://notcom/fr/", "http://x.com:80/fr/", "http://x.com?u=http://y.org/", "http://É.org/", "http://x.org", "http://x.net/a\nb/c", "a://b://c.org/d"]


def test_host_path_and_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(CASES)], "page_id long, url string")
    got = {r["page_id"]: r for r in urls.digest(df).collect()}
    for i, u in enumerate(CASES):
        host, path, rule, kind = brute_rule(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] in ("allow", "block") and (kind is None or got[i]["verdict"] == kind)


def brute_score(train, text):
    import math
    from collections import Counter, defaultdict
    grams = {"a": Counter(), "b": Counter()}
    for t, x, n in train:
        s = "\x02" * urls.ORDER + t + "\x03"
        for i in range(len(t) + 1):
            w = s[i:i + urls.ORDER + 1]
            for k in range(urls.ORDER + 1):
                grams[x][w[urls.ORDER - k:]] += n
    total = 0.0
    s = "\x02" * urls.ORDER + text + "\x03"
    followers = {x: defaultdict(Counter) for x in "ab"}
    for x in "ab":
        for g, n in grams[x].items():
            followers[x][(len(g), g[:-1])][g[-1]] += n
    for i in range(len(text) + 1):
        w = s[i:i + urls.ORDER + 1]
        for x, sign in (("a", 1), ("b", -1)):
            p = 1 / 256
            for k in range(urls.ORDER + 1):
                g = w[urls.ORDER - k:]
                f = followers[x].get((len(g), g[:-1]))
                if f:
                    n, kinds = sum(f.values()), len(f)
                    p = (f.get(g[-1], 0) + kinds * p) / (n + kinds)
            total += sign * math.log(p)
    return total / (len(text) + 1)


def test_scores_match_a_plain_model(spark):
    pages = spark.createDataFrame([(i, f"http://{h}.example.{t}/{lang}/{i}") for i, (h, t, lang) in
                                   enumerate([(h, t, g) for h in ("ab", "bc", "cabb") for t in ("org", "com", "net") for g in ("es", "en", "fr", "de")] * 2)], "page_id long, url string")
    got = urls.judge(pages).select(F.concat("host", "path").alias("t"), "score").collect()
    held = {r[0]: r[1] for r in pages.select(F.regexp_replace("url", "http://", "").alias("t")).select("t", F.pmod(F.xxhash64("t"), F.lit(urls.CALIBRATE)) == 0).collect()}
    train = []
    for t in held:
        kind = brute_rule("http://" + t)[3]
        if kind and not held[t]:
            train.append((t, "a" if kind == "allow" else "b", 1))
    for r in got[:20]:
        assert abs(brute_score(train, r["t"]) - r["score"]) < 1e-6


def test_model_separates_what_it_learnt(spark):
    rows = [(i, f"http://good{i % 50}.org/") for i in range(200)] + [(1000 + i, f"http://spam{i % 50}.com/de/") for i in range(200)]
    rows += [(5000, "http://good7.net/"), (5001, "http://spam7.net/de/")]
    got = {r["page_id"]: r["verdict"] for r in urls.digest(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[5000] == "allow" and got[5001] == "block"


def test_the_model_reads_query_fragment_and_texts_without_scheme(spark):
    rows = [(i, f"http://h{i % 50}.org/?q=fine") for i in range(200)] + [(1000 + i, f"http://h{i % 50}.com/de/?q=spam#x") for i in range(200)]
    rows += [(5000, "http://h.net/?q=fine"), (5001, "http://h.net/?q=spam#x"), (5002, "h.org/?q=fine"), (5003, "h.com/de/?q=spam#x"), (5004, None), (5005, "http://H.net/?q=fine")]
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).where("page_id >= 5000").collect()}
    assert [got[k]["verdict"] for k in range(5000, 5004)] == ["allow", "block", "allow", "block"]
    assert got[5000]["score"] == got[5005]["score"] and got[5004]["score"] is not None
    assert all((got[k]["host"], got[k]["path"]) == ("", "") for k in (5002, 5003, 5004))


def test_empty_and_repeated_and_extra_columns(spark):
    assert urls.digest(spark.createDataFrame([], "page_id long, url string")).collect() == []
    df = spark.createDataFrame([(1, "http://x.net/", "a"), (1, "http://x.net/", "a"), (None, None, "b")], "page_id long, url string, host string")
    assert urls.digest(df).count() == 3


def test_query_on_the_driver_table(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    rows = queries.op7_url_filter(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path, rule, kind = brute_rule(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and (kind is None or kind == r["verdict"])


def test_a_very_long_url_is_judged_whole(spark):
    rows = [(i, f"http://h{i % 50}.org/fine/fine") for i in range(200)] + [(1000 + i, f"http://h{i % 50}.com/de/spam/spam") for i in range(200)]
    rows += [(5000, "http://h.net/" + "x" * 1000 + "fine/" * 20_000), (5001, "http://h.net/" + "x" * 1000 + "spam/" * 20_000)]
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).where("page_id >= 5000").collect()}
    assert got[5000]["verdict"] == "allow" and got[5001]["verdict"] == "block" and len(got[5000]["path"]) == 101_001
