"""URL filter: rules for what they cover, a character language-model ratio for the rest.

A URL's host is what lies between the first ``://`` and the next ``/``, ``?``,
``#`` or the end, with A-Z lower-cased; its path goes on to ``?``, ``#`` or the
end.  A rule (host, path prefix) covers its host and all subdomains; the longest
covering rule decides.

The URLs that rules accept and those they reject each train a variable-order
Markov model of the characters of the whole URL after its scheme (host with A-Z
lower-cased, then path, query and fragment as written; all of a URL without
``://``; a null URL is empty): contexts of 0 to ``ORDER`` characters, each order
smoothed by the next shorter one (Witten-Bell).  All their n-grams are counted,
as Spark aggregations; no table of counts leaves the executors.  Every distinct
window of ``ORDER`` + 1 characters gets its log ratio once, and a URL's score is
the sum over its windows divided by its length.  One rule-decided URL in
``CALIBRATE`` is kept out of the counts; on these a logistic curve is fitted to a
histogram of scores, and URLs with a probability of 0.5 or more are accepted.

Defined cases: a null URL or one without ``://`` has an empty host and path, and
is judged by the model; without training URLs of both kinds
(or calibration URLs of both) the model accepts a score of 0 or more; repeated
URLs are scored once and count as often as they occur; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import stage

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ORDER = 4
CALIBRATE = 5
BINS = 200
# Contexts of fewer characters than SALTED are joined in SALTS copies.
SALTED, SALTS = 2, 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def model_text(url: Column) -> Column:
    """What the model reads: the URL after its scheme, the host lower-cased; without ``://`` all of it."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return F.when(at > 0, F.concat(F.translate(host, _UPPER, _LOWER), F.substr(rest, F.char_length(host) + 1))).otherwise(url)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest covering rule, as host followed by path, and its verdict; null if none covers."""
    name = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later cases are longer, and win
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _windows(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and a row for each window of ``text``: ORDER characters before each character and the end,
    and that character.  The characters are an array, so that a window costs the same wherever it lies."""
    padded = F.concat(F.lit("\x02" * ORDER), F.col("text"), F.lit("\x03"))
    chars = df.select(*keep, F.split(padded, "").alias("_chars"))
    at = lambda i: F.concat(*[F.get("_chars", i + j) for j in range(ORDER + 1)])
    return chars.select(*keep, F.explode(F.transform(F.sequence(F.lit(0), F.size("_chars") - ORDER - 1), at)).alias("window"))


def _log_ratios(train: DataFrame, wanted: DataFrame) -> DataFrame:
    """(window, ratio) for the wanted windows, from the counts (window, a, b) of accepted and rejected URLs."""
    orders = F.sequence(F.lit(0), F.lit(ORDER))
    ends = lambda k: F.substr(F.col("window"), ORDER + 1 - k, k + 1)
    grams = (train.select(F.explode(F.transform(orders, lambda k: F.struct(k.alias("k"), ends(k).alias("gram")))).alias("g"), "a", "b")
             .groupBy("g.k", "g.gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    contexts = (grams.groupBy("k", F.substr("gram", F.lit(1), F.col("k")).alias("ctx"))
                .agg(F.sum("a").alias("na"), F.sum("b").alias("nb"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("b") > 0).alias("tb")))
    asked = wanted.select("window", F.explode(F.transform(orders, lambda k: F.struct(k.alias("k"), ends(k).alias("gram")))).alias("g"))
    asked = asked.select("window", F.col("g.k").alias("wk"), F.col("g.gram").alias("wgram"), F.substr("g.gram", F.lit(1), F.col("g.k")).alias("wctx"))
    # The few contexts of the short orders meet nearly every window: each is sent in SALTS copies, dealt by the window.
    salts = lambda k: F.when(F.col(k) < SALTED, SALTS).otherwise(1)
    contexts = contexts.withColumn("salt", F.explode(F.sequence(F.lit(0), salts("k") - 1)))
    asked = asked.withColumn("wsalt", F.pmod(F.xxhash64("window"), salts("wk")).cast("int"))
    rows = (asked.join(grams, (F.col("wk") == F.col("k")) & (F.col("wgram") == F.col("gram")), "left").drop("k", "gram")
            .join(contexts, (F.col("wk") == F.col("k")) & (F.col("wctx") == F.col("ctx")) & (F.col("wsalt") == F.col("salt")), "left"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c)
    path = F.array_sort(F.collect_list(F.struct(F.col("wk").alias("k"), *[zero(c) for c in ("a", "b", "na", "nb", "ta", "tb")])))

    def chance(x: str) -> Column:
        # Each order mixes its count with the shorter order's probability; below them all is a uniform one.
        return F.aggregate("path", F.lit(1 / 256).cast("double"), lambda p, r: F.when(r["n" + x] == 0, p).otherwise(
            (r[x] + r["t" + x] * p) / (r["n" + x] + r["t" + x])))

    return (rows.groupBy("window").agg(path.alias("path"))
            .select("window", (F.log(chance("a")) - F.log(chance("b"))).alias("ratio")))


def _logistic(bins: list[tuple[float, float, float]], steps: int = 50) -> tuple[float, float]:
    """Slope and intercept from (score, accepted, rejected); both kinds weigh the same."""
    a, b = sum(x[1] for x in bins), sum(x[2] for x in bins)
    if not a or not b:
        return 1.0, 0.0
    spread = max(abs(x[0]) for x in bins) or 1.0
    w, c = 1.0, 0.0
    for _ in range(steps):  # Newton's method with a small penalty on the slope
        g = [1e-3 * w, 0.0]
        h = [1e-3, 0.0, 1e-9]
        for s, na, nb in bins:
            s, na, nb = s / spread, na / a, nb / b
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, w * s + c))))
            d, v = p * (na + nb) - na, p * (1 - p) * (na + nb)
            g = [g[0] + d * s, g[1] + d]
            h = [h[0] + v * s * s, h[1] + v * s, h[2] + v]
        det = h[0] * h[2] - h[1] * h[1]
        if det <= 1e-15:
            break
        w, c = w - (h[2] * g[0] - h[1] * g[1]) / det, c - (h[0] * g[1] - h[1] * g[0]) / det
        w, c = max(-200.0, min(200.0, w)), max(-200.0, min(200.0, c))
    return w / spread, c


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per page: host, path, covering rule, score, probability of acceptance and verdict."""
    host, path = host_path(F.col("url"))
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path, "text": model_text(F.col("url"))}).drop("url")
    rule, kind = rule_of(F.col("host"), F.col("path"), rules)
    p = p.withColumns({"rule": rule, "kind": kind})
    urls = stage(p.groupBy("text", "kind").agg(F.count("*").alias("times"))
                 .withColumn("held", F.pmod(F.xxhash64("text"), F.lit(CALIBRATE)) == 0), "urls")
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Many tasks, though the texts are few bytes: each becomes a row per character.
    counted = (_windows(urls.where(F.col("kind").isNotNull() & ~F.col("held")).repartition(parts, "text"), "kind", "times")
               .groupBy("window").agg(F.sum(F.when(F.col("kind") == "allow", F.col("times")).otherwise(0)).alias("a"),
                                      F.sum(F.when(F.col("kind") == "block", F.col("times")).otherwise(0)).alias("b")))
    texts = urls.select("text").repartition(parts, "text").distinct()
    rows = _windows(texts, "text").groupBy("text", "window").agg(F.count("*").alias("n"))
    ratios = stage(_log_ratios(counted, rows.select("window").distinct()), "url-ratios")
    both = rows.join(ratios.withColumnRenamed("window", "w"), F.col("window") == F.col("w"))
    score = (both.groupBy("text").agg((F.sum(F.col("n") * F.col("ratio")) / F.sum("n")).alias("raw")))
    # Rounded, so that the order of a sum cannot turn a verdict.
    scores = stage(score.select("text", F.round("raw", 9).alias("score")), "url-scores")
    known = (urls.where(F.col("kind").isNotNull() & F.col("held")).select("text", "kind", "times")
             .join(scores.withColumnRenamed("text", "t"), F.col("text") == F.col("t")))
    low, high = known.agg(F.min("score"), F.max("score")).first()
    slope, intercept = 1.0, 0.0
    if low is not None and high > low:
        bins = (known.groupBy(F.floor((F.col("score") - low) / (high - low) * (BINS - 1)).alias("bin"))
                .agg(F.sum(F.when(F.col("kind") == "allow", F.col("times")).otherwise(0)).alias("a"),
                     F.sum(F.when(F.col("kind") == "block", F.col("times")).otherwise(0)).alias("b")).collect())  # at most BINS rows
        slope, intercept = _logistic([(low + r["bin"] * (high - low) / (BINS - 1), float(r["a"]), float(r["b"])) for r in sorted(bins)])
    out = p.join(scores.withColumnRenamed("text", "t"), F.col("text") == F.col("t"), "left")
    chance = F.round(1 / (1 + F.exp(-(F.col("score") * slope + intercept))), 9)
    return (out.withColumn("probability", F.coalesce(chance, F.lit(1.0)))
            .withColumn("verdict", F.coalesce("kind", F.when(F.col("probability") >= 0.5, "allow").otherwise("block")))
            .select("page_id", "host", "path", "rule", "score", "probability", "verdict"))


def digest(pages: DataFrame, **kw) -> DataFrame:
    return judge(pages, **kw).select("page_id", "host", "path", "rule", "verdict")
