"""Quality rules by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on figures of the whole text.
The documents are counted by their pattern of votes (at most 3^rules rows), and
expectation-maximisation over that table estimates how each rule votes on good
and on bad documents and how many are good.  A document is kept if the posterior
probability of good is at least ``min_posterior`` and it passes the base rule.

Words are separated by ASCII white space.  Defined cases: a null or empty text
has no words and fails the base rule; repeated rows are judged one by one; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import keyed_texts, null_ids, stage

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "[#*$%&|<>]+"
WINDOW = 5
RULES = ("symbol_words", "symbol_chars", "dup_lines", "repeat_words", "word_length", "length", "digits")


def text_figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the counts that the rules read; a text never leaves its row."""
    t = keyed_texts(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    t = t.withColumn("w", F.split(F.btrim("text", F.lit(SPACE)), "[\\x20\\x09-\\x0D]+"))
    t = t.withColumn("w", F.when((F.size("w") == 1) & (F.element_at("w", 1) == ""), F.array().cast("array<string>")).otherwise(F.col("w")))
    t = t.select(
        "doc_id", "text", F.size("w").cast("long").alias("n_words"), F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.when(F.size("w") >= WINDOW,
               F.slice(F.transform("w", lambda x, i: F.xxhash64(x, *[F.get("w", i + k) for k in range(1, WINDOW)])),
                       1, F.size("w") - WINDOW + 1)).alias("h"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    count_of = lambda chars: F.char_length("text") - F.char_length(F.regexp_replace("text", chars, ""))
    t = t.withColumn("lines", lines)
    t = t.select(
        "doc_id", "n_words",
        "word_chars",
        count_of(SYMBOLS).cast("long").alias("n_symbols"),
        count_of("[0-9]+").cast("long").alias("n_digits"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        # Only texts in which a window occurs twice go on to find its places.
        F.when(F.size(F.array_distinct("h")) < F.size("h"),
               F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("s"))
    at = lambda j: F.get("s", j)["h"]
    t = t.withColumn("again", F.filter("s", lambda x, j: x["h"].eqNullSafe(at(j - 1)) | x["h"].eqNullSafe(at(j + 1))))
    t = t.withColumn("f", F.sort_array(F.transform("again", lambda x: x["i"])))
    t = t.withColumn("gap", F.zip_with("f", F.slice("f", 2, F.greatest(F.size("f"), F.lit(1))),
                                       lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))))
    return t.select("doc_id", "n_words", "word_chars", "n_symbols", "n_digits", "n_lines", "n_dup_lines",
                    F.coalesce(F.aggregate("gap", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")).alias("n_repeat_words"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules over the columns of ``text_figures``; ratios as products, so there is no division by zero."""
    c = F.col
    return dict(zip(RULES, (
        _vote(c("n_symbols") * 10 > c("n_words"), c("n_symbols") * 100 <= c("n_words")),
        _vote(c("n_symbols") * 50 > c("word_chars"), c("n_symbols") * 500 <= c("word_chars")),
        _vote(c("n_dup_lines") * 10 > c("n_lines") * 3, c("n_dup_lines") == 0),
        _vote(c("n_repeat_words") * 10 > c("n_words") * 2, c("n_repeat_words") * 20 <= c("n_words")),
        _vote((c("word_chars") < c("n_words") * 2) | (c("word_chars") > c("n_words") * 15),
              (c("word_chars") >= c("n_words") * 3) & (c("word_chars") <= c("n_words") * 10)),
        _vote(c("n_words") < 10, c("n_words") >= 30),
        _vote(c("n_digits") * 5 > c("word_chars"), c("n_digits") * 20 <= c("word_chars"))), strict=True))


def fit(patterns: list[tuple[tuple[int, ...], int]], prior_share: float = 0.05, tolerance: float = 1e-9, most: int = 10_000) -> tuple[float, list]:
    """Expectation-maximisation over counted vote patterns: (share of good, per rule (P(v|good), P(v|bad))).

    ``prior_share`` of the documents count as pseudo-votes of a careful rule, good and bad alike, which
    keeps the meaning of the two classes and every probability above 0; the share of good documents
    is free.  The steps end when no probability moves by more than ``tolerance``.
    """
    total = sum(n for _, n in patterns)
    good0, bad0 = {1: 0.90, 0: 0.08, -1: 0.02}, {1: 0.35, 0: 0.15, -1: 0.50}
    share, tables = 0.9, [(dict(good0), dict(bad0)) for _ in (patterns[0][0] if patterns else RULES)]
    for _ in range(most if total else 0):
        weight = 1 + prior_share * total
        sums = [({v: weight * good0[v] for v in good0}, {v: weight * bad0[v] * 0.2 for v in bad0}) for _ in tables]
        good_n = 0.0
        for p, n in patterns:
            odds = math.log(share / (1 - share)) + sum(math.log(t[0][v] / t[1][v]) for t, v in zip(tables, p, strict=True))
            q = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
            good_n += n * q
            for s, v in zip(sums, p, strict=True):
                s[0][v] += n * q
                s[1][v] += n * (1 - q)
        # One pseudo-document of either class keeps the share off 0 and 1.
        new_share = (good_n + 1) / (total + 2)
        new = [tuple({v: x / sum(side.values()) for v, x in side.items()} for side in s) for s in sums]
        moved = max([abs(new_share - share), *(abs(x[v] - y[v]) for s, t in zip(new, tables, strict=True) for x, y in zip(s, t, strict=True) for v in x)])
        share, tables = new_share, new
        if moved <= tolerance:
            break
    return share, tables


def quality(docs: DataFrame, min_posterior: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Figures, votes, posterior probability of good, base rule and verdict per document."""
    t = text_figures(docs, id_col, text_col)
    t = stage(t.select("*", *[v.cast("int").alias(f"vote_{k}") for k, v in votes().items()]), "quality-figures")
    names = [f"vote_{k}" for k in RULES]
    # One row per pattern of votes: at most 3^7 rows, whatever the input.
    counted = [(tuple(r[k] for k in names), r["n"]) for r in t.groupBy(*names).agg(F.count("*").alias("n")).collect()]
    share, tables = fit(counted)
    odds = F.lit(math.log(share / (1 - share)))
    for k, (good, bad) in zip(names, tables, strict=True):
        weight = {v: math.log(good[v] / bad[v]) for v in (1, 0, -1)}
        odds = odds + F.when(F.col(k) == 1, weight[1]).when(F.col(k) == -1, weight[-1]).otherwise(weight[0])
    t = t.withColumn("posterior", 1 / (1 + F.exp(-odds)))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    t = null_ids(t)
    return t.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= min_posterior))


def digest(docs: DataFrame, **kw) -> DataFrame:
    return quality(docs, **kw).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept", F.round("posterior", 6).alias("posterior"))
