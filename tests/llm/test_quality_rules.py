import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from icuflow.llm import quality_rules, queries

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(doc, text):
    w = _WORD.findall(text or "")
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count = Counter(wins)
    again = {j for i, x in enumerate(wins) if count[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if _WORD.search(x)]
    n = len(w)
    return (doc, n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again),
            n < 10 or 100 * len(again) > 20 * n)


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_figures_match_brute_force(spark):
    rnd = random.Random(1)
    docs = []
    for i in range(120):
        w = [rnd.choice(["a", "the", "é#", "日本", "x|y", "of", "run fast"]) + str(rnd.randint(0, rnd.choice([1, 100]))) for _ in range(rnd.randint(0, 60))]
        docs.append((i, rnd.choice(["", " ", "\n"]) + rnd.choice([" ", "\n", "\x0b", " \t\r "]).join(w) + rnd.choice(["", "\n\n", "\x0c"])))
    docs += [(500, None), (501, ""), (502, " \n\t"), (503, "a b c d e " * 40), (504, "x " * 20000), (3, docs[3][1]), (None, "w")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, w int, lines int")
    assert got(quality_rules.digest(df)) == sorted((brute(*d) for d in docs), key=str)


def test_em_learns_which_rules_tell(spark):
    rnd = random.Random(2)
    counts = Counter()
    for _ in range(4000):
        good = rnd.random() < 0.85
        counts[tuple((1 if good else -1) if rnd.random() < a else rnd.choice((1, 0, -1)) if rnd.random() < 0.3 else 0 for a in (0.9, 0.8, 0.7, 0.6, 0.05))] += 1
    share, tables = quality_rules.fit(list(counts.items()))
    assert 0.8 < share < 0.9
    tell = [t[0][1] / t[1][1] for t in tables]
    assert tell[0] > tell[3] > tell[4] > 0.2 and quality_rules.fit([])[0] == 0.9


def _brute_em(votes, steps=3000):
    """The same model document by document, in numpy, for a fixed number of steps."""
    n, rules = votes.shape
    prior = np.array([[0.90, 0.08, 0.02], [0.35, 0.15, 0.50]])  # P(1, 0, -1) of good and of bad documents
    table = np.repeat(prior[:, None], rules, axis=1)
    which = np.stack([votes == v for v in (1, 0, -1)], axis=2).astype(float)
    share, weight = 0.9, 1 + 0.05 * n
    for _ in range(steps):
        logs = np.array([(which * np.log(table[c])).sum((1, 2)) for c in (0, 1)])
        q = 1 / (1 + np.exp(-np.clip(np.log(share / (1 - share)) + logs[0] - logs[1], -50, 50)))
        share = (q.sum() + 1) / (n + 2)
        for c, (w, scale) in enumerate(((q, 1.0), (1 - q, 0.2))):
            sums = np.einsum("n,nrv->rv", w, which) + weight * prior[c] * scale
            table[c] = sums / sums.sum(1, keepdims=True)
    return share, table, q


@pytest.mark.parametrize("true_share", [0.2, 0.5, 0.85])
def test_em_against_brute_force(true_share):
    """At convergence: the share of good documents, every table, and the posteriors, mostly bad corpora included."""
    rng = np.random.default_rng(5)
    good = rng.random(5000) < true_share
    votes = np.where(rng.random((5000, 7)) < 0.85, np.where(good, 1, -1)[:, None], rng.integers(-1, 2, (5000, 7)))
    share, tables = quality_rules.fit(list(Counter(map(tuple, votes.tolist())).items()))
    want, table, q = _brute_em(votes)
    assert abs(share - want) < 1e-6 and abs(share - true_share) < 0.03
    got = np.array([[[t[c][v] for v in (1, 0, -1)] for t in tables] for c in (0, 1)])
    assert np.abs(got - table).max() < 1e-6 and ((q > 0.5) == good).mean() > 0.99


def test_posterior_and_verdict_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    figures = quality_rules.quality(spark.read.parquet(f"{sf}/documents.parquet")).toPandas()
    votes = figures[[f"vote_{k}" for k in quality_rules.RULES]].to_numpy()
    _, _, q = _brute_em(votes)
    assert np.abs(q - figures["posterior"]).max() < 1e-5
    assert (figures["kept"] == (~figures["base_failed"] & (figures["posterior"] >= 0.5))).all()


def test_verdict_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = queries.op5_quality_rules(spark, sf).where(~F.col("base_failed")).join(labels, "doc_id")
    good, bad = out.where("quality = 1"), out.where("quality = 0")
    assert good.where("kept").count() >= 0.98 * good.count() and bad.where("not kept").count() >= 0.9 * bad.count()


def test_empty_table(spark):
    assert quality_rules.digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_against_brute_force_on_the_driver_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = queries.op5_quality_rules(spark, sf)
    assert got(out) == sorted((brute(*d) for d in docs), key=str)
    assert out.where("kept and base_failed").count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()
