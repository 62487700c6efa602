import re
from collections import Counter
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from icuflow.llm import filter_audit


def mask_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return ((len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) << 2 | bool(re.search(r"[#$%&*|]", text)) << 3)


def brute(docs, labels):
    """Rows of the audit over (doc_id, text, lang) and (doc_id, quality, toxic)."""
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    facts = Counter()
    for i, t, lang in docs:
        mask = mask_of(t or "") | (16 if i is not None and least[t or ""] < i else 0)
        mine = [r for r in labels if r[0] == i and i is not None]
        facts[lang or "", mask, any(r[1] == 1 for r in mine), any(r[2] == 1 for r in mine)] += 1
    out, shapley = [], Counter()
    for part in {f[0] for f in facts}:
        rows = [(m, g, b, n) for (p, m, g, b), n in facts.items() if p == part]
        for order in permutations("ABCDE"):
            before = 0
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                gone = lambda test, which=3: sum((r[3] if which == 3 else r[3] * r[which]) for r in rows if test(r[0]))
                hit = lambda m, bit=bit, before=before: m & bit and not m & before
                out.append((part, "".join(order), step, gone(lambda m: not m & (bit | before)), gone(hit), gone(lambda m: m & bit and m & before),
                            gone(lambda m: m == bit), gone(hit, 1), gone(hit, 2), name))
                shapley[part, name] += gone(hit)
                before |= bit
    return sorted((*r[:9], shapley[r[0], r[9]]) for r in out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def got(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, 2, "x") for r in docs], "doc_id long, text string, lang string, mask int, n int, cell string").repartition(5)
    q = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(9))
    return sorted(tuple(r) for r in filter_audit.audit(d, q).select(COLUMNS).collect())


def corpus(n=260, seed=2):
    rng = np.random.default_rng(seed)
    words = ["alpha", "Beta", "gamma", "élan", "GAMMA", "x&y", "100%", "straße", "über", "delta"] + [f"w{i}" for i in range(400)]
    head = "shared licence header " * 30
    docs = []
    for i in range(n):
        kind = i % 6
        text = " ".join(rng.choice(words, int(rng.integers(1, 420)))) if kind < 3 else head + str(i % 17) if kind == 3 else "copy of one text" if kind == 4 else head[:int(rng.integers(0, 60))]
        docs.append((i * 3, text, ["en", "de", None, ""][i % 4]))
    return docs


def test_equals_brute_force(spark, monkeypatch):
    docs = corpus()
    labels = [(i * 3, i % 2, i % 5 == 0) for i in range(0, 260, 2)]
    labels = [(a, b, int(c)) for a, b, c in labels]
    want = brute(docs, labels)
    assert got(spark, docs, labels) == want
    # Tries and ranges of a few texts: copies meet across tasks, and prefixes go beyond the common header.
    monkeypatch.setattr(filter_audit, "GROUP_BYTES", 300)
    monkeypatch.setattr(filter_audit, "RANGE_BYTES", 2000)
    assert got(spark, docs, labels) == want


def test_edge_cases(spark):
    long_ = "wort " * 300_000
    docs = [(5, None, "en"), (3, "", "en"), (9, "", None), (None, "", "en"), (None, long_, ""), (7, long_, "fr"), (7, long_, "fr"), (8, long_, "fr"),
            (8, "\x1c\x85 a b", "en"), (8, "AB\tcd\x0b", "en"), (-4, "\x00", "en"), (11, "\x00\x00", "en"), (12, "\x00", "en")]
    labels = [(7, 1, None), (7, 0, 1), (8, None, 1), (None, 1, 1), (3, 1, 1), (3, 1, 1), (99, 1, 1)]
    assert got(spark, docs, labels) == brute(docs, labels)
    assert got(spark, docs, []) == brute(docs, [])
    assert got(spark, [], labels) == []


def test_ranges_are_bounded_unless_one_text_fills_them(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE_BYTES", 3000)
    docs = spark.createDataFrame([(i, "z" * 700 + str(i) if i % 2 else f"{i} y") for i in range(400)], "doc_id long, text string").withColumn("lang", F.lit("en"))
    judged = docs.select("doc_id", F.col("lang").alias("part"), "text").mapInArrow(
        filter_audit._judge, "doc_id long, part string, mask int, n long, text binary, cells array<long>")
    sizes = filter_audit.ranges(judged).groupBy("cell").agg(F.sum(F.length("text") + 64).alias("size"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in sizes) == 400 and all(r["size"] <= 3000 or r["n"] == 1 for r in sizes)


def test_trie_finds_every_string_and_its_least_id():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 99, int(rng.integers(0, 12))).astype(np.uint8)) for _ in range(3000)]
    trie, least = filter_audit.Trie(), {}
    at = [trie.insert(t, (i * 37) % 3001) for i, t in enumerate(texts)]
    for i, t in enumerate(texts):
        least[t] = min(least.get(t, 1 << 30), (i * 37) % 3001)
    assert [trie.least[a] for a in at] == [least[t] for t in texts] and len(set(at)) == len(least)
