import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from icuflow.llm import repeats, suffix_dedup


def brute(rows, window):
    """(doc_id, text) -> per doc n_bytes, n_removed, n_spans, sha256 of what is left."""
    seen, out = {}, []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            w = b[i:i + window]
            if w in seen:
                gone[i:i + window] = b"\x01" * window
            else:
                seen[w] = 1
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc, len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def got(df):
    return [tuple(r) for r in df.orderBy("doc_id").collect()]


def corpus(seed, n=60):
    rnd = random.Random(seed)
    words = ["the", "é", "of", "Ströme", "a", "running", "x", "日本"]
    shared = " ".join(rnd.choice(words) + str(rnd.randint(0, 99)) for _ in range(60))
    rows = []
    for i in range(n):
        t = " ".join(rnd.choice(words) + str(rnd.randint(0, 999)) for _ in range(rnd.randint(0, 120)))
        k = rnd.random()
        if k < 0.3:
            a = rnd.randint(0, 150)
            t = t[:len(t) // 2] + shared[a:a + rnd.randint(60, 400)] + t[len(t) // 2:]
        elif k < 0.4 and rows:
            t = rnd.choice(rows)[1]
        elif k < 0.5:
            t = "ab" * rnd.randint(0, 200) + t + "z" * rnd.randint(0, 300)
        rows.append((i * 3, t))
    return rows + [(1, None), (4, "")]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(suffix_dedup.digest(df)) == brute(rows, 100)


@pytest.mark.parametrize("pieces,hot", [(3, 10**9), (1000, 1), (2, 1)])
def test_large_and_hot_groups_give_the_same(spark, monkeypatch, pieces, hot):
    rows = corpus(5)
    monkeypatch.setattr(repeats, "GROUP_PIECES", pieces)
    if hot == 1:
        monkeypatch.setattr(repeats, "HOT_SAMPLE", 1)
        monkeypatch.setattr(repeats, "HOT_LEAST", 2)
        monkeypatch.setattr(repeats, "HOT_SHARE", 10**6)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(suffix_dedup.digest(df)) == brute(rows, 100)


def test_long_texts_in_segments(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 300)
    monkeypatch.setattr(repeats.segments, "__defaults__", (300,))
    rows = corpus(7, 20)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(suffix_dedup.digest(df)) == brute(rows, 100)


def test_empty_table_null_and_repeated_ids_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert got(suffix_dedup.digest(empty)) == []
    t = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(100))
    df = spark.createDataFrame([(None, t, 1, 2), (5, t, 1, 2), (7, "u" + t, 1, 2), (7, "u" + t, 1, 2)], "doc_id long, text string, spans int, h int")
    rows = got(suffix_dedup.digest(df))
    assert [r[2] for r in rows] == [0, len(t), len(t), len(t)]
    kept = suffix_dedup.keep(df)
    assert kept.columns == df.columns and sorted(r["text"] for r in kept.collect()) == sorted([t, "u", "u"])


def test_repeated_rows_are_not_copies_of_each_other(spark):
    t = "".join(chr(97 + i * 5 % 26) + str(i) for i in range(100))
    df = spark.createDataFrame([(7, t), (7, t)], "doc_id long, text string")
    assert [r[2] for r in got(suffix_dedup.digest(df))] == [0, 0]


def test_suffix_array_is_sorted_to_the_depth():
    rng = np.random.default_rng(1)
    for text in (rng.integers(1, 4, 300), rng.integers(0, 3, 500), np.ones(50), rng.integers(1, 250, 400)):
        t = text.astype(np.uint8)
        order = suffix_dedup.suffix_array(t, 100)
        assert sorted(order.tolist()) == list(range(len(t)))
        b = t.tobytes()
        keys = [b[i:i + 100] for i in order.tolist()]
        assert keys == sorted(keys)


def test_query_against_brute_force_on_the_driver_table(spark):
    from icuflow.llm import queries
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got(queries.op3_suffix_dedup(spark, sf)) == brute([tuple(r) for r in docs], 100)


def thue_morse(bits, letters):
    a, b = letters
    for _ in range(bits):
        a, b = a + b, b + a
    return a, b


def test_texts_whose_power_sums_are_equal_are_different_texts(spark):
    one, two = thue_morse(11, "ab")
    noise = "".join(chr(33 + (i * i * 7 + i // 3) % 90) for i in range(300))
    rows = [(1, one), (2, two), (3, noise + one[:128]), (4, noise + two[:128]), (5, one)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(suffix_dedup.digest(df)) == brute(rows, 100)
