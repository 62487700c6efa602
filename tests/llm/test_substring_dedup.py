import hashlib
import random

import numpy as np
import pytest

from icuflow.llm import repeats, substring_dedup


def brute(rows, window=20):
    seen, out = {}, []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = b" ".join(w[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            else:
                seen[key] = 1
        left = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return out


def got(df):
    return [tuple(r) for r in df.orderBy("doc_id").collect()]


def corpus(seed, n=80):
    rnd = random.Random(seed)
    vocab = ["a", "b", "the", "é", "日本", "of x", "run"]
    word = lambda: rnd.choice(vocab) + (str(rnd.randint(0, 50)) if rnd.random() < 0.6 else "")
    shared = [word() for _ in range(200)]
    rows = []
    for i in range(n):
        t = [word() for _ in range(rnd.randint(0, 150))]
        k = rnd.random()
        if k < 0.4:
            a = rnd.randint(0, 150)
            t[len(t) // 2:len(t) // 2] = shared[a:a + rnd.randint(15, 60)]
        elif k < 0.5 and rows:
            t = rnd.choice(rows)[1].split(" ")
        elif k < 0.6:
            t += ["x", "x", "y"] * rnd.randint(0, 30) + ["z"] * rnd.randint(0, 80)
        rows.append((i * 3, rnd.choice([" ", "\n", " \t"]).join(t) if k < 0.9 else "  " + " ".join(t) + "\x0b"))
    return rows + [(1, None), (4, ""), (7, " \n ")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(substring_dedup.digest(df)) == brute(rows)


def test_large_and_hot_groups_and_segments_give_the_same(spark, monkeypatch):
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    monkeypatch.setattr(repeats, "GROUP_PIECES", 2)
    assert got(substring_dedup.digest(df)) == want
    monkeypatch.setattr(repeats, "HOT_SAMPLE", 1)
    monkeypatch.setattr(repeats, "HOT_LEAST", 2)
    monkeypatch.setattr(repeats, "HOT_SHARE", 10**6)
    assert got(substring_dedup.digest(df)) == want
    monkeypatch.setattr(repeats, "SEGMENT", 40)
    assert got(substring_dedup.digest(df)) == want


def test_equal_windows_choose_equal_anchors():
    rnd = random.Random(3)
    inner = [rnd.choice("abcdefgh") for _ in range(40)]
    found = []
    for _ in range(30):
        left = [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 30))]
        text = " ".join(left + inner + [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 30))]).encode()
        data = np.frombuffer(text, np.uint8)
        b, e, d = substring_dedup.word_bounds(data, np.array([0, len(data)]))
        codes = substring_dedup.word_codes(data, b, e)
        at = np.arange(len(codes))
        levels = [substring_dedup.Level(codes, d, at, at + 1, at, at + 1)]
        for r in range(4):
            levels.append(substring_dedup.compress(levels[-1], r + 1))
        place, name = substring_dedup.choose_anchors(levels, np.arange(len(codes) - 19), 20, repeats.Hashes(codes))
        found.append([(p // 6 - len(left) if p >= 0 else None, n) for p, n in zip(place.tolist(), name.tolist())][len(left):len(left) + 21])
        assert (place >= 0).all()
    assert all(f == found[0] for f in found)


def test_empty_table_null_and_repeated_ids_and_extra_columns(spark):
    assert got(substring_dedup.digest(spark.createDataFrame([], "doc_id long, text string"))) == []
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(None, t, 1), (5, "a " + t, 1), (9, t + " b", 1), (9, t + " b", 1)], "doc_id long, text string, spans int")
    assert [r[1:3] for r in got(substring_dedup.digest(df))] == [(30, 0), (31, 30), (31, 30), (31, 30)]
    one = spark.createDataFrame([(9, t), (9, t)], "doc_id long, text string")
    assert [r[2] for r in got(substring_dedup.digest(one))] == [0, 0]


def test_query_against_brute_force_on_the_driver_table(spark):
    from icuflow.llm import queries
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got(queries.op8_substring_dedup(spark, sf)) == brute([tuple(r) for r in docs])


def thue_morse(bits, letters):
    a, b = letters
    for _ in range(bits):
        a, b = a + b, b + a
    return a, b


def test_words_whose_power_sums_are_equal_are_different_words(spark):
    one, two = thue_morse(11, "ab")
    rest = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{rest} {one}"), (4, f"{one} {rest}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(substring_dedup.digest(df)) == brute(rows)
    assert [r["n_removed"] for r in substring_dedup.digest(df).orderBy("doc_id").collect()] == [0, 0, 0, 20]
