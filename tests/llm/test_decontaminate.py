import hashlib
import random
import re

import pytest

from icuflow.llm import decontaminate, queries

_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    sizes = {len(w) for w in wins}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                who = wins.get(tuple(w[i:i + n]))
                if who:
                    hit.update(range(i, i + n))
                    found |= who
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    vocab = ["a", "B", "cé", "d1", "Ünd", "日本", "x y", "of"]
    items = [(i, rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocab) for _ in range(rnd.randint(0, 30)))) for i in range(25)] + [(90, None), (91, "?!"), (92, "B a")]
    docs = []
    for i in range(60):
        t = [rnd.choice(vocab) for _ in range(rnd.randint(0, 80))]
        if rnd.random() < 0.7:
            t.insert(len(t) // 2, (rnd.choice(items)[1] or "").upper())
        docs.append((i, rnd.choice([" ", "-", " ... "]).join(t)))
    return docs + [(100, None), (101, ""), (102, "..."), (5, docs[5][1])], items


@pytest.mark.parametrize("seed,limit", [(1, 10**6), (2, 10**6), (3, 40), (4, 1)])
def test_matches_brute_force_with_one_and_several_automata(spark, seed, limit):
    docs, items = corpus(seed)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(decontaminate.digest(d, b, automaton_words=limit)) == brute(docs, items)
    clean = {r[0] for r in brute(docs, items) if not r[5]}
    assert {r["doc_id"] for r in decontaminate.keep(d, b, automaton_words=limit).collect()} == clean


def test_spans_are_places_in_the_original(spark):
    item = "Who wrote the long book about whales, ships and the sea in 1851?"
    doc = "Früher: (" + item.upper().replace(" ", " \n ") + ") — ja."
    d, b = spark.createDataFrame([(1, doc)], "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    r = decontaminate.scan(d, b).first()
    assert [doc[s["start"]:s["end"]] for s in r["spans"]] == [item.upper().replace(" ", " \n ").rstrip("?")] and r["items"] == ["7"]


def test_empty_tables_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 3), (None, "x", 4)], "doc_id long, text string, items int")
    none = spark.createDataFrame([], "item_id long, text string")
    assert got(decontaminate.digest(docs, none)) == brute([(1, "a b c"), (None, "x")], [])
    assert decontaminate.keep(docs, none).count() == 2
    assert decontaminate.digest(spark.createDataFrame([], "doc_id long, text string"), none).collect() == []


def test_query_against_brute_force_on_the_driver_table(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(c, "text").collect()] for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert got(queries.op4_decontaminate(spark, sf)) == brute(docs, items)
