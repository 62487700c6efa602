import zlib

import numpy as np
from pyspark.sql import functions as F

from icuflow.llm import langid, quality_model, queries

SF = "/root/testdata/sf0.01"


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.op9_language_id(spark, SF).join(docs, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held) > 0


def test_language_edge_cases(spark):
    train = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog were here", "en"), ("der Hund und die Katze sind hier", "de"),
                                                         ("le chat et le chien sont ici", "fr"), ("el gato y el perro están aquí", "es")] * 12)]
    df = spark.createDataFrame([(*r, 0.0) for r in train] + [(900, None, "en", 0.0), (901, "", None, 0.0), (902, "12 34 _!", "de", 0.0), (None, "the dog", None, 0.0), (7, "é" * 50000, None, 0.0)],
                               "doc_id long, text string, lang string, score double")
    got = {r["doc_id"]: r for r in langid.identify(df, df).collect()}
    assert [got[k]["lang_pred"] for k in (900, 901, 902)] == ["und"] * 3 and got[901]["score"] == 0
    assert got[0]["lang_pred"] == "en" and got[1]["lang_pred"] == "de" and got[2]["lang_pred"] == "fr" and got[3]["lang_pred"] == "es" and got[None]["lang_pred"] == "en"
    none = df.limit(0)
    assert {r["lang_pred"] for r in langid.identify(df, none).collect()} == {"und"} and langid.identify(none, df).collect() == []
    one = df.where("lang = 'fr'")
    assert {r["lang_pred"] for r in langid.identify(df.where("doc_id < 5"), one).collect()} == {"fr"}


def test_margins_are_linear_in_the_gram_shares():
    texts = ["abc äö", "", "zz top", "ß"]
    w = np.random.default_rng(0).normal(size=(langid.BINS, 1)).astype(np.float32)
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    bins, who = langid.gram_bins(np.frombuffer(b"".join(raw), np.uint8), langid.starts_of(offsets))
    got = np.bincount(who, w[:, 0][bins], minlength=4) / np.maximum(np.bincount(who, minlength=4), 1)
    assert np.allclose(got, (langid.shares(texts) @ w)[:, 0], atol=1e-5)


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = queries.op10_quality_model(spark, SF).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.97 * len(held) > 0


def test_gradient_of_the_attention_model():
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(32, 120, n).astype(np.uint8)) for n in (900, 0, 30, 1300)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    x, first = quality_model.passages(np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert np.diff(first).tolist() == [3, 1, 1, 4]
    p = quality_model.fit(texts * 8, np.array([1, 0, 0, 1] * 8, np.float32), epochs=30)
    y, (_, _, _, a, _, bag) = quality_model.forward(p, x, first)
    assert np.allclose(np.bincount(bag, a), 1) and ((y > 0.5) == [True, False, False, True]).all()


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, "good text here", 9), (2, None, 9), (3, "", 9), (3, "", 9), (None, "x" * 100000, 9)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in quality_model.digest(docs, none).collect()] == [0.5] * 5
    same = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert quality_model.digest(docs, same).where("predicted = 1").count() == 5
    assert quality_model.digest(docs.limit(0), same).collect() == []
    kept = quality_model.keep(docs, none)
    assert kept.columns == docs.columns and kept.count() == 5
    assert quality_model.keep(docs, none, threshold=0.6).count() == 0


def test_fitting_goes_on_until_the_loss_stops_falling():
    assert not quality_model.converged([]) and quality_model.converged([0.7, 0.3, quality_model.LOSS_END])
    falling = [0.7 * 0.9 ** k for k in range(20)]
    assert not any(quality_model.converged(falling[:k]) for k in range(1, 20)) and quality_model.converged(falling[:3] + [falling[2]] * quality_model.PATIENCE)
    # A handful of labels is learnt as well as thousands are.
    rng = np.random.default_rng(2)
    good = [" ".join(rng.choice(["the", "river", "was", "quiet", "and", "people", "walked", "home"], 60)).encode() for _ in range(20)]
    bad = [" ".join(rng.choice(["buy", "NOW", "$$$", "###", "click"], 60)).encode() for _ in range(6)]
    p = quality_model.fit(good + bad, np.array([1] * 20 + [0] * 6, np.float32))
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in good + bad])])
    y, _ = quality_model.forward(p, *quality_model.passages(np.frombuffer(b"".join(good + bad), np.uint8), offsets))
    assert ((y > 0.5) == ([True] * 20 + [False] * 6)).all()


def test_few_labels_reject_bad_documents(spark):
    """At the smallest scale nearly all graded documents are judged right, held-out ones too."""
    small = "/root/testdata/sf0.001"
    labels = spark.read.parquet(f"{small}/labels.parquet")
    rows = queries.op10_quality_model(spark, small).join(labels, "doc_id").collect()
    assert sum(r["predicted"] != r["quality"] for r in rows) <= 0.03 * len(rows)
