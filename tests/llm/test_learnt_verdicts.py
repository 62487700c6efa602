"""Verdicts of the learnt operators (op9, op10) against plain computations, row by row."""

import math

import numpy as np
import pytest

from icuflow.llm import langid, quality_model

WORDS = ("the river was quiet and people walked home along old stone houses under pale morning light while children "
         "played near water singing songs about ships storms harbours").split()


def dialect(words, shift):
    """A made-up language: letters moved along the alphabet."""
    return ["".join(chr((ord(c) - 97 + shift) % 26 + 97) for c in w) for w in words]


def near(words):
    """A close relative: one letter and one ending differ."""
    return [w.replace("a", "o") + ("en" if len(w) > 4 else "") for w in words]


def corpus(langs, each, seed):
    rng = np.random.default_rng(seed)
    return [(" ".join(rng.choice(words, 30)), lang) for lang, words in langs.items() for _ in range(each)]


@pytest.fixture(scope="module")
def langs():
    out = {}
    for k, name in enumerate("abc"):
        base = dialect(WORDS, 7 * k)
        out[f"{name}1"], out[f"{name}2"] = base, near(base)
    return out


def test_families_are_learnt_and_close_languages_told_apart(spark, langs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(corpus(langs, 40, 1))]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(map(sorted, model["members"].values())) == [["a1", "a2"], ["b1", "b2"], ["c1", "c2"]]
    test = [(i, t, lang) for i, (t, lang) in enumerate(corpus(langs, 30, 2))]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(spark.createDataFrame(test, "doc_id long, text string, lang string"), model).collect()}
    assert sum(got[i] == lang for i, _, lang in test) >= 0.98 * len(test)
    given = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), families={"a1": "x", "b1": "x"})
    assert given["members"]["x"] == ["a1", "b1"] and given["members"]["a2"] == ["a2"]


def plain_language(model, text):
    raw = text.encode()
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    grams = list(raw)
    for n in (2, 3):
        for k in range(len(raw) - n + 1):
            code = raw[k]
            for b in raw[k + 1:k + n]:
                code = (code * 257 + b) % (1 << 32)
            grams.append((code * 2654435761 % (1 << 32)) >> 19)

    def winner(level, names):
        votes, total, least = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, 4.0)
        for k, (lv, a, b) in enumerate(model["pairs"]):
            if lv == level:
                m = sum(float(model["w"][g, k]) for g in grams) / max(1, len(grams)) + model["b"][k]
                votes[a if m >= 0 else b] += 1
                total[a] += m
                total[b] -= m
                least[a], least[b] = min(least[a], m), min(least[b], -m)
        best = max(names, key=lambda x: (votes[x], total[x]))
        return best, least[best]

    family, sure = winner("family", model["families"])
    lang, margin = winner(family, model["members"][family])
    return lang, 1 / (1 + math.exp(-3 * min(sure, margin)))


def test_language_verdicts_against_a_plain_computation(spark, langs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(corpus(langs, 12, 3))]
    extra = [(900, "Mixed THE river 12 ünïcode", None), (901, "x", None), (902, "é", None), (902, "é", None)]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string")
    model = langid.learn(df)
    texts = {i: t for i, t, _ in rows + extra}
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows) + len(extra)
    for r in got:
        lang, score = plain_language(model, texts[r["doc_id"]])
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-6


def test_winner_by_votes_then_summed_margin_then_name():
    m = {("a", "b"): np.array([900.0, 1.0, 1.0]), ("b", "c"): np.array([901.0, 1.0, 2.0]), ("a", "c"): np.array([-800.0, -1.0, 1.0])}
    best, least = langid._winner(["a", "b", "c"], m, 3)
    assert best.tolist() == [0, 0, 0] and least.tolist() == [-800.0, -1.0, 1.0]
    best, _ = langid._winner(["a", "b", "c"], {("a", "b"): np.array([50.0]), ("b", "c"): np.array([70.0]), ("a", "c"): np.array([-60.0])}, 1)
    assert best.tolist() == [1]  # one vote each; sums -10, 20, -10


def test_sample_is_bounded_by_different_rows(spark):
    rows = [(1, "same text", "en")] * 500 + [(i, f"text {i}", "en") for i in range(2, 400)] + [(i, f"texte {i}", "fr") for i in range(400, 420)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = [tuple(r) for r in langid.drawn(df, 50, "doc_id", "text", "lang").collect()]
    assert len(got) == len(set(got)) == 70 and sum(r[0] == "fr" for r in got) == 20
    assert set(got) == {tuple(r) for r in langid.drawn(df.repartition(3), 50, "doc_id", "text", "lang").collect()}
    many = spark.range(langid.LANGS + 1).selectExpr("id AS doc_id", "'a' AS text", "cast(id AS string) AS lang")
    with pytest.raises(ValueError, match="languages"):
        langid.learn(many)


def plain_quality(p, text):
    """The score of one document, passage by passage."""
    size, bins = quality_model.PASSAGE, quality_model.BINS
    codes, at = [], []  # words of the whole text, by first byte
    for k, b in enumerate(text):
        if b > 32:
            if k == 0 or text[k - 1] <= 32:
                codes.append(b"")
                at.append(k)
            codes[-1] += bytes([b])
    hidden, weight = [], []
    for first in range(0, max(1, len(text)), size):
        part = text[first:first + size]
        x = np.zeros(bins)
        for b in part:
            x[b] += 1
        for a, b in zip(part, part[1:], strict=False):
            x[256 + ((((a * 257 + b) * 2654435761) % (1 << 32)) >> 8) % (bins - 257)] += 1
        x = np.sqrt(x / max(1, len(part)))
        inside = [k for k, a in enumerate(at) if first <= a < first + size]
        if len(at) > 1:
            x[bins - 1] = 3 * sum(k > 0 and codes[k] == codes[k - 1] for k in inside) / max(1, len(inside))
        h = np.tanh(x @ p["E"] + p["e"])
        hidden.append(h)
        weight.append(float((np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))) @ p["w"]))
    a = np.exp(np.array(weight) - max(weight))
    z = (a / a.sum()) @ np.array(hidden)
    return 1 / (1 + math.exp(-float(z @ p["c"] + p["b"])))


def test_quality_scores_against_a_plain_computation(spark):
    rng = np.random.default_rng(4)
    good = [" ".join(rng.choice(WORDS, n)) for n in (5, 60, 200, 90, 120, 30)]
    bad = [" ".join(rng.choice(["BUY", "$$$", "now", "now", "click!"], n)) for n in (5, 60, 200, 90, 120, 30)]
    docs = [*enumerate(good + bad), (50, ""), (51, None), (52, "wörter wörter und und"), (53, "x" * 1000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < len(good))) for i in range(len(good + bad))], "doc_id long, quality int")
    rows = quality_model.training_rows(df, labels, quality_model.SAMPLE)
    p = quality_model.fit([t for t, _ in rows], np.array([y for _, y in rows], np.float32))
    texts = dict(docs)
    got = quality_model.score(df, labels).collect()
    assert len(got) == len(docs)
    for r in got:
        assert abs(r["score"] - plain_quality(p, (texts[r["doc_id"]] or "").encode())) < 1e-4
