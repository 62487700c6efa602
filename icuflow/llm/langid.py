"""Language identification by hierarchical discrimination.

A text is a bag of byte n-grams (1 to 3 bytes, hashed to ``BINS``), taken over
all of it.  The first level separates language families, the second separates
the languages of a family with one-versus-one linear support vector machines;
the winner has the most votes, then the largest summed margin.  The machines are
linear in the n-gram shares, so a text's margin is the mean of its n-grams'
weights: one table look-up per byte.

Families are learnt: the languages' mean n-gram shares are merged by average
linkage of their Hellinger distances until the square root of their number is
left, so that close languages share a family and neither level needs many
machines.  Fitting uses at most ``SAMPLE`` different training rows per language
(a documented bound, chosen by a hash of id and text), of which only n-gram
shares reach the driver; a machine takes at most ``SAMPLE`` of them a side.
Every row is predicted.

Defined cases: a null text or one without a letter is ``und`` with score 0;
without training rows every text is ``und``; with one training language every
text with a letter gets it; equal votes go to the larger summed margin, then to
the smaller name; repeated rows are learnt once and predicted alike; an empty
table gives an empty result; more than ``LANGS`` languages are an error; other
columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuflow.llm.common import crc_bucket, keyed_texts, null_ids, starts_of, text_groups

BINS = 1 << 13
SAMPLE = 300
LANGS = 200
# Besides the whole text, pieces of this many words teach the machines what a short text looks like.
PIECE_WORDS = 12
_LETTER = re.compile(r"[^\W\d_]")


def gram_bins(data: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all 1- to 3-byte grams inside the texts, and the text of each."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    bins, who = [low], [owner]
    code = low
    for n in (2, 3):
        if len(low) < n:
            break
        code = code[:-1] * np.uint32(257) + low[n - 1:]
        inside = owner[:len(code)] == owner[n - 1:]
        bins.append(((code[inside] * np.uint32(2654435761)) >> np.uint32(19)))
        who.append(owner[:len(code)][inside])
    return np.concatenate(bins).astype(np.int64), np.concatenate(who)


def shares(texts: list[str]) -> np.ndarray:
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    owner = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    bins, who = gram_bins(data, owner)
    x = np.zeros((len(raw), BINS), np.float32)
    np.add.at(x, (who, bins), 1)
    x /= np.maximum(x.sum(1, keepdims=True), 1)
    return x


def linear_svm(x: np.ndarray, y: np.ndarray, epochs: int = 12, lam: float = 1e-4, scale: float = 30.0,
               seed: int = 7) -> tuple[np.ndarray, float]:
    """Hinge loss with L2 penalty by averaged stochastic subgradient steps; both classes weigh the same."""
    rng, n = np.random.default_rng(seed), len(y)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * n
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    mean_w, mean_b, steps, t = np.zeros_like(w), 0.0, 0, 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        for first in range(0, n, 16):
            k = order[first:first + 16]
            t += 1
            rate = 1.0 / (lam * (t + 1000))
            margin = y[k] * (scale * (x[k] @ w) + b)
            push = np.where(margin < 1, y[k] * weight[k], 0) / len(k)
            w = (1 - rate * lam) * w + rate * 1e-3 * scale * (push @ x[k])
            b += rate * 1e-5 * push.sum()
            if epoch >= epochs // 2:
                mean_w, mean_b, steps = mean_w + w, mean_b + b, steps + 1
    return (mean_w / max(1, steps) * scale).astype(np.float32), float(mean_b / max(1, steps))


def related(profiles: np.ndarray) -> list[list[int]]:
    """Groups of close languages: average linkage down to the square root of their number."""
    root = np.sqrt(profiles)
    far = 1 - root @ root.T
    np.fill_diagonal(far, np.inf)
    groups: dict[int, list[int]] = {i: [i] for i in range(len(profiles))}
    while len(groups) > math.ceil(math.sqrt(len(profiles))):
        i, j = sorted(map(int, np.unravel_index(np.argmin(far), far.shape)))
        m, n = len(groups[i]), len(groups[j])
        far[i] = far[:, i] = (m * far[i] + n * far[j]) / (m + n)
        far[j] = far[:, j] = far[i, i] = np.inf
        groups[i] += groups.pop(j)
    return [sorted(g) for g in groups.values()]


def drawn(known: DataFrame, sample: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, key, text) of at most ``sample`` different rows of each language.  Rows are thinned by a hash to about
    twice as many before they are ranked, so a language with most of the rows is not sorted in one task."""
    key = F.xxhash64(id_col, text_col)
    counts = known.groupBy(lang_col).agg(F.approx_count_distinct(key).alias("n")).limit(LANGS + 1).collect()
    if len(counts) > LANGS:
        raise ValueError(f"more than {LANGS} languages")
    if not counts:
        return known.select(F.col(lang_col).alias("lang"), key.alias("key"), F.col(text_col).alias("text")).limit(0)
    top = F.create_map(*[F.lit(v) for r in counts
                         for v in (r[0], int(min(1.0, 2 * sample / max(1, r["n"])) * (2 ** 64 - 2 ** 12)) - 2 ** 63)])
    thin = known.select(F.col(lang_col).alias("lang"), key.alias("key"), F.col(text_col).alias("text")).where(F.col("key") <= top[F.col("lang")])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key", "text"))
    return thin.dropDuplicates(["lang", "key", "text"]).withColumn("place", place).where(F.col("place") <= sample).drop("place")


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-gram shares of each text and of two short pieces of it, without their zeros."""
    for b in batches:
        for i in range(b.num_rows):
            text = b.column(2)[i].as_py()
            words = text.split()
            x = shares([text, *(" ".join(words[k:k + PIECE_WORDS]) for k in (0, len(words) // 2))])
            at = [np.flatnonzero(row).astype(np.int32) for row in x]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column(0)[i].as_py()] * 3, pa.string()), pa.array([b.column(1)[i].as_py()] * 3, pa.int64()), pa.array(range(3), pa.int32()),
                 pa.array(at, pa.list_(pa.int32())), pa.array([row[k] for row, k in zip(x, at, strict=True)], pa.list_(pa.float32()))],
                names=["lang", "key", "piece", "at", "share"])


def _dense(at: list[np.ndarray], share: list[np.ndarray]) -> np.ndarray:
    x = np.zeros((len(at), BINS), np.float32)
    x[np.repeat(np.arange(len(at)), [len(k) for k in at]), np.concatenate(at)] = np.concatenate(share)
    return x


def fit(bags: pa.Table, sample: int = SAMPLE, families: dict[str, str] | None = None) -> dict:
    """Weights of all machines as columns of one table, with their places in the hierarchy.  ``families``, if given,
    replaces the learnt ones; a language that it does not name is a family of its own."""
    bags = bags.sort_by([("lang", "ascending"), ("key", "ascending"), ("piece", "ascending")])
    lang = np.array(bags.column("lang").to_pylist(), object)
    at, share = ([np.asarray(v.values) for v in bags.column(c)] for c in ("at", "share"))
    rows = {x: np.flatnonzero(lang == x) for x in sorted(set(lang))}
    langs = list(rows)
    if families is None:
        means = np.array([_dense([at[k] for k in r], [share[k] for k in r]).mean(0) for r in rows.values()]).reshape(len(langs), BINS)
        groups = [[langs[i] for i in g] for g in related(means)]
        family = {x: g[0] for g in groups for x in g}
    else:
        family = {x: families.get(x, x) for x in langs}
    names = sorted(set(family.values()))
    members = {f: [x for x in langs if family[x] == f] for f in names}
    model = {"langs": langs, "families": names, "members": members, "w": np.zeros((BINS, 0), np.float32), "b": [], "pairs": []}
    # A family's rows are its languages' first ones, as many of each.
    side = {("family", f): np.concatenate([rows[x][:3 * max(1, sample // len(m))] for x in m]) for f, m in members.items()}
    side |= {(f, x): rows[x] for f, m in members.items() for x in m}
    jobs = [("family", a, b) for a, b in itertools.combinations(names, 2)]
    jobs += [(f, a, b) for f in names for a, b in itertools.combinations(members[f], 2)]
    columns = []
    for level, a, b in jobs:
        k = np.concatenate([side[level, a], side[level, b]])
        y = np.repeat(np.array([1.0, -1.0], np.float32), [len(side[level, a]), len(side[level, b])])
        w, bias = linear_svm(_dense([at[i] for i in k], [share[i] for i in k]), y)
        columns.append(w)
        model["b"].append(bias)
        model["pairs"].append((level, a, b))
    if columns:
        model["w"] = np.stack(columns, 1)
    return model


def learn(training: DataFrame, sample: int = SAMPLE, families: dict[str, str] | None = None, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> dict:
    """The model of the ``training`` rows that have a language and a text."""
    known = training.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = drawn(known, sample, id_col, text_col, lang_col).select("lang", "key", "text")
    return fit(rows.mapInArrow(_bags, "lang string, key long, piece int, at array<int>, share array<float>").toArrow(), sample, families)


def _winner(names: list[str], margins: dict[tuple[str, str], np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the winner by votes, then summed margins, then name; and its least margin."""
    votes, total = np.zeros((n, len(names))), np.zeros((n, len(names)))
    least = np.full((n, len(names)), 4.0)
    for (a, b), m in margins.items():
        i, j = names.index(a), names.index(b)
        votes[:, i] += m >= 0
        votes[:, j] += m < 0
        total[:, i] += m
        total[:, j] -= m
        least[:, i] = np.minimum(least[:, i], m)
        least[:, j] = np.minimum(least[:, j], -m)
    best = np.argmax(np.where(votes == votes.max(1, keepdims=True), total, -np.inf), axis=1)
    return best, least[np.arange(n), best]


def predict_group(model: dict, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text of a group; a family's machines see the texts of that family only."""
    n = len(offsets) - 1
    bins, who = gram_bins(data, starts_of(offsets))
    count = np.maximum(np.bincount(who, minlength=n), 1)

    def level(name: str, names: list[str], bins: np.ndarray, who: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = {(a, b): (np.bincount(who, model["w"][:, k][bins], minlength=n) / count + model["b"][k])[of]
             for k, (lv, a, b) in enumerate(model["pairs"]) if lv == name}
        return _winner(names, m, len(of))

    fam, sure = level("family", model["families"], bins, who, np.arange(n))
    out, score = np.empty(n, object), np.zeros(n)
    for i, f in enumerate(model["families"]):
        k = np.flatnonzero(fam == i)
        if len(k) == 0:
            continue
        mine = (fam == i)[who] if len(model["members"][f]) > 1 else slice(0, 0)
        best, margin = level(f, model["members"][f], bins[mine], who[mine], k)
        out[k] = np.array(model["members"][f], object)[best]
        score[k] = np.minimum(sure[k], margin)
    return out, 1 / (1 + np.exp(-3 * score))


def identify(docs: DataFrame, training: DataFrame, sample: int = SAMPLE, families: dict[str, str] | None = None,
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Predict lang_pred and score of every text, having learnt from ``training`` rows with a language."""
    return predict(docs, learn(training, sample, families, id_col, text_col, lang_col), id_col, text_col)


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for ids, data, offsets in text_groups(batches):
            letters = np.array([bool(_LETTER.search(data[a:z].tobytes().decode("utf-8", "replace")))
                                for a, z in itertools.pairwise(offsets)])
            if model["langs"]:
                lang, score = predict_group(model, data, offsets)
                lang, score = np.where(letters, lang, "und"), np.where(letters, score, 0.0)
            else:
                lang, score = np.full(len(ids), "und", object), np.zeros(len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lang.astype(str), pa.string()),
                                              pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return null_ids(keyed_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double"))


def held_out(id_col: str = "doc_id") -> Column:
    return crc_bucket(id_col, 3) == 1


def digest(docs: DataFrame, **kw) -> DataFrame:
    out = identify(docs, docs.where(~held_out()), **kw)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
