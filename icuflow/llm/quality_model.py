"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages: its whole text in pieces of ``PASSAGE`` bytes.
Each passage is encoded from the shares of its bytes and byte pairs (hashed to
``BINS``): h = tanh(x E).  Gated attention, softmax(w . (tanh(h V) * sigmoid(h U))),
weighs the passages; the weighted representation gives the document's score.
Only document labels are needed: the attention learns which passages matter.

Fitting uses at most ``SAMPLE`` labelled documents (a documented bound, chosen
by a hash of the id); every document is scored whole.

Defined cases: a null or empty text is one empty passage and gets a score; where
a document has several labels their mean counts; without labels, or with labels
of one class only, the score is the smoothed share of label 1; repeated rows get
the same score; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import bounded_sample, crc_bucket, handing_back, keyed_texts, null_ids, row_filter, starts_of, text_groups

PASSAGE = 400
BINS = 1024
HIDDEN, ATTENTION = 16, 8
SAMPLE = 3000
THRESHOLD = 0.3
GROUP_BYTES = 1 << 19
# Fitting ends when an epoch's mean loss is at most LOSS_END, or PATIENCE epochs have not brought it below
# LOSS_FALL of the best before them: a few labels take many epochs, many labels few.
LOSS_END, LOSS_FALL, PATIENCE = 0.01, 0.98, 10


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage features (rows) and the first passage of each document, over whole texts."""
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(count)])
    owner = starts_of(offsets)
    piece = first[owner] + (np.arange(len(data)) - offsets[owner]) // PASSAGE
    n = int(first[-1])
    x = np.bincount(piece * BINS + data, minlength=n * BINS)
    if len(data) > 1:
        code = (data[:-1].astype(np.uint32) * np.uint32(257) + data[1:]) * np.uint32(2654435761)
        same = piece[:-1] == piece[1:]
        x = x + np.bincount(piece[:-1][same] * BINS + 256 + (code[same] >> np.uint32(8)).astype(np.int64) % (BINS - 257), minlength=n * BINS)
    length = np.maximum(np.bincount(piece, minlength=n), 1).astype(np.float32)
    x = np.sqrt(x.reshape(n, BINS).astype(np.float32) / length[:, None])
    # The last column: share of words equal to the word before them.
    gap = (data <= 32).astype(np.int8)
    before = np.concatenate([[1], gap])[:len(data)]
    before[offsets[:-1][sizes > 0]] = 1  # a text's first byte begins a word, whatever text lies before it
    begins = np.flatnonzero((gap == 0) & (before == 1))
    if len(begins) > 1:
        codes = np.add.reduceat(np.where(gap, 0, (data + np.uint64(1)) * _place(len(data), begins)), begins)
        again = (codes[1:] == codes[:-1]) & (owner[begins[1:]] == owner[begins[:-1]])
        words = np.bincount(piece[begins], minlength=n)
        x[:, BINS - 1] = 3 * np.bincount(piece[begins[1:]][again], minlength=n) / np.maximum(words, 1)
    return x, first


def _place(n: int, begins: np.ndarray) -> np.ndarray:
    """A multiplier for each byte by its place in its word."""
    at = np.arange(n, dtype=np.int64)
    inside = at - begins[np.maximum(np.searchsorted(begins, at, side="right") - 1, 0)]
    return (np.maximum(inside, 0).astype(np.uint64) * np.uint64(2) + np.uint64(3)) * np.uint64(0x9E3779B97F4A7C15)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def forward(p: dict, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, tuple]:
    h = np.tanh(x @ p["E"] + p["e"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    s = (t * g) @ p["w"]
    bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
    top = np.maximum.reduceat(s, first[:-1])
    a = np.exp(s - top[bag])
    a /= np.add.reduceat(a, first[:-1])[bag]
    z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
    return _sigmoid(z @ p["c"] + p["b"]), (h, t, g, a, z, bag)


def converged(losses: list[float]) -> bool:
    """The mean losses of the epochs so far have stopped falling."""
    if losses and losses[-1] <= LOSS_END:
        return True
    return len(losses) > PATIENCE and min(losses[-PATIENCE:]) > LOSS_FALL * min(losses[:-PATIENCE])


def fit(texts: list[bytes], labels: np.ndarray, epochs: int | None = None, rate: float = 0.01, seed: int = 3) -> dict:
    """Adam on the log loss until it stops falling, or for ``epochs``; the gradient passes through attention and encoder."""
    share = (float(labels.sum()) + 1) / (len(labels) + 2)
    if len(labels) == 0 or labels.min() >= 0.5 or labels.max() < 0.5:
        return {"constant": share}
    rng = np.random.default_rng(seed)
    p = {"E": rng.normal(0, 0.5, (BINS, HIDDEN)), "e": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, ATTENTION)),
         "U": rng.normal(0, 0.3, (HIDDEN, ATTENTION)), "w": rng.normal(0, 0.3, ATTENTION),
         "c": rng.normal(0, 0.3, HIDDEN), "b": np.array(np.log(share / (1 - share)))}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    step, beta = 0, (0.9, 0.999)
    losses: list[float] = []
    while len(losses) < epochs if epochs is not None else not converged(losses):
        order, loss = rng.permutation(len(texts)), 0.0
        for k in range(0, len(order), 64):
            pick = order[k:k + 64]
            offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])])
            x, first = passages(np.frombuffer(b"".join(texts[i] for i in pick), np.uint8), offsets)
            y, (h, t, g, a, z, bag) = forward(p, x, first)
            loss -= float((np.where(labels[pick] > 0.5, np.log(y), np.log(1 - y))).sum())
            d = ((y - labels[pick]) / len(pick)).astype(np.float32)
            dz = d[:, None] * p["c"]
            da = (h * dz[bag]).sum(1)
            ds = a * (da - np.add.reduceat(a * da, first[:-1])[bag])
            dt, dg = ds[:, None] * p["w"] * g * (1 - t * t), ds[:, None] * p["w"] * t * g * (1 - g)
            dh = (a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
            grad = {"E": x.T @ dh, "e": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ ds, "c": z.T @ d, "b": d.sum()}
            step += 1
            for n, gr in grad.items():
                gr = gr + 1e-4 * p[n]
                m[n] = beta[0] * m[n] + (1 - beta[0]) * gr
                v[n] = beta[1] * v[n] + (1 - beta[1]) * gr * gr
                p[n] = (p[n] - rate * (m[n] / (1 - beta[0] ** step)) / (np.sqrt(v[n] / (1 - beta[1] ** step)) + 1e-8)).astype(np.float32)
        losses.append(loss / len(texts))
    return p


def training_rows(docs: DataFrame, labels: DataFrame, sample: int, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> list[tuple[bytes, float]]:
    """At most ``sample`` labelled texts.  The ids are drawn first, so that only their texts move."""
    drawn = bounded_sample(labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
                           .groupBy(F.col(id_col).alias("doc_id")).agg(F.avg(label_col).alias("label")), "doc_id", sample)
    rows = (keyed_texts(docs, id_col, text_col).join(F.broadcast(drawn), "doc_id")
            .orderBy(F.xxhash64("doc_id"), "text").limit(sample).select("text", "label"))
    return [((r[0] or "").encode("utf-8", "surrogatepass"), float(r[1])) for r in rows.toLocalIterator()]


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, train_docs: DataFrame | None = None,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, score) of every document; learns from ``labels`` of ``train_docs`` (``docs`` if None)."""
    rows = training_rows(docs if train_docs is None else train_docs, labels, sample, id_col, text_col, label_col)
    model = fit([t for t, _ in rows], np.array([y for _, y in rows], np.float32))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for ids, data, offsets in text_groups(batches, GROUP_BYTES):
            y = np.full(len(ids), p["constant"]) if "constant" in p else forward(p, *passages(data, offsets))[0]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(y.astype(np.float64), pa.float64())],
                                             names=["doc_id", "score"])

    return null_ids(keyed_texts(docs, id_col, text_col).mapInArrow(handing_back(run), "doc_id long, score double"))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, unchanged, whose score is at least ``threshold``."""
    rows = training_rows(docs, labels, sample, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(fit([t for t, _ in rows], np.array([y for _, y in rows], np.float32)))

    def judge(p: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return (np.full(len(offsets) - 1, p["constant"]) if "constant" in p else forward(p, *passages(data, offsets))[0]) >= threshold

    return row_filter(docs, text_col, judge, lambda: shared.value)


def held_out(id_col: str = "doc_id") -> Column:
    return crc_bucket(id_col, 5) == 0


def digest(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **kw) -> DataFrame:
    out = score(docs, labels.where(~held_out()), **kw)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
