"""Shared frame of the two operators that remove passages occurring earlier in the corpus.

Both ask the same thing of sequences (bytes or words): which windows of a fixed
length also start earlier, by (doc_id, start)?  Each operator names its windows'
*anchors*: every window picks one anchor inside itself by its content alone, so
equal windows pick equal anchors.  Consecutive windows of a document with the
same anchor form a *piece*.  A row per piece carries the anchor, a hash of the
piece's content and its place, not the text.

1. Rows are dealt by anchor and sorted.  A piece equal to an earlier one repeats
   throughout; an anchor with one distinct piece matches nothing else.  Both are
   settled in a stream over the sorted rows, which holds no group.
2. Only the first copies of pieces whose anchor has other pieces fetch their
   text and are compared window by window, by the operator's own method.
3. An anchor with more than ``GROUP_PIECES`` distinct pieces is not gathered:
   its windows are compared one by one, as an aggregation by a 128-bit hash of
   the window that Spark combines before the shuffle.
4. Anchors that a sample shows to be frequent (they would fill a ``HOT_SHARE``-th of a
   shuffle partition, so there are at most ``HOT_SHARE`` for each) are pre-aggregated by piece and joined back, so that no task
   gets all rows of an anchor.  The sample decides on this route only; the
   result is the same by either.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import apart, discard, handing_back, stage, text_groups

HOT_SHARE = 2
HOT_SAMPLE = 64
HOT_LEAST = 16
GROUP_PIECES = 10_000
# Bytes (words) whose windows a task names at a time.  The arrays are some 60 times as large, in each Python worker.
SEGMENT = 1 << 18
ROW_SCHEMA = "h long, ph long, doc_id long, start long, n int"
SETTLED_SCHEMA = "kind int, h long, doc_id long, start long, n int"
PIECE_SCHEMA = "kind int, h long, doc_id long, start long, n int, piece binary"
SPAN_SCHEMA = "doc_id long, first long, last long"
REPEAT, COMPARE, LARGE = 0, 1, 2

# An odd multiplier and its inverse modulo 2^64, for prefix hashes of substrings.
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _powers[int(base)] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_names(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, salt: int = 5) -> np.ndarray:
    """64-bit names of the words [begins, ends) of a byte sequence (``codes``: a number per byte).

    A name adds up a random number for each (byte, place in the word).  Unlike a sum of powers
    modulo 2^64, whose Thue-Morse words are equal for any base, this has no words that are
    equal by construction, however long they are.
    """
    sizes = ends - begins
    total = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    place = np.arange(total, dtype=np.int64) - np.repeat(first, sizes)
    at = place + np.repeat(begins, sizes)
    values = mix(codes[at] + mix_places(place))
    sums = np.zeros(total + 1, np.uint64)
    np.cumsum(values, dtype=np.uint64, out=sums[1:])
    return mix(sums[first + sizes] - sums[first] + mix(sizes.astype(np.uint64) + np.uint64(salt)))


def mix_places(place: np.ndarray) -> np.ndarray:
    """A random number per place, from a table for the common ones."""
    top = int(place.max(initial=0)) + 1
    have = _powers.get(-1)
    if have is None or len(have) < top:
        _powers[-1] = have = mix(np.arange(1, max(top, 1 << 10) + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return have[place]


class Hashes:
    """Hashes of any substrings of a sequence of 64-bit codes, from prefix sums: for substrings of a few hundred
    codes at most.  (Sums of powers modulo 2^64 have Thue-Morse collisions from 1,024 codes on.)"""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * powers(BASE, n), dtype=np.uint64, out=self.sums[1:])

    def of(self, first: np.ndarray, last: np.ndarray, salt: int = 0) -> np.ndarray:
        raw = (self.sums[last] - self.sums[first]) * powers(UNBASE, len(self.sums))[first]
        return mix(raw + mix((last - first).astype(np.uint64) + np.uint64(salt)))


def segments(batches: Iterator[pa.RecordBatch], overlap: int, size: int = SEGMENT
             ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, bases, bytes, offsets) of groups of texts; a text beyond ``size`` bytes comes in
    segments that overlap by ``overlap`` bytes, so that every window lies in just one of them."""
    for ids, data, offsets in text_groups(batches, size):
        if len(ids) == 1 and len(data) > size:
            for base in range(0, len(data), size):
                part = data[base:base + size + overlap]
                yield ids, np.array([base]), part, np.array([0, len(part)])
        else:
            yield ids, np.zeros(len(ids), np.int64), data, offsets


def long_array(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def anchor_rows(anchor_at: np.ndarray, starts: np.ndarray, anchor: np.ndarray, hashes: Hashes, owner: np.ndarray,
                window: int, ids: np.ndarray, base: np.ndarray) -> pa.RecordBatch:
    """Rows of ``ROW_SCHEMA``.  anchor_at: place of the anchor of each window; starts: the windows' starts
    (ascending); anchor: the anchors' hashes by place; base: added to a start to give its place in the document."""
    if len(starts) == 0:
        cut = np.zeros(0, np.int64)
    else:
        new = np.ones(len(starts), bool)
        new[1:] = (anchor_at[1:] != anchor_at[:-1]) | (starts[1:] != starts[:-1] + 1) | (owner[starts[1:]] != owner[starts[:-1]])
        cut = np.flatnonzero(new)
    n = np.diff(np.concatenate([cut, [len(starts)]])) if len(cut) else np.zeros(0, np.int64)
    s = starts[cut]
    return pa.RecordBatch.from_arrays(
        [long_array(anchor[anchor_at[cut]]), long_array(hashes.of(s, s + n + window - 1)), long_array(ids[owner[s]]),
         long_array(s + base[owner[s]]), pa.array(n.astype(np.int32), pa.int32())], names=["h", "ph", "doc_id", "start", "n"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, ph, doc_id, start): repeats, and first copies whose anchor has other pieces."""
    def out(kind, h, doc, start, n):
        return pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(np.int32(kind), h.shape).astype(np.int32), pa.int32()), long_array(h),
                                           long_array(doc), long_array(start), pa.array(n, pa.int32())],
                                          names=["kind", "h", "doc_id", "start", "n"])

    held = tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.int32),)  # first copies of an anchor not yet ended
    last = None  # first copy of the piece that the previous batch ended in
    large = None  # anchor known to have too many pieces
    for b in batches:
        if b.num_rows == 0:
            continue
        h, ph, doc, start = (b.column(k).to_numpy() for k in range(4))
        n = b.column(4).to_numpy()
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (ph[1:] != ph[:-1])
        carried = last is not None and last[0] == h[0] and last[1] == ph[0]
        new[0] = not carried
        first = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))  # -1: in the previous batch
        f_doc = np.where(first >= 0, doc[first], last[2] if carried else 0)
        f_start = np.where(first >= 0, start[first], last[3] if carried else 0)
        again = ~new & ((doc != f_doc) | (start != f_start))  # the same place twice is one row read twice
        if again.any():
            yield out(REPEAT, h[again], doc[again], start[again], n[again])
        last = (h[-1], ph[-1], f_doc[-1], f_start[-1])
        fh, fd, fs, fn = (np.concatenate([a, x[new]]) for a, x in zip(held, (h, doc, start, n), strict=True))
        if large is not None:
            more = fh == large
            if more.any():
                yield out(LARGE, fh[more], fd[more], fs[more], fn[more])
                fh, fd, fs, fn = (x[~more] for x in (fh, fd, fs, fn))
        if len(fh) == 0:
            held = (fh, fd, fs, fn)
            continue
        cut = np.flatnonzero(np.concatenate([[True], fh[1:] != fh[:-1]]))
        size = np.diff(np.concatenate([cut, [len(fh)]]))
        each = np.repeat(size, size)
        open_from = cut[-1]
        if size[-1] > GROUP_PIECES:
            large, open_from = fh[-1], len(fh)
        done = np.arange(len(fh)) < open_from
        for kind, pick in ((COMPARE, done & (each > 1) & (each <= GROUP_PIECES)), (LARGE, done & (each > GROUP_PIECES))):
            if pick.any():
                yield out(kind, fh[pick], fd[pick], fs[pick], fn[pick])
        held = tuple(x[open_from:] for x in (fh, fd, fs, fn))
    if len(held[0]) > 1:
        yield out(COMPARE, *held)


def settle(rows: DataFrame) -> DataFrame:
    """Rows of ``SETTLED_SCHEMA``: repeats to remove, and pieces still to compare."""
    sampled = rows.where(F.pmod(F.xxhash64("doc_id", "start"), F.lit(HOT_SAMPLE)) == 0)
    counts = sampled.groupBy("h").agg(F.count("*").alias("rows"))
    total = sampled.count()
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = HOT_SHARE * parts  # keys with 1/most of the sampled rows or more: never more than that many
    hot = [r["h"] for r in counts.where(F.col("rows") >= max(HOT_LEAST, total / most)).select("h").limit(most).collect()]
    is_hot = F.col("h").isin(hot) if hot else F.lit(False)
    cold = rows.where(~is_hot)
    out = (cold.repartition(parts, "h").sortWithinPartitions("h", "ph", "doc_id", "start").mapInArrow(handing_back(_settle), SETTLED_SCHEMA))
    if not hot:
        return out
    firsts = stage(rows.where(is_hot).groupBy("h", "ph").agg(F.min(F.struct("doc_id", "start", "n")).alias("f")), "repeats-hot")
    again = (rows.where(is_hot).join(firsts.withColumnsRenamed({"h": "fh", "ph": "fph"}), (F.col("h") == F.col("fh")) & (F.col("ph") == F.col("fph")))
             .where(F.struct("doc_id", "start") > F.struct("f.doc_id", "f.start")))
    pieces = firsts.groupBy("h").agg(F.count("*").alias("pieces")).where("pieces > 1").select(apart("h").alias("ch"), "pieces")
    firsts = (firsts.join(pieces, apart("h") == F.col("ch"))
              .select(F.when(F.col("pieces") > GROUP_PIECES, LARGE).otherwise(COMPARE).alias("kind"), "h", "f.doc_id", "f.start", "f.n"))
    return out.unionByName(again.select(F.lit(REPEAT).alias("kind"), "h", "doc_id", "start", "n")).unionByName(firsts)


def fetch(texts: DataFrame, settled: DataFrame, cut: Callable) -> DataFrame:
    """The content of the pieces still to compare, cut from their documents by ``cut(text bytes, starts, lengths)``."""
    wanted = (settled.where(F.col("kind") != REPEAT).groupBy("doc_id")
              .agg(F.collect_list(F.struct("kind", "h", "start", "n")).alias("wanted")))
    pairs = texts.join(wanted.hint("shuffle_hash"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                text = (b.column(1)[i].as_py() or "").encode("utf-8", "surrogatepass")
                w = b.column(2)[i].values
                kind, h, start, n = (w.field(k).to_numpy() for k in range(4))
                for k in range(0, len(start), 4096):
                    part = slice(k, k + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(kind[part]), pa.array(h[part]), pa.array(np.full(len(h[part]), b.column(0)[i].as_py()), pa.int64()),
                         pa.array(start[part]), pa.array(n[part]), pa.array(cut(text, start[part], n[part]), pa.binary())],
                        names=["kind", "h", "doc_id", "start", "n", "piece"])

    return pairs.select("doc_id", "text", "wanted").mapInArrow(handing_back(run), PIECE_SCHEMA)


def large_spans(pieces: DataFrame, windows_of: Callable, window: int) -> DataFrame:
    """Windows of anchors with too many pieces to gather, by an aggregation on the window itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                w1, w2 = windows_of(b.column(2)[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [long_array(w1), long_array(w2), pa.array(np.full(len(w1), b.column(0)[i].as_py()), pa.int64()),
                     pa.array(b.column(1)[i].as_py() + np.arange(len(w1)), pa.int64())], names=["w1", "w2", "doc_id", "start"])

    rows = (pieces.where(F.col("kind") == LARGE).select("doc_id", "start", "piece")
            .mapInArrow(handing_back(run), "w1 long, w2 long, doc_id long, start long"))
    first = (rows.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "start")).alias("f"), F.count("*").alias("rows"))
             .where("rows > 1").select(apart("w1").alias("f1"), F.col("w2").alias("f2"), "f"))
    return (rows.join(first, (apart("w1") == F.col("f1")) & (F.col("w2") == F.col("f2")))
            .where(F.struct("doc_id", "start") > F.col("f"))
            .select("doc_id", F.col("start").alias("first"), (F.col("start") + window).alias("last")))


def merge_spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans, sorted."""
    if len(first) == 0:
        return first, last
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > reach[:-1]
    cut = np.flatnonzero(new)
    return first[cut], reach[np.concatenate([cut[1:], [len(first)]]) - 1]


def repeated_spans(texts: DataFrame, anchors: Callable, cut: Callable, compare: Callable, windows_of: Callable,
                   window: int, name: str) -> DataFrame:
    """Per document the list of spans covered by windows that start earlier elsewhere (may overlap)."""
    rows = stage(texts.mapInArrow(handing_back(anchors), ROW_SCHEMA), f"{name}-anchors")
    settled = stage(settle(rows), f"{name}-settled")
    discard(rows)
    pieces = stage(fetch(texts, settled, cut), f"{name}-pieces")
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    compared = (pieces.where(F.col("kind") == COMPARE).repartition(parts, "h")
                .sortWithinPartitions("h", "doc_id", "start").mapInArrow(handing_back(compare), SPAN_SCHEMA))
    repeats = settled.where(F.col("kind") == REPEAT).select(
        "doc_id", F.col("start").alias("first"), (F.col("start") + F.col("n") + (window - 1)).alias("last"))
    spans = repeats.unionByName(compared).unionByName(large_spans(pieces, windows_of, window))
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
