"""Substring dedup by recompression: every word in a window of ``window`` words that starts earlier goes.

A document is a sequence of words.  Each round renames it globally and shorter:
maximal runs of one symbol become (symbol, length), then each adjacent pair
whose left symbol falls in the left half of a split of the alphabet and whose
right symbol falls in the right half becomes one symbol.  A new name is a hash
of what it stands for and the split is a bit of the name, so every task names
alike, and equal substrings have equal symbols inside, whatever stands around
them.  Along with each symbol goes the span of words that decided its shape: a
window that contains the span contains the symbol wherever it occurs.

Each window takes as anchor, of the symbols that it decides, one of the highest
round (the smallest by hash; words themselves are round 0, so there always is
one).  Shared anchors reveal repeats (see ``repeats``), and the windows of the
pieces they bring together are verified word by word.

Defined cases: a null text has no words; texts of fewer words than a window keep
them all; rows repeating a doc_id are the same document read twice, never copies
of each other; a null doc_id sorts before all others; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.llm import repeats as R
from icuflow.llm.common import handing_back, keyed_texts, null_ids, starts_of, text_groups

WINDOW = 20
# More rounds make longer symbols, but the spans that decide them widen faster: with windows of 20
# words, two rounds give one anchor for 6 words, four one for 2.5.
ROUNDS = 2
SPACES = (32, 9, 10, 11, 12, 13)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_CODES = R.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word in a group of texts, and its text; words never cross texts."""
    gap = _IS_SPACE[data]
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a text's first byte begins a word, its end ends one
    begins = np.flatnonzero(~gap & (edge[:n] | np.concatenate([[True], gap[:-1]])))
    ends = np.flatnonzero(~gap & (edge[1:] | np.concatenate([gap[1:], [True]]))) + 1
    return begins, ends, np.searchsorted(offsets, begins, side="right") - 1


def word_codes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return R.word_names(_CODES[data], begins, ends)


class Level:
    """Symbols of a group: name, document, and the half-open span of words that decided the symbol's shape."""

    def __init__(self, name, doc, first, last, low, high):
        self.name, self.doc, self.first, self.last, self.low, self.high = name, doc, first, last, low, high


def _neighbours(x: Level) -> tuple[np.ndarray, np.ndarray]:
    """What the neighbours' shapes depend on; beyond a document's ends lies a place outside all windows."""
    n = len(x.name)
    before, after = np.empty(n, np.int64), np.empty(n, np.int64)
    before[1:], after[:-1] = x.low[:-1], x.high[1:]
    edge = np.ones(n, bool)
    edge[1:] = x.doc[1:] != x.doc[:-1]
    before[edge] = -(1 << 40)
    after[np.concatenate([edge[1:], [True]])] = 1 << 40
    return before, after


def compress(x: Level, round_: int) -> Level:
    """One round: runs, then pairs."""
    n = len(x.name)
    if n == 0:
        return x
    # Runs: a symbol's run is decided by both neighbours of the run.
    before, after = _neighbours(x)
    new = np.ones(n, bool)
    new[1:] = (x.name[1:] != x.name[:-1]) | (x.doc[1:] != x.doc[:-1])
    cut = np.flatnonzero(new)
    end = np.concatenate([cut[1:], [n]]) - 1
    size = (end - cut + 1).astype(np.uint64)
    name = np.where(size > 1, R.mix(x.name[cut] ^ R.mix(size + np.uint64(1000 * round_ + 1))), x.name[cut])
    x = Level(name, x.doc[cut], x.first[cut], x.last[end], np.minimum(x.low[cut], before[cut]), np.maximum(x.high[end], after[end]))
    # Pairs: left and right halves by a bit of the name, another one each round.
    n = len(x.name)
    before, after = _neighbours(x)
    right = ((R.mix(x.name + np.uint64(round_)) >> np.uint64(63)) == 1)
    joined = np.zeros(n, bool)
    joined[:-1] = ~right[:-1] & right[1:] & (x.doc[:-1] == x.doc[1:])
    second = np.concatenate([[False], joined[:-1]])
    low, high = x.low.copy(), x.high.copy()
    alone_right, alone_left = right & ~second, ~right & ~joined
    low[alone_right] = np.minimum(low, before)[alone_right]  # nothing to its left took it
    high[alone_left] = np.maximum(high, after)[alone_left]
    at = np.flatnonzero(joined)
    name, last = x.name.copy(), x.last.copy()
    name[at] = R.mix(R.mix(x.name[at] + np.uint64(7)) * np.uint64(3) + x.name[at + 1])
    last[at], low[at], high[at] = x.last[at + 1], np.minimum(low[at], low[at + 1]), np.maximum(high[at], high[at + 1])
    keep = ~second
    # Spans of decisions grow from left to right; this keeps them in order for the search below.
    return Level(name[keep], x.doc[keep], x.first[keep], last[keep], low[keep], high[keep])


def choose_anchors(levels: list[Level], starts: np.ndarray, window: int, words: R.Hashes) -> tuple[np.ndarray, np.ndarray]:
    """For each window start: place and name of its anchor, from the highest round that has one.  An
    anchor's name is its symbol together with the words that decided it, which the window contains."""
    place = np.full(len(starts), -1, np.int64)
    name = np.zeros(len(starts), np.uint64)
    todo = np.arange(len(starts))
    for depth in range(len(levels) - 1, -1, -1):
        x = levels[depth]
        ok = np.flatnonzero(x.high - x.low <= window)
        if len(ok) == 0 or len(todo) == 0:
            continue
        low, high = x.low[ok], x.high[ok]
        names = R.mix(x.name[ok] + np.uint64(depth)) ^ words.of(low, high, 3)
        p = starts[todo]
        a, z = np.searchsorted(low, p, side="left"), np.searchsorted(high, p + window, side="right")
        has = z > a
        a, z, w = a[has], z[has], todo[has]
        if len(a):
            # The least of names[a:z] by a table of minima over 1, 2, 4, ... symbols; ties go to the left.
            bits = np.uint64((1 << 22) - 1)
            table = [(names & ~bits) | np.arange(len(names), dtype=np.uint64)]
            width = z - a
            while (1 << len(table)) <= int(width.max()):
                half = 1 << (len(table) - 1)
                table.append(np.minimum(table[-1][:-half], table[-1][half:]))
            k = np.floor(np.log2(width)).astype(np.int64)
            best = np.empty(len(a), np.uint64)
            for level in np.unique(k):
                m = k == level
                best[m] = np.minimum(table[level][a[m]], table[level][z[m] - (1 << level)])
            j = (best & bits).astype(np.int64)
            place[w], name[w] = x.first[ok][j] * (len(levels) + 1) + depth, names[j]
            todo = todo[~has]
    return place, name


def anchors(window: int = WINDOW, rounds: int = ROUNDS):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, offsets in text_groups(batches, R.SEGMENT):
            begins, ends, doc = word_bounds(data, offsets)
            if len(begins) < window:
                continue
            codes = word_codes(data, begins, ends)
            first_word = np.searchsorted(doc, np.arange(len(ids)), side="left")
            # A very long text goes in segments of words whose windows do not overlap.
            for a in range(0, len(begins), R.SEGMENT):
                z = min(len(begins), a + R.SEGMENT + window - 1)
                c, d = codes[a:z], doc[a:z]
                n = len(c)
                if n < window:
                    continue
                at = np.arange(n)
                levels = [Level(c, d, at, at + 1, at, at + 1)]
                for r in range(rounds):
                    levels.append(compress(levels[-1], r + 1))
                starts = np.flatnonzero(d[:n - window + 1] == d[window - 1:])
                hashes = R.Hashes(c)
                place, name = choose_anchors(levels, starts, window, hashes)
                # One number for each anchor's place, so that the frame can tell where it changes.
                unique, at_place = np.unique(place, return_inverse=True)
                value = np.zeros(len(unique), np.uint64)
                value[at_place] = name
                yield R.anchor_rows(at_place, starts, value, hashes, d, window, ids, a - first_word)
    return run


def cut(window: int = WINDOW):
    def run(text: bytes, start: np.ndarray, n: np.ndarray) -> list[bytes]:
        data = np.frombuffer(text, np.uint8)
        begins, ends, _ = word_bounds(data, np.array([0, len(data)]))
        out = []
        for s, k in zip(start.tolist(), n.tolist(), strict=True):
            z = min(s + k + window - 2, len(begins) - 1)
            out.append(b" ".join(text[begins[s]:ends[z]].split()) if s <= z else b"")  # ASCII white space only
        return out
    return run


def compare(window: int = WINDOW):
    """Verify the windows of each anchor's pieces word by word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, {}
        for b in batches:
            cols = [b.column(b.schema.get_field_index(k)).to_pylist() for k in ("h", "doc_id", "start", "piece")]
            docs, firsts, lasts = [], [], []
            for h, d, s, p in zip(*cols, strict=True):
                if h != now:
                    now, seen = h, {}
                words = p.split()
                for k in range(len(words) - window + 1):
                    w = b" ".join(words[k:k + window])
                    if seen.setdefault(w, (d, s + k)) != (d, s + k):
                        if docs and docs[-1] == d and firsts[-1] <= s + k <= lasts[-1]:
                            lasts[-1] = s + k + window
                        else:
                            docs.append(d)
                            firsts.append(s + k)
                            lasts.append(s + k + window)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (docs, firsts, lasts)], names=["doc_id", "first", "last"])
    return run


def windows_of(window: int = WINDOW):
    def run(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(piece, np.uint8)
        begins, ends, _ = word_bounds(data, np.array([0, len(data)]))
        codes = word_codes(data, begins, ends)
        at = np.arange(max(0, len(codes) - window + 1))
        return R.Hashes(codes).of(at, at + window, 1), R.Hashes(R.mix(codes + np.uint64(77))).of(at, at + window, 2)
    return run


def dedup(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per document: n_words, n_removed, removed (runs of words) and kept (the other words joined by a space)."""
    texts = keyed_texts(docs, id_col, text_col)
    spans = R.repeated_spans(texts, anchors(window, rounds), cut(window), compare(window), windows_of(window), window, "substring")
    both = texts.join(spans.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "spans")
    pair = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, runs, kept = [], [], [], []
            for i in range(b.num_rows):
                words = (b.column(1)[i].as_py() or "").encode("utf-8", "surrogatepass").split()
                found = b.column(2)[i].values
                total.append(len(words))
                if found is None or len(found) == 0:
                    gone.append(0)
                    runs.append([])
                    kept.append(b" ".join(words))
                    continue
                first, last = R.merge_spans(found.field(0).to_numpy(), found.field(1).to_numpy())
                last = np.minimum(last, len(words))
                gone.append(int((last - first).sum()))
                runs.append([{"first": a, "last": z} for a, z in zip(first.tolist(), last.tolist(), strict=True)])
                left, at = [], 0
                for a, z in zip(first.tolist(), last.tolist(), strict=True):
                    left += words[at:a]
                    at = z
                kept.append(b" ".join(left + words[at:]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pair), pa.array(kept, pa.binary())],
                names=["doc_id", "n_words", "n_removed", "removed", "kept"])

    return null_ids(both.mapInArrow(handing_back(run), "doc_id long, n_words long, n_removed long, removed array<struct<first:long,last:long>>, kept binary"))


def digest(docs: DataFrame, **kw) -> DataFrame:
    return dedup(docs, **kw).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
