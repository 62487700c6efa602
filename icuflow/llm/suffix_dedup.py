"""Suffix-array dedup: every byte covered by a string of ``window`` bytes that starts earlier goes.

Texts are UTF-8 bytes; matches never cross documents; (doc_id, start) gives the
order; all windows are judged on the input.  Windows are dealt by content (see
``repeats``): of the ``GRAM``-byte grams in a window, the one with the smallest
hash is its anchor.  The pieces of an anchor are concatenated and their suffix
array is built by two-stage sorting: only the suffixes smaller than their
successors are sorted directly (to the window's depth), the others are induced
by scanning the buckets of first bytes in order; adjacent common prefixes of at
least the window's length are the repeats.

Defined cases: a null text is empty; texts shorter than a window keep all their
bytes; rows repeating a doc_id are the same document read twice, never copies of
each other; a null doc_id sorts before all others; an empty table gives an empty
result; other columns are ignored.  In ``keep``, bytes of a character cut apart
go with the removed run, and a document of which nothing is left goes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.llm import repeats as R
from icuflow.llm.common import NULL_ID, handing_back, keyed_texts, null_ids, starts_of

WINDOW = 100
GRAM = 24
# Pieces of whole groups are sorted together up to about this many bytes.
SORT_BYTES = 1 << 18


def _byte_codes(data: np.ndarray) -> np.ndarray:
    return _CODES[data]


_CODES = R.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each run of ``width`` values, by doubling."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def anchors(window: int = WINDOW, gram: int = GRAM):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, base, data, offsets in R.segments(batches, window - 1):
            n = len(data)
            if n < window:
                continue
            owner = starts_of(offsets)
            hashes = R.Hashes(_byte_codes(data))
            at = np.arange(n - gram + 1)
            g = hashes.of(at, at + gram)
            low = np.uint64((1 << 21) - 1)  # a group is shorter than 2^21 bytes
            picked = sliding_min((g & ~low) | at.astype(np.uint64), window - gram + 1) & low
            starts = np.flatnonzero(owner[:n - window + 1] == owner[window - 1:])
            yield R.anchor_rows(picked[starts].astype(np.int64), starts, g, hashes, owner, window, ids, base - offsets[:-1])
    return run


def cut(window: int = WINDOW):
    return lambda text, start, n: [text[s:s + k + window - 1] for s, k in zip(start.tolist(), n.tolist(), strict=True)]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes, by two-stage sorting.

    ``text`` holds bytes of 1 and more, and 0 only as a separator.  A suffix is of
    type S if it is smaller than its successor (equal bytes: as the successor),
    else of type L; the end of the text is smaller than everything.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    after = np.concatenate([text[1:], [0]]).astype(np.int16)
    step = np.sign(after - text)
    # Equal bytes take the type of the next place where the bytes differ.
    change = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(change[::-1])[::-1]
    is_s = np.where(following < n, step[np.minimum(following, n - 1)] > 0, False)
    small = np.flatnonzero(is_s)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    if len(small):
        # Direct sort, 8 bytes at a time: only ties go on to the next 8.
        words = np.zeros(len(padded) - 7, np.uint64)
        for k in range(8):
            words = (words << np.uint64(8)) | padded[k:k + len(words)].astype(np.uint64)
        order = small[np.argsort(words[small], kind="stable")]
        key = words[order]
        group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]]))
        for at in range(8, depth, 8):
            size = np.bincount(group)
            tied = size[group] > 1
            if not tied.any():
                break
            where = np.flatnonzero(tied)
            sub, g = order[where], group[where]
            w = words[np.minimum(sub + at, len(words) - 1)]
            again = np.lexsort((w, g))
            order[where] = sub[again]
            new = np.ones(len(order), bool)
            new[1:] = group[1:] != group[:-1]
            w, g = w[again], g[again]
            new[where[1:]] |= (w[1:] != w[:-1]) & (g[1:] == g[:-1])
            group = np.cumsum(new)
        small = order
    # Buckets by first byte: the L part is filled from smaller buckets, the S part is sorted already.
    s_bounds = np.searchsorted(text[small], np.arange(257))
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    if not is_s[n - 1]:
        buckets[text[n - 1]].append(np.array([n - 1]))  # its successor is the end, the smallest of all
    out = []

    def pass_on(entries: np.ndarray, c: int) -> np.ndarray:
        """Predecessors of type L: into their buckets; those in bucket c itself are returned."""
        prev = entries[entries > 0] - 1
        prev = prev[~is_s[prev]]
        first = text[prev]
        mine = prev[first == c]
        other, first = prev[first != c], first[first != c]
        order = np.argsort(first, kind="stable")
        other, first = other[order], first[order]
        heads = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else np.zeros(0, np.int64)
        for a, z in itertools.pairwise([*heads.tolist(), len(first)]):
            buckets[first[a]].append(other[a:z])
        return mine

    for c in range(256):
        wave = np.concatenate(buckets[c]) if buckets[c] else np.zeros(0, np.int64)
        while len(wave):  # runs of the byte c: each wave is one byte longer
            out.append(wave)
            wave = pass_on(wave, c)
        s_part = small[s_bounds[c]:s_bounds[c + 1]]
        if len(s_part):
            out.append(s_part)
            pass_on(s_part, c)
    return np.concatenate(out)


def adjacent_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, up to ``depth``."""
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    out = np.zeros(len(order), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(padded, depth)
    for k in range(1, len(order), 1 << 14):
        same = view[order[k:k + (1 << 14)]] == view[order[k - 1:k - 1 + len(order[k:k + (1 << 14)])]]
        out[k:k + len(same)] = np.where(same.all(1), depth, np.argmin(same, 1))
    return out


def repeats_in(pieces: list[bytes], docs: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start) of the windows of some pieces, sorted by (anchor, doc, start), that also start earlier."""
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)  # 0xff is no byte of UTF-8: it becomes 0
    sizes = np.array([len(p) for p in pieces])
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    at = np.arange(len(text)) - begin[piece]
    order = suffix_array(text, window)
    order = order[at[order] + window <= sizes[piece[order]]]
    same = adjacent_prefixes(text, order, window) >= window
    run = np.cumsum(~same)
    p, place = piece[order], at[order]
    doc, start = docs[p], starts[p] + place
    by = np.lexsort((start, doc, run))
    run, doc, start = run[by], doc[by], start[by]
    head = np.maximum.accumulate(np.where(np.concatenate([[True], run[1:] != run[:-1]]), np.arange(len(run)), 0)) if len(run) else run
    later = (doc != doc[head]) | (start != start[head])
    return doc[later], start[later]


def compare(window: int = WINDOW):
    def spans(pieces, docs, starts):
        doc, start = repeats_in(pieces, np.array(docs, np.int64), np.array(starts, np.int64), window)
        order = np.lexsort((start, doc))
        doc, start = doc[order], start[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
        cuts = np.flatnonzero(new)
        ends = np.concatenate([cuts[1:], [len(doc)]]) - 1 if len(cuts) else cuts
        return pa.RecordBatch.from_arrays([R.long_array(doc[cuts]), R.long_array(start[cuts]), R.long_array(start[ends] + window)],
                                          names=["doc_id", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, docs, starts, size, now = [], [], [], 0, None
        for b in batches:
            for h, d, s, p in zip(*(b.column(b.schema.get_field_index(k)).to_pylist() for k in ("h", "doc_id", "start", "piece")), strict=True):
                if h != now and size > SORT_BYTES:
                    yield spans(pieces, docs, starts)
                    pieces, docs, starts, size = [], [], [], 0
                now = h
                pieces.append(p)
                docs.append(d)
                starts.append(s)
                size += len(p)
        if pieces:
            yield spans(pieces, docs, starts)
    return run


def windows_of(window: int = WINDOW):
    def run(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(piece, np.uint8)
        at = np.arange(max(0, len(data) - window + 1))
        one, two = R.Hashes(_byte_codes(data)), R.Hashes(R.mix(_byte_codes(data) + np.uint64(77)))
        return one.of(at, at + window, 1), two.of(at, at + window, 2)
    return run


def removed_spans(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    return R.repeated_spans(texts, anchors(window, gram), cut(window), compare(window), windows_of(window), window, "suffix")


def _kept(text: bytes, spans) -> tuple[bytes, int, int]:
    """What is left, bytes removed, runs removed."""
    if spans is None or len(spans) == 0:
        return text, 0, 0
    first, last = R.merge_spans(spans.field(0).to_numpy(), spans.field(1).to_numpy())
    last = np.minimum(last, len(text))
    keep, at = [], 0
    for a, z in zip(first.tolist(), last.tolist(), strict=True):
        keep.append(text[at:a])
        at = z
    return b"".join([*keep, text[at:]]), int((last - first).sum()), len(first)


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary)."""
    texts = keyed_texts(docs, id_col, text_col)
    spans = removed_spans(texts, window, gram)
    both = texts.join(spans.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                text = (b.column(1)[i].as_py() or "").encode("utf-8", "surrogatepass")
                rows.append((len(text), *_kept(text, b.column(2)[i].values)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                 pa.array([r[3] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return null_ids(both.mapInArrow(handing_back(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))


def digest(docs: DataFrame, **kw) -> DataFrame:
    return dedup(docs, **kw).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def keep(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
         length_col: str | None = None) -> DataFrame:
    """The documents with their repeated bytes removed; ``length_col``, if given, gets the new length in characters.
    Documents that lose everything go."""
    spans = removed_spans(keyed_texts(docs, id_col, text_col), window, gram).withColumnsRenamed({"doc_id": "_span_doc", "spans": "_spans"})
    at = docs.columns.index(text_col)
    both = docs.join(spans.hint("shuffle_hash"), F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)) == spans["_span_doc"], "left").drop("_span_doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new, stays = [], []
            for i in range(b.num_rows):
                old, found = b.column(at)[i].as_py(), b.column(b.num_columns - 1)[i].values
                if old is None or found is None:
                    new.append(old)
                    stays.append(True)
                else:
                    left = _kept(old.encode("utf-8", "surrogatepass"), found)[0].decode("utf-8", "ignore")
                    new.append(left)
                    stays.append(bool(left))
            columns = [b.column(k) for k in range(b.num_columns - 1)]
            columns[at] = pa.array(new, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names[:-1]).filter(pa.array(stays, pa.bool_()))

    out = both.mapInArrow(handing_back(run), docs.schema)
    if length_col:
        out = out.withColumn(length_col, F.coalesce(F.char_length(text_col).cast(docs.schema[length_col].dataType), F.col(length_col)))
    return out
