"""Filter interaction audit: what each of five filters removes under all 120 orders.

A: under 200 words; B: distinct words under half of the words; C: capitals A-Z over 3 % of
the code points; D: a character of ``#$%&*|``; E: the text of a smaller doc_id, byte for byte.

E comes from radix text tries.  Every task first inserts its texts, in groups of
``GROUP_BYTES``, into compressed tries whose terminals hold the smallest id; only the rows
with that id go on, so that a text copied millions of times costs a row a group.  The rest
are dealt by adaptive text prefixes: a range is all texts that begin with one prefix, and a
prefix with more than its share of the bytes is replaced by those of twice its length.
Within a range, tries are filled in text order and closed between different texts when they
hold ``GROUP_BYTES``, so a task's memory does not depend on the size of a range.  Traversal
marks the rows whose id is above the smallest of their terminal.

Each document is then five bits; rows are counted by (part, mask, quality, toxic), and the
120 orders are read from the 32 counts of a part.

Defined cases: null text is empty; null lang and the empty string are one part; a document
without a doc_id is smaller than none and no other is smaller than it, so it never fails E;
rows repeating a doc_id all count, and their copies do not fail E for each other; of several
labels one suffices (quality = 1, toxic = 1); no text has too few code points for C (100 * 0
> 3 * 0 is false); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import apart, discard, stage

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
SYMBOL = re.compile(rb"[#$%&*|]")
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CONTINUES = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that do not begin a code point
COPY = 1 << FILTERS.index("E")

GROUP_BYTES = 1 << 23
# Length of the first prefixes; they double.  A range may hold 1/RANGES of all bytes, or RANGE_BYTES if that
# is more; at most RANGES prefixes of a length lie above it, so the list of them is bounded.
PREFIX = 8
RANGES = 4096
RANGE_BYTES = 1 << 21


class Trie:
    """A compressed trie of byte strings; each terminal holds the smallest id inserted with its string."""

    def __init__(self):
        self.least: list[int | None] = []
        self.root = [b"", {}, -1]  # label, children by first byte, terminal

    def insert(self, text: bytes, number: int) -> int:
        """The terminal of ``text``, made or found; its minimum takes ``number`` in."""
        node, at, end = self.root, 0, len(text)
        while at < end:
            child = node[1].get(text[at])
            if child is None:
                child = [text[at:], {}, -1]
                node[1][text[at]] = child
                node, at = child, end
            elif text.startswith(child[0], at):
                node, at = child, at + len(child[0])
            else:
                shared = _common(child[0], text, at)
                middle = [child[0][:shared], {child[0][shared]: child}, -1]
                child[0] = child[0][shared:]
                node[1][text[at]] = middle
                node, at = middle, at + shared
        if node[2] < 0:
            node[2] = len(self.least)
            self.least.append(number)
        elif number < self.least[node[2]]:
            self.least[node[2]] = number
        return node[2]


def _common(label: bytes, text: bytes, at: int) -> int:
    """Length of the common beginning of ``label`` and ``text[at:]``, which do differ or end within it."""
    n = min(len(label), len(text) - at)
    differ = np.frombuffer(label, np.uint8, n) != np.frombuffer(text, np.uint8, n, at)
    where = int(differ.argmax()) if n else 0
    return where if n and differ[where] else n


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a whole text fails."""
    words = text.split()  # bytes split at 20 and 09-0D only
    points = len(text.translate(None, CONTINUES))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return ((len(words) < LEAST_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > CAPITAL_PERCENT * points) << 2 | (SYMBOL.search(text) is not None) << 3)


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``GROUP_BYTES``."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + GROUP_BYTES, side="right")))
        yield first, last
        first = last


def _batch(doc, part, mask, rows, text, cells) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(part, pa.string()), pa.array(mask, pa.int32()), pa.array(rows, pa.int64()),
         pa.array(text, pa.binary()), pa.array(cells, pa.list_(pa.int64()))], names=["doc_id", "part", "mask", "n", "text", "cells"])


def prefix_cells(text: bytes) -> list[int]:
    """Names of the text's prefixes of PREFIX, 2 PREFIX, ... bytes, up to the first that holds it whole.
    Texts of one range may share a name with others by chance: they are then one range, and tries compare whole texts."""
    import xxhash
    out, size = [], PREFIX
    while True:
        out.append(xxhash.xxh3_64_intdigest(text[:size], len(out)) - (1 << 63))
        if size >= len(text):
            return out
        size *= 2


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, part, mask, n, text, cells): a row with the text for the first of a group's copies, without for the rest."""
    for b in batches:
        texts = b.column(2).fill_null("").cast(pa.binary()).to_pylist()
        ids, parts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for first, last in _groups(np.array([len(t) for t in texts], np.int64)):
            trie, rows, masks, out = Trie(), {}, {}, []
            for i in range(first, last):
                if ids[i] is None:
                    out.append((None, parts[i], failures(texts[i]), 1, None, None))
                    continue
                at = trie.insert(texts[i], ids[i])
                if at not in masks:
                    masks[at] = failures(texts[i])
                alike = rows.setdefault((at, ids[i], parts[i]), [0, i])
                alike[0] += 1
            for (at, doc, part), (n, i) in rows.items():
                if doc == trie.least[at]:
                    out.append((doc, part, masks[at], n, texts[i], prefix_cells(texts[i])))
                else:
                    out.append((doc, part, masks[at] | COPY, n, None, None))
            yield _batch(*zip(*out, strict=True))


def _traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their text: masks with the bit of E, trie by trie."""
    trie, rows, size, last = Trie(), [], 0, None

    def flush():
        at, doc, part, mask, n = zip(*rows, strict=True)
        least = np.array(trie.least, np.int64)[np.array(at)]
        masks = np.array(mask, np.int32) | np.where(np.array(doc, np.int64) > least, COPY, 0).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(part, pa.string()), pa.array(masks, pa.int32()),
                                           pa.array(n, pa.int64())], names=["doc_id", "part", "mask", "n"])

    for b in batches:
        for doc, part, mask, n, text in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
            if rows and text != last and (size > GROUP_BYTES or len(rows) > 1 << 16):
                yield flush()
                trie, rows, size = Trie(), [], 0
            elif len(rows) > 1 << 20:
                # Rows of one text only; its smallest id came first, so what follows needs no more than that.
                yield flush()
                rows = []
            rows.append((trie.insert(text, doc), doc, part, mask, n))
            size += len(text) if text != last else 0
            last = text
    if rows:
        yield flush()


def ranges(judged: DataFrame) -> DataFrame:
    """Rows with their texts, and the range of each: its shortest prefix that is not too heavy."""
    rows = judged.where(F.col("text").isNotNull())
    sizes = rows.select("cells", (F.length("text") + 64).alias("size"))
    share = max(RANGE_BYTES, int(sizes.agg(F.sum("size")).first()[0] or 0) // RANGES)
    prefix = lambda level: F.get("cells", F.lit(level))
    heavy, here = [], sizes
    while True:
        level = len(heavy)
        here = here.where(F.size("cells") > level + 1)  # texts that end with this prefix cannot be dealt any finer
        more = [r["cell"] for r in here.groupBy(prefix(level).alias("cell")).agg(F.sum("size").alias("size"))
                .where(F.col("size") > share).select("cell").limit(RANGES).collect()]
        if not more:
            break
        heavy.append(more)
        here = here.where(prefix(level).isin(more))
    cell = prefix(len(heavy))
    for level in reversed(range(len(heavy))):
        cell = F.when((F.size("cells") > level + 1) & prefix(level).isin(heavy[level]), cell).otherwise(prefix(level))
    return rows.withColumn("cell", cell)


def audit_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask, n): bit k of the mask says that the document fails filter k; n rows alike."""
    judged = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                               F.col(text_col).alias("text"))
                   .mapInArrow(_judge, "doc_id long, part string, mask int, n long, text binary, cells array<long>"), "audit-texts")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    open_ = (ranges(judged).select("doc_id", "part", "mask", "n", "text", "cell").repartition(parts, "cell")
             .sortWithinPartitions("cell", "text", "doc_id").select("doc_id", "part", "mask", "n", "text")
             .mapInArrow(_traverse, "doc_id long, part string, mask int, n long"))
    masks = stage(judged.where(F.col("text").isNull()).select("doc_id", "part", "mask", "n").unionByName(open_), "audit-masks")
    discard(judged)
    return masks


def counts(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(part, mask, n, good, toxic)."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marked = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("of")).agg(one(quality_col).alias("good"), one(toxic_col).alias("bad")))
    each = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return (masks.join(marked.select(apart("of").alias("of"), "good", "bad"), apart("doc_id") == F.col("of"), "left")
            .groupBy("part", "mask").agg(F.sum("n").alias("n"), each("good").alias("good"), each("bad").alias("toxic")))


def _orders() -> tuple[list[str], np.ndarray, np.ndarray]:
    """Names of the orders; for each order and step the filter, and the filters before it as a mask."""
    names = ["".join(p) for p in permutations(FILTERS)]
    which = np.array([[FILTERS.index(c) for c in n] for n in names])
    return names, which, np.cumsum(1 << which, axis=1) - (1 << which)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """600 rows for each part with its 32 counts."""
    names, which, before = _orders()
    masks = np.arange(1 << len(FILTERS))
    gone = (masks & before[:, :, None]) > 0
    fails = (masks >> which[:, :, None] & 1) > 0
    orders, steps = which.shape
    for b in batches:
        for part, table in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            count = np.zeros((len(masks), 3), np.int64)
            for row in table:
                count[row["mask"]] = row["n"], row["good"], row["toxic"]
            n, good, toxic = count.T
            removed = (fails & ~gone) @ n
            shapley = np.bincount(which.ravel(), removed.ravel(), len(FILTERS)).astype(np.int64)
            columns = {"kept": (~gone & ~fails) @ n, "removed": removed, "redundant": (fails & gone) @ n,
                       "unique_fails": n[1 << which], "good_lost": (fails & ~gone) @ good, "toxic_lost": (fails & ~gone) @ toxic,
                       "shapley": shapley[which]}
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * (orders * steps), pa.string()), pa.array(np.repeat(names, steps).tolist(), pa.string()),
                 pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), orders)), *(pa.array(c.ravel(), pa.int64()) for c in columns.values())],
                names=["part", "filter_order", "step", *columns])


def audit(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """One row per part, order of the filters and step."""
    tables = (counts(audit_masks(docs, **kw), labels).groupBy("part")
              .agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts")))  # 32 at most
    longs = ", ".join(f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return tables.mapInArrow(_report, f"part string, filter_order string, step int, {longs}")
