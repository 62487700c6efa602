"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Normalisation lower-cases A-Z and keeps words of digits, ASCII letters and all
non-ASCII bytes.  It maps bytes one to one, so a word's place in the normalised
text is its place in the original.  A window is ``window`` consecutive words of
an item; an item with fewer words, but not none, is one window.  The automaton
holds every window once, between spaces, and each text is scanned once.

Defined cases: a null or empty text or item has no words and hits nothing; rows
with equal ids are judged one by one; repeated items share their windows; with
an empty benchmark nothing is hit; an empty table gives an empty result.  Other
columns of either table are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from icuflow.llm.common import discard, handing_back, keyed_texts, null_ids, stage

WINDOW = 13
# An automaton holds the windows of at most this many item words; a larger benchmark is dealt
# into shards by Spark and scanned shard by shard, each pass over the written result of the last.
AUTOMATON_WORDS = 2_000_000

_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")

SCAN_SCHEMA = ("doc_id long, n_words long, word_runs array<struct<first:long,last:long>>, "
               "items array<string>, spans array<struct<start:long,end:long>>")


def normalise(text: str | bytes | None) -> bytes:
    return (text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")).translate(_NORMAL)


def item_windows(text: str | None, window: int = WINDOW) -> list[bytes]:
    words = normalise(text).split()
    if not words:
        return []
    return [b" ".join(words[i:i + window]) for i in range(max(1, len(words) - window + 1))]


def _automaton(items: list[tuple[str | None, str | None]], window: int):
    owners: dict[str, set] = {}
    for item_id, text in items:
        for w in item_windows(text, window):
            owners.setdefault(" " + w.decode("latin-1") + " ", set()).add(item_id)
    auto = ahocorasick.Automaton()
    for w, who in owners.items():
        auto.add_word(w, (w.count(" ") - 1, len(w), tuple(x for x in who if x is not None)))
    if owners:
        auto.make_automaton()
    return auto if owners else None


def _merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _spans(plain: bytes, runs: list[tuple[int, int]]) -> list[dict]:
    """Character offsets in the original text of runs of words [first, last)."""
    at = [m.span() for m in _WORD.finditer(plain)]
    raw = np.frombuffer(plain, np.uint8)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # continuation bytes are unchanged by the mapping
    return [{"start": int(chars[at[a][0]]), "end": int(chars[at[b - 1][1]])} for a, b in runs]


def _scan_one(auto, text: str | None) -> tuple[int, list, set, list]:
    plain = normalise(text)
    words = plain.split()
    if not words or auto is None:
        return len(words), [], set(), []
    joined = " " + b" ".join(words).decode("latin-1") + " "
    found = list(auto.iter(joined))
    if not found:
        return len(words), [], set(), []
    begins = np.cumsum([0] + [len(w) + 1 for w in words])  # of the space before each word
    runs, items = [], set()
    for end, (n, length, who) in found:
        first = int(np.searchsorted(begins, end - length + 1))
        runs.append((first, first + n))
        items.update(who)
    runs = _merge(runs)
    return len(words), runs, items, _spans(plain, runs)


def _shards(benchmark: DataFrame, automaton_words: int, item_col: str, item_text_col: str) -> tuple[DataFrame, list[int]]:
    """Items (shard, item, text), written once, and the shards that have some: shares of at most ``automaton_words``
    words (one larger item alone).  Items are dealt by hash; only the shares' sizes come to the driver."""
    words = F.size(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"), F.lit(0)))
    items = stage(benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).distinct()
                  .withColumn("words", words).where("words > 0"), "benchmark-items")
    total = items.agg(F.sum("words")).first()[0] or 0
    count = 1 if total <= automaton_words else -(-2 * total // automaton_words)
    while True:
        dealt = items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(count)).cast("long"))
        sizes = dealt.groupBy("shard").agg(F.sum("words").alias("words"), F.count("*").alias("items"))
        if sizes.where((F.col("words") > automaton_words) & (F.col("items") > 1)).isEmpty():
            break
        count *= 2
    numbers = sorted(r["shard"] for r in sizes.select("shard").collect())
    if len(numbers) < 2:
        return dealt, numbers
    # A shard is read by itself later: files sorted by shard let the others be skipped.
    sorted_ = stage(dealt.repartitionByRange("shard").sortWithinPartitions("shard"), "benchmark-shards")
    discard(items)
    return sorted_, numbers


def _items(shards: DataFrame, number: int) -> list[tuple[str | None, str | None]]:
    """One shard's items: its words are bounded."""
    return [(r["item"], r["text"]) for r in shards.where(F.col("shard") == number).select("item", "text").collect()]


def _passes(rows: DataFrame, benchmark: DataFrame, automaton_words: int, item_col: str, item_text_col: str, one_pass) -> DataFrame:
    """``one_pass(rows, shard's items, last)`` for one shard after the other, each over the written result of the one
    before, so that a task holds one automaton and the driver one shard."""
    shards, numbers = _shards(benchmark, automaton_words, item_col, item_text_col)
    before = None
    for k, number in enumerate(numbers or [None]):
        last = k >= len(numbers) - 1
        shared = rows.sparkSession.sparkContext.broadcast([] if number is None else _items(shards, number))
        rows = one_pass(rows, shared, last)
        if not last:
            rows = stage(rows, "benchmark-pass")
            shared.destroy()
            if before is not None:
                discard(before)
            before = rows
    return rows


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, automaton_words: int = AUTOMATON_WORDS,
         id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text") -> DataFrame:
    """Per document: words, runs of hit words, items with occurring windows, hit spans in the original text."""
    def one(rows: DataFrame, shared, last: bool) -> DataFrame:
        return rows.mapInArrow(handing_back(_pass(shared, window, last)), SCAN_SCHEMA if last else f"{SCAN_SCHEMA}, text string")

    return null_ids(_passes(keyed_texts(docs, id_col, text_col), benchmark, automaton_words, item_col, item_text_col, one))


_RUN = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _pass(shared, window: int, final: bool):
    """One automaton over every text; what earlier automata found comes with the row and is united."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton(shared.value, window)
        for b in batches:
            cols = {n: b.column(n).to_pylist() for n in b.schema.names}
            rows = []
            for k, text in enumerate(cols["text"]):
                n, runs, items, spans = _scan_one(auto, text)
                if "items" in cols:
                    runs = _merge(runs + [(r["first"], r["last"]) for r in cols["word_runs"][k]])
                    spans = [{"start": a, "end": z} for a, z in _merge([(x["start"], x["end"]) for x in spans + cols["spans"][k]])]
                    items = items | set(cols["items"][k])
                rows.append((n, [{"first": a, "last": z} for a, z in runs], sorted(items), spans))
            arrays = [b.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], _RUN),
                      pa.array([r[2] for r in rows], pa.list_(pa.string())), pa.array([r[3] for r in rows], _SPAN)]
            names = ["doc_id", "n_words", "word_runs", "items", "spans"]
            if not final:
                arrays, names = [*arrays, b.column("text")], [*names, "text"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_share: int = 20, **kw) -> DataFrame:
    """``scan`` with the verdict: hit at all, and at least 1/``min_share`` of the words hit."""
    hit = F.aggregate("word_runs", F.lit(0).cast("long"), lambda s, r: s + r["last"] - r["first"])
    return (scan(docs, benchmark, **kw)
            .withColumn("n_hit", hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * min_share >= F.col("n_words"))))


def keep(docs: DataFrame, benchmark: DataFrame, min_share: int = 20, window: int = WINDOW,
         automaton_words: int = AUTOMATON_WORDS, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text") -> DataFrame:
    """The documents, unchanged, that are not contaminated."""
    at, width = docs.columns.index(text_col), len(docs.columns)
    schema = docs.schema
    runs_too = StructType([*schema.fields, StructField("_hit_runs", ArrayType(ArrayType(LongType())))])

    def one(rows: DataFrame, shared, last: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            auto = _automaton(shared.value, window)
            for b in batches:
                texts = b.column(at).to_pylist()
                known = b.column(width).to_pylist() if b.num_columns > width else [[]] * len(texts)
                words, runs = [], []
                for text, old in zip(texts, known, strict=True):
                    n, more, _, _ = _scan_one(auto, text)
                    words.append(n)
                    runs.append(_merge([(x, y) for x, y in old] + more))
                columns = b.columns[:width]
                if last:
                    hits = [sum(y - x for x, y in r) for r in runs]
                    stays = [not (h and h * min_share >= n) for h, n in zip(hits, words, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array(stays, pa.bool_()))
                else:
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(runs, pa.list_(pa.list_(pa.int64())))], names=runs_too.names)
        return rows.mapInArrow(handing_back(run), schema if last else runs_too)

    return _passes(docs, benchmark, automaton_words, item_col, item_text_col, one)


def digest(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The contract's columns of ``decontaminate``."""
    return decontaminate(docs, benchmark, **kw).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"), "contaminated")
