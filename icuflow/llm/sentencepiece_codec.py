"""SentencePiece encoding and decoding by batched Viterbi in numpy.

The vocabulary file is a byte-fallback BPE model; its pieces and scores are used
as they are.  A text becomes words (white-space marks with what follows them),
each distinct word is encoded once, and words of equal length advance together:

* substring hashes of every length are looked up among the sorted piece keys;
* for each end position, the candidate pieces are scored against the piece their
  path ends in.  Merging leaves a sequence of pieces in place exactly if it
  leaves every neighbouring pair in place, so a step scores 0 if the pair stays
  apart under the merge ranks and minus infinity if not;
* the maximum is taken over all candidates at once and its length is stored as
  the backpointer.

The result equals the library's own encoding of the model.  Only the vocabulary
(bounded by the model file) is read on the driver and broadcast.

Defined cases: a null text gives null ids and an empty text none; characters
outside the vocabulary become bytes; a byte sequence that is not UTF-8 decodes
with replacement marks; repeated rows are encoded alike; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icuflow.llm import repeats as R
from icuflow.llm.common import handing_back, keyed_texts, null_ids

MODEL = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁"
CACHE_WORDS = 800_000
CELLS = 1 << 19
# Texts are encoded in groups of about this many characters: more new words of a length advance together.
GROUP_CHARS = 4 << 20
_NEVER = np.int64(1 << 40)
_STEP = np.uint64(0x9E3779B97F4A7C15)


# Words of more characters are cut where no piece holds both neighbours, before words of a length advance together.
LONG = 32


def _fields(data: bytes) -> dict[int, list]:
    """Fields of a protocol buffer message by number: integers, or the bytes of what has a length."""
    out: dict[int, list] = {}
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = number()
        kind, value = tag & 7, None
        if kind == 0:
            value = number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            value, at = data[at:at + size], at + size
        out.setdefault(tag >> 3, []).append(value)
    return out


def check_kind(model: bytes) -> None:
    """Raise unless the model merges pairs (BPE) and leaves texts as they are: what this encoder reproduces."""
    fields = _fields(model)
    trainer = _fields(fields.get(2, [b""])[-1])
    normaliser = _fields(fields.get(3, [b""])[-1])
    if trainer.get(3, [1])[-1] != 2:
        raise ValueError("the vocabulary is no BPE model")
    if normaliser.get(2, [b""])[-1] or normaliser.get(4, [1])[-1] or not normaliser.get(5, [1])[-1]:
        raise ValueError("the vocabulary's model changes texts before it splits them")


class Vocabulary:
    """Pieces, their merge ranks and how each is put together; plain arrays, for a broadcast."""

    def __init__(self, path: str = MODEL):
        import sentencepiece
        with open(path, "rb") as f:
            check_kind(f.read())
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.special = np.array([sp.is_control(i) or sp.is_unknown(i) for i in range(n)])
        is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in np.flatnonzero(is_byte).tolist()}
        self.byte_ids = np.full(256, sp.unk_id(), np.int64)
        for i, b in self.byte_of.items():
            self.byte_ids[b] = i
        normal = [i for i in range(n) if not (self.special[i] or is_byte[i] or sp.is_unused(i))]
        self.dummy_prefix = sp.encode("a", out_type=str)[0].startswith(MARK)
        # A piece with a mark after another character would let pieces cross words.
        self.words_split = not any(MARK in p.lstrip(MARK) for p in (self.pieces[i] for i in normal))
        order = sorted(normal, key=lambda i: (-sp.get_score(i), i))
        rank = {self.pieces[i]: r for r, i in enumerate(order)}
        self.rank = np.full(n + 1, -1, np.int64)  # the last entry stands for a character outside the vocabulary
        self.left, self.right = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        self.unknown = n
        ids = {self.pieces[i]: i for i in normal}
        pairs = []
        for i in order:
            p = self.pieces[i]
            if len(p) > 1:
                parts = _merge(p, rank, rank[p])
                if len(parts) == 2 and all(x in ids for x in parts):
                    self.rank[i], self.left[i], self.right[i] = rank[p], ids[parts[0]], ids[parts[1]]
                    pairs.append((int(_pair(self.left[i:i + 1], self.right[i:i + 1])[0]), rank[p]))
                else:
                    ids.pop(p)  # no merge makes it
        self.ranks_by_pair = SortedKeys([k for k, _ in pairs], [r for _, r in pairs])
        self.longest = max((len(p) for p in ids), default=1)
        # Neighbouring characters of any piece: merging cannot pass between two that are none.
        self.neighbours = np.array(sorted({ord(a) << 32 | ord(b) for p in ids for a, b in zip(p, p[1:])}), np.uint64)
        self.pieces_by_key = SortedKeys([int(_key(np.array([[ord(c) for c in p]], np.uint64))[0]) for p in ids], list(ids.values()))


class SortedKeys:
    """Values by 64-bit key: a probe of the sorted keys, after a table of the keys' first bits has
    turned away most of the keys that are not there."""

    BITS = 22

    def __init__(self, keys: list[int], values: list[int]):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        self.keys = np.array([keys[i] for i in order], np.uint64)
        self.values = np.array([values[i] for i in order], np.int64)
        self.there = np.zeros(1 << self.BITS, bool)
        self.there[(self.keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def find(self, keys: np.ndarray, default: int = -1) -> np.ndarray:
        out = np.full(len(keys), default, np.int64)
        maybe = np.flatnonzero(self.there[(keys >> np.uint64(64 - self.BITS)).astype(np.int64)])
        if len(maybe):
            some = keys[maybe]
            j = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
            out[maybe] = np.where(self.keys[j] == some, self.values[j], default)
        return out


def _key(codes: np.ndarray) -> np.ndarray:
    h = np.full(len(codes), 17, np.uint64)
    for k in range(codes.shape[1]):
        h = h * _STEP + codes[:, k] + np.uint64(1)
    return R.mix(h + np.uint64(codes.shape[1]))


def _pair(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return R.mix((one.astype(np.uint64) << np.uint64(32)) | two.astype(np.uint64))


def _merge(piece: str, rank: dict[str, int], below: int) -> list[str]:
    """The piece's characters, merged in rank order by all merges that come before its own."""
    parts = list(piece)
    while len(parts) > 1:
        r, k = min((rank.get(parts[k] + parts[k + 1], below), k) for k in range(len(parts) - 1))
        if r >= below:
            break
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    return parts


def stays_apart(v: Vocabulary, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether merging leaves pieces ``one`` and ``two`` side by side: undo their merges from the last
    one back, and see that no merge across the border comes before those already made."""
    ok = np.ones(len(one), bool)
    at = np.arange(len(one))
    a, b = one.copy(), two.copy()
    limit = np.full(len(one), _NEVER)
    while len(at):
        across = v.ranks_by_pair.find(_pair(a, b), _NEVER)
        ra, rb = v.rank[a], v.rank[b]
        bad = across < limit
        ok[at[bad]] = False
        go = ~bad & ((ra >= 0) | (rb >= 0))
        at, a, b, ra, rb = at[go], a[go], b[go], ra[go], rb[go]
        first = ra > rb
        limit = np.where(first, ra, rb + 1)
        a, b = np.where(first, v.right[a], a), np.where(first, b, v.left[b])
    return ok


class Pairs:
    """``stays_apart`` with its latest results at hand, one for each value of a pair's first bits."""

    BITS = 20

    def __init__(self, v: Vocabulary):
        self.v = v
        self.keys = np.zeros(1 << self.BITS, np.uint64)  # 0 is the hash of no pair met here
        self.apart = np.zeros(1 << self.BITS, bool)

    def stay_apart(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        key = _pair(one, two)
        at = (key >> np.uint64(64 - self.BITS)).astype(np.int64)
        ok = self.apart[at]
        new = np.flatnonzero(self.keys[at] != key)
        if len(new):
            ok[new] = stays_apart(self.v, one[new], two[new])
            self.keys[at[new]] = key[new]
            # Of several pairs with equal first bits the last stays, with its own result.
            mine = self.keys[at[new]] == key[new]
            self.apart[at[new][mine]] = ok[new][mine]
        return ok


def encode_equal(v: Vocabulary, codes: np.ndarray, pairs: Pairs | None = None) -> list[bytes]:
    """Piece ids (32-bit) of words of one length; codes: words x characters."""
    n, length = codes.shape
    pairs = pairs or Pairs(v)
    most = min(v.longest, length)
    codes = np.ascontiguousarray(codes.T)
    # Candidate piece for each (end, length, word), -1 if there is none.
    found = np.full((length + 1, most + 1, n), -1, np.int32)
    h = np.full((length, n), 17, np.uint64)
    for k in range(1, most + 1):
        h = h[:length - k + 1] * _STEP + codes[k - 1:] + np.uint64(1)
        found[k:, k] = v.pieces_by_key.find(R.mix(h + np.uint64(k)).ravel()).reshape(-1, n)
    found[1:, 1][found[1:, 1] < 0] = v.unknown
    last = np.full((length + 1, n), -1, np.int32)  # the piece that the path to this place ends in
    back = np.zeros((length + 1, n), np.int32)
    for end in range(1, length + 1):
        top = min(most, end)
        k, row = np.nonzero(found[end, 1:top + 1] >= 0)
        k = k + 1
        piece, before = found[end, k, row], last[end - k, row]
        fits = end == k  # a piece from the start of the word has nothing before it
        check = np.flatnonzero((end != k) & (before >= 0))
        fits[check] = pairs.stay_apart(before[check], piece[check])
        score = np.full((top + 1, n), -np.inf, np.float32)
        score[k, row] = np.where(fits, 0.0, -np.inf)
        best = score.argmax(0)
        good = np.flatnonzero(score[best, np.arange(n)] == 0)
        back[end, good] = best[good]
        last[end, good] = found[end, best[good], good]
    # Follow the backpointers of all words together.
    end, steps = np.full(n, length), []
    rows = np.arange(n)
    while end.any():
        steps.append(np.where(end > 0, last[end, rows], -1))
        end = end - back[end, rows]
    path = np.stack(steps[::-1], 1).astype(np.int32) if steps else np.zeros((n, 0), np.int32)
    raw, wide = path.tobytes(), 4 * path.shape[1]
    empty = 4 * (path < 0).sum(1)
    out = [raw[w * wide + k:(w + 1) * wide] for w, k in enumerate(empty.tolist())]
    for w in np.flatnonzero((path == v.unknown).any(1)).tolist():
        ids, at = [], 0
        for p in np.frombuffer(out[w], np.int32).tolist():
            if p == v.unknown:
                ids.extend(v.byte_ids[list(chr(int(codes[at, w])).encode("utf-8", "surrogatepass"))].tolist())
                at += 1
            else:
                ids.append(p)
                at += len(v.pieces[p])
        out[w] = np.array(ids, np.int32).tobytes()
    return out


class Encoder:
    """Encodes texts; remembers up to CACHE_WORDS words, which changes the speed only."""

    def __init__(self, v: Vocabulary):
        self.v, self.pairs = v, Pairs(v)
        self.seen: dict[str, bytes] = {}  # by the word with its marks
        self.plain: dict[str, bytes] = {}  # by the word without its one mark
        self.split = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+", re.S) if v.words_split else re.compile(".+", re.S)

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(" ", MARK)
        return self.split.findall(MARK + text if self.v.dummy_prefix else text)

    def cut(self, word: str) -> list[str]:
        """A word's parts between neighbours that no piece holds: text without spaces is mostly such parts."""
        codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        pairs = (codes[:-1] << np.uint64(32)) | codes[1:]
        at = np.minimum(np.searchsorted(self.v.neighbours, pairs), max(len(self.v.neighbours) - 1, 0))
        held = self.v.neighbours[at] == pairs if len(self.v.neighbours) else np.zeros(len(pairs), bool)
        ends = [0, *(np.flatnonzero(~held) + 1).tolist(), len(word)]
        return [word[a:z] for a, z in zip(ends[:-1], ends[1:], strict=True)]

    def learn(self, new: set[str]) -> Iterator[tuple[str, bytes]]:
        """The ids of words; those of a long word are its parts' one after the other."""
        cuts = {w: self.cut(w) for w in new if len(w) > LONG}
        parts = {p for ps in cuts.values() for p in ps}
        ids = dict(self.learn_whole({w for w in new if len(w) <= LONG} | parts))
        for w in new:
            yield w, ids[w] if w not in cuts else b"".join(map(ids.__getitem__, cuts[w]))

    def learn_whole(self, new: set[str]) -> Iterator[tuple[str, bytes]]:
        by: dict[int, list[str]] = {}
        for w in new:
            by.setdefault(len(w), []).append(w)
        for length, ws in by.items():
            step = max(1, CELLS // (length * min(length, self.v.longest)))
            for k in range(0, len(ws), step):
                some = ws[k:k + step]
                codes = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(some), length).astype(np.uint64)
                yield from zip(some, encode_equal(self.v, codes, self.pairs), strict=True)

    def encode_raw(self, texts: list[str | None]) -> list[bytes | None]:
        """The ids of each text as 32-bit integers.  Where single spaces part the words, they are split
        at them and stand for themselves with one mark; else the marks are written and matched."""
        if len(self.seen) + len(self.plain) > CACHE_WORDS:
            self.seen, self.plain = {}, {}
        simple = self.v.dummy_prefix and self.v.words_split
        split = [(self.plain, t.split(" ")) if simple and t and "  " not in t and t[0] != " " and t[-1] != " " and MARK not in t
                 else (self.seen, self.words(t or "")) for t in texts]
        marked = set().union(*[ws for of, ws in split if of is self.seen]).difference(self.seen)
        single = set().union(*[ws for of, ws in split if of is self.plain]).difference(self.plain)
        self.seen.update(self.learn(marked))
        self.plain.update((w[1:], ids) for w, ids in self.learn({MARK + w for w in single}))
        return [None if t is None else b"".join(map(of.__getitem__, ws)) for t, (of, ws) in zip(texts, split, strict=True)]

    def encode(self, texts: list[str | None]) -> list[list[int] | None]:
        return [None if r is None else np.frombuffer(r, np.int32).tolist() for r in self.encode_raw(texts)]


def _id_lists(raws: list[bytes | None]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) // 4 if r is not None else 0 for r in raws])]).astype(np.int32)
    flat = np.frombuffer(b"".join(r for r in raws if r is not None), np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()), mask=pa.array([r is None for r in raws], pa.bool_()))


class Decoder:
    """Texts of id sequences: one table look-up per id, except where several bytes make a character."""

    def __init__(self, v: Vocabulary):
        self.v, n = v, len(v.pieces)
        self.text = [" " if p == MARK else p.replace(MARK, " ") for p in v.pieces]
        self.by_run = np.zeros(n, bool)  # bytes of 0x80 and more
        for i in np.flatnonzero(v.special).tolist():
            self.text[i] = ""
        for i, b in v.byte_of.items():
            self.text[i] = chr(b)
            self.by_run[i] = b >= 0x80

    def decode(self, ids: np.ndarray) -> str:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.text) or self.by_run[ids].any()):
            return decode_ids(self.v, ids.tolist())
        text = "".join(map(self.text.__getitem__, ids.tolist()))
        return text[1:] if self.v.dummy_prefix and text.startswith(" ") else text


def decode_ids(v: Vocabulary, ids: list[int] | None) -> str | None:
    if ids is None:
        return None
    out, raw = [], bytearray()
    for i in ids:
        b = v.byte_of.get(i)
        if b is not None:
            raw.append(b)
            continue
        if raw:
            out.append(raw.decode("utf-8", "replace"))
            raw = bytearray()
        if 0 <= i < len(v.pieces) and not v.special[i]:
            out.append(v.pieces[i])
    out.append(raw.decode("utf-8", "replace"))
    text = "".join(out).replace(MARK, " ")
    return text[1:] if v.dummy_prefix and text.startswith(" ") else text


def _in_groups(column: pa.Array) -> Iterator[pa.Array]:
    """Slices of about GROUP_CHARS of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + GROUP_CHARS, side="right")))
        yield column.slice(first, last - first)
        first = last


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _share(spark, model: str):
    """The vocabulary as a broadcast; its class goes with it, so that tasks need not import this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(vocabulary(model)))


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text."""
    shared = _share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pickle.loads(shared.value))
        for b in batches:
            first = 0
            for texts in _in_groups(b.column(1)):
                ids = _id_lists(encoder.encode_raw(texts.to_pylist()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(texts)), ids], names=["doc_id", "ids"])
                first += len(texts)

    return null_ids(keyed_texts(docs, id_col, text_col).mapInArrow(handing_back(run), "doc_id long, ids array<int>"))


def decode(encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, text): the text that the ids stand for."""
    shared = _share(encoded.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(pickle.loads(shared.value))
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                text = [decoder.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else None for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(handing_back(run), "doc_id long, ids array<int>, text string")


def tokenize(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """The documents, unchanged, with ids, n_tokens and round_trip (decoding gives the text back); columns
    that bear these names already are replaced."""
    shared = _share(docs.sparkSession, model)
    docs = docs.drop("ids", "n_tokens", "round_trip")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = pickle.loads(shared.value)
        encoder, decoder = Encoder(v), Decoder(v)
        for b in batches:
            first = 0
            for texts in _in_groups(b.column(at)):
                texts = texts.to_pylist()
                ids = encoder.encode_raw(texts)
                back = [None if r is None else decoder.decode(np.frombuffer(r, np.int32)) for r in ids]
                part = b.slice(first, len(texts))
                first += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in range(part.num_columns)]
                    + [_id_lists(ids), pa.array([len(x or b"") // 4 for x in ids], pa.int64()),
                       pa.array([x == t for x, t in zip(back, texts, strict=True)], pa.bool_())],
                    names=[*b.schema.names, "ids", "n_tokens", "round_trip"])

    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])
    return docs.mapInArrow(handing_back(run), schema)


def digest(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids, comma-joined), decoded_sha256 (of the decoded text)."""
    out = decode(encode(docs, **kw), **{k: v for k, v in kw.items() if k == "model"})
    return out.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
                      F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
