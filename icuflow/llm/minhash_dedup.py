"""MinHash near-dedup by a chosen-path set similarity join.

A document's set holds its distinct ``SHINGLE``-word shingles.  Documents with
equal sets are one representative (the smallest doc_id), so copies never meet in
a join.  Each of ``TREES`` trees sends a representative along a path of selected
minwise tokens: the root branches on one coordinate of the MinHash signature, a
node of more than ``NODE`` members branches on two further coordinates chosen by
a hash of its path, down to ``DEPTH``.  A pair of similarity 0.75 or more meets
in a small node of one tree with probability 0.67 at least, of 16 trees with
1 - 3e-8.

Small nodes are compared exhaustively on signatures (64 coordinates, kept from
an estimate of 0.5).  Candidates are confirmed on the full sets.  Only the
classes matter, so comparing goes in rounds: first each member with its most
similar predecessor; then, with the confirmed classes known, every candidate
pair that still crosses classes.  Nodes that stay large at ``DEPTH`` (big groups
of near copies) are first compared with leaders of the node, in up to ``ROUNDS``
rounds; this only joins classes cheaply.  Then every pair of members of a large
node that still crosses classes is compared as in small nodes, in blocks dealt to
tasks: signatures give the groups that candidate pairs connect, and inside these
the full sets are intersected.  Only pairs within a node's or group's most
frequent class are left out, so the work grows with what is still open.

Defined cases: a text that is null or has no words has an empty set and is its
own class; fewer words than a shingle are one shingle; rows repeating a doc_id
are one document; a null doc_id counts as the smallest; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.llm import repeats as R
from icuflow.llm.common import NULL_ID, apart, discard, handing_back, keyed_texts, null_ids, stage, text_groups
from icuflow.llm.components import components
from icuflow.llm.substring_dedup import word_bounds

SHINGLE = 5
COORDINATES = 64
TREES = 16
NODE = 48
DEPTH = 3
ESTIMATE = 0.5
ROUNDS = 6
FIRST_NODES = 4
PAIRS_A_COPY = 1000
# A block of members of a large node, and of shingles (a member counts MEMBER more) compared at once.
BLOCK_MEMBERS = 1024
BLOCK_SHINGLES = 1 << 19
MEMBER = 512
COLUMNS = 2048
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = R.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
_ODD = R.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x165667B19E3779F9)) | np.uint64(1)
_XOR = R.mix(np.arange(1001, COORDINATES + 1001, dtype=np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, shingle) of a group of texts, sorted; offsets of each document's set."""
    begins, ends, doc = word_bounds(data, offsets)
    n = len(offsets) - 1
    codes = R.word_names(_CODES[_LOWER[data]], begins, ends)
    first = np.searchsorted(doc, np.arange(n + 1))
    words = np.diff(first)
    full = first[doc] + words[doc] - np.arange(len(doc)) >= shingle
    short = (words > 0) & (words < shingle)
    start = np.concatenate([np.flatnonzero(full), first[:-1][short]])
    end = np.concatenate([np.flatnonzero(full) + shingle, first[1:][short]])
    h = R.Hashes(codes).of(start, end, 9)
    d = doc[start]
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    return h, np.searchsorted(d, np.arange(n + 1))


def _sketches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, offsets in text_groups(batches):
            h, at = shingle_sets(data, offsets, shingle)
            size = np.diff(at)
            full = np.flatnonzero(size)
            sig = np.zeros((len(ids), COORDINATES), np.uint32)
            d1, d2 = np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.uint64)
            if len(full):
                cuts = at[:-1][full]
                for k in range(COORDINATES):
                    sig[full, k] = np.minimum.reduceat((((h ^ _XOR[k]) * _ODD[k]) >> np.uint64(32)).astype(np.uint32), cuts)
                d1[full] = np.add.reduceat(R.mix(h), cuts)
                d2[full] = np.add.reduceat(R.mix(h ^ np.uint64(0x5851F42D4C957F2D)), cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(size, pa.int64()), R.long_array(d1), R.long_array(d2),
                 pa.array([s.tobytes() for s in sig], pa.binary())], names=["doc_id", "n", "d1", "d2", "sig"])
    return run


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), COORDINATES)


def _roots(trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sig = _signatures(b.column(2)).astype(np.uint64)
                key = np.concatenate([R.mix(sig[:, t] + (np.uint64(t + 1) << np.uint64(40))) for t in range(trees)])
                rep, n = (np.tile(b.column(k).to_numpy(), trees) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([R.long_array(key), R.long_array(rep), R.long_array(n)], names=["node", "rep", "n"])
    return run


def _branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two children of each node: coordinates chosen by a hash of the path, so all its members take the same."""
    for b in batches:
        if b.num_rows:
            node = b.column(0).to_numpy().view(np.uint64)
            sig = _signatures(b.column(3)).astype(np.uint64)
            rest = COORDINATES - TREES
            one = (R.mix(node + np.uint64(1)) % np.uint64(rest)).astype(np.int64)
            two = (one + 1 + (R.mix(node + np.uint64(2)) % np.uint64(rest - 1)).astype(np.int64)) % rest
            rows = np.arange(len(node))
            key = np.concatenate([R.mix(node ^ R.mix(sig[rows, TREES + c] + (c.astype(np.uint64) << np.uint64(40)))) for c in (one, two)])
            rep, n = (np.tile(b.column(k).to_numpy(), 2) for k in (1, 2))
            yield pa.RecordBatch.from_arrays([R.long_array(key), R.long_array(rep), R.long_array(n)], names=["node", "rep", "n"])


_NODE_ROW = "node long, rep long, n long"


def _tree_nodes(reps: DataFrame, trees: int) -> tuple[DataFrame, DataFrame]:
    """Rows (node, rep, n) of the small nodes and of the nodes still large at the last level."""
    rows = reps.select("rep", "n", "sig").mapInArrow(handing_back(_roots(trees)), _NODE_ROW)
    small, paths = [], []
    for level in range(DEPTH):
        rows = stage(rows, "minhash-paths")
        paths.append(rows)
        counts = rows.groupBy("node").agg(F.count("*").alias("members")).where("members > 1").select(apart("node").alias("counted"), "members")
        rows = rows.join(counts, apart("node") == F.col("counted")).select("node", "rep", "n", "members")
        small.append(rows.where(F.col("members") <= NODE).select("node", "rep", "n"))
        rows = rows.where(F.col("members") > NODE).select("node", "rep", "n")
        if level < DEPTH - 1:
            rows = (rows.join(reps.select(F.col("rep").alias("r"), "sig"), F.col("rep") == F.col("r"))
                    .select("node", "rep", "n", "sig").mapInArrow(handing_back(_branches), _NODE_ROW))
    few = small[0]
    for s in small[1:]:
        few = few.unionByName(s)
    # Many trees make the same node: each set of members is compared once.  The lists hold NODE members at most.
    lists = (few.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("rep", "n"))).alias("m"))
             .groupBy("m").agg(F.min("node").alias("node")))
    few = lists.select("node", F.explode("m").alias("m")).select("node", "m.rep", "m.n")
    few, rows = stage(few, "minhash-nodes"), stage(rows, "minhash-large")
    discard(*paths)
    return few, rows


def _candidates(everything: bool, percent: int):
    """Within each small node (rows sorted by node, rep): pairs whose estimate is ESTIMATE or more."""
    def pairs(rep, n, cls, sig):
        same = (sig[:, None, :] == sig[None, :, :]).sum(2)
        ok = (same >= ESTIMATE * COORDINATES) & (100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :]))
        ok &= np.tri(len(rep), k=-1, dtype=bool) & (rep[:, None] != rep[None, :])
        if everything:
            i, j = np.nonzero(ok & (cls[:, None] != cls[None, :]))
        else:
            i = np.flatnonzero(ok.any(1))
            j = np.where(ok, same, -1)[i].argmax(1)
        return rep[j], rep[i], rep[ok.any(0) | ok.any(1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            u, v, active = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
            u, v = np.concatenate([u, active]), np.concatenate([v, active])  # (x, x): x has a candidate at all
            return pa.RecordBatch.from_arrays([R.long_array(u), R.long_array(v)], names=["u", "v"])

        held = None
        for b in batches:
            if b.num_rows == 0:
                continue
            cols = [b.column(k).to_numpy() for k in range(4)] + [_signatures(b.column(4))]
            if held is not None:
                cols = [np.concatenate([a, c]) for a, c in zip(held, cols, strict=True)]
            cut = np.flatnonzero(np.concatenate([[True], cols[0][1:] != cols[0][:-1]]))
            found = [pairs(*(c[a:z] for c in cols[1:])) for a, z in zip(cut[:-1], cut[1:], strict=True)]
            held = [c[cut[-1]:] for c in cols]
            yield out(found)
        if held is not None:
            yield out([pairs(*held[1:])])
    return run


def _small_pairs(nodes: DataFrame, reps: DataFrame, classes: DataFrame | None, percent: int) -> DataFrame:
    rows = nodes.join(reps.select(F.col("rep").alias("r"), "sig"), F.col("rep") == F.col("r")).drop("r")
    if classes is None:
        rows = rows.withColumn("cls", F.col("rep"))
    else:
        rows = rows.join(classes, F.col("rep") == F.col("member"), "left").withColumn("cls", F.coalesce("class", "rep"))
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.select("node", "rep", "n", "cls", "sig").repartition(parts, "node").sortWithinPartitions("node", "rep")
            .mapInArrow(handing_back(_candidates(classes is not None, percent)), "u long, v long"))


def _members(large: DataFrame) -> DataFrame:
    """(rep, n, nodes): a row for each member with the large nodes that it lies in, TREES * 2^(DEPTH - 1) at most."""
    return large.groupBy("rep", "n").agg(F.collect_list("node").alias("nodes"))


def _classed(members: DataFrame, classes: DataFrame | None) -> DataFrame:
    """(node, rep, n, cls): classes meet the members, a row each; only then the nodes are listed."""
    if classes is None:
        known = members.withColumn("cls", F.col("rep"))
    else:
        known = members.join(classes, F.col("rep") == F.col("member"), "left").withColumn("cls", F.coalesce("class", "rep"))
    return known.select(F.explode("nodes").alias("node"), "rep", "n", "cls")


def _leader_pairs(members: DataFrame, classes: DataFrame | None, round_: int, percent: int) -> DataFrame:
    """Members of large nodes with a leader of the node; members already in its class are done."""
    rows = _classed(members, classes)
    if classes is None:
        # The first round takes a quarter of the nodes: each member lies in many, and what it links there
        # need not be looked at again.  Later rounds take all of them.
        rows = rows.where(F.pmod("node", F.lit(FIRST_NODES)) == 0)
    one = F.struct("rep", "n", "cls")
    if classes is None:
        picked = rows.groupBy("node").agg(F.min(one).alias("leader"))
        picks = ["leader"]
    else:
        # Per node and class: the first member and a drawn one.  The leader is the first of all; later rounds
        # also take a drawn member of its class and a drawn member of another.
        draw = F.xxhash64("node", "rep", F.lit(round_))
        per = rows.groupBy("node", "cls").agg(F.min(one).alias("first"), F.min(F.struct(draw.alias("draw"), one.alias("one"))).alias("drawn"))
        nodes = (per.groupBy("node").agg(F.min("first").alias("leader"), F.count("*").alias("classes")).where("classes > 1")
                 .select(apart("node").alias("at"), "leader"))
        inside = F.col("cls") == F.col("leader.cls")
        picked = (per.join(nodes, apart("node") == F.col("at")).groupBy("node")
                  .agg(F.first("leader").alias("leader"), F.min(F.when(inside, F.col("drawn"))).alias("inside"), F.min(F.when(~inside, F.col("drawn"))).alias("outside"))
                  .select("node", "leader", F.col("inside.one").alias("inside"), F.col("outside.one").alias("outside")))
        picks = ["leader", "inside", "outside"]

    def meets(pick):
        return ((F.col("cls") != pick["cls"]) & (100 * F.least(F.col("n"), pick["n"]) >= percent * F.greatest(F.col("n"), pick["n"])))

    # The conditions are the join's own, so that it gives rows with something to look at only.
    some = meets(F.col(picks[0]))
    for pick in picks[1:]:
        some = some | meets(F.col(pick))
    met = rows.join(picked.select(apart("node").alias("at"), *picks), (apart("node") == F.col("at")) & (F.col("cls") != F.col("leader.cls")) & some)
    return (met.select("rep", F.explode(F.filter(F.array(*picks), meets)).alias("to"))
            .select(F.least("to.rep", "rep").alias("u"), F.greatest("to.rep", "rep").alias("v")))


def _sets(texts: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(rep, set): the sorted shingles, 8 bytes each, of the wanted documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, offsets in text_groups(batches):
            h, at = shingle_sets(data, offsets, shingle)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([h[a:z].tobytes() for a, z in zip(at[:-1], at[1:], strict=True)], pa.binary())],
                                             names=["rep", "set"])

    some = texts.join(wanted.withColumnRenamed("rep", "doc_id").hint("shuffle_hash"), "doc_id", "left_semi")
    return some.mapInArrow(handing_back(run), "rep long, set binary").dropDuplicates(["rep"])


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union on the full sets.  A set that many pairs need is
    sent in several copies, one for every PAIRS_A_COPY of them."""
    copies = (pairs.groupBy("u").agg(F.ceil(F.count("*") / PAIRS_A_COPY).cast("int").alias("copies")).select(apart("u").alias("cu"), "copies"))
    left = (sets.join(copies, apart("rep") == F.col("cu"))
            .select("rep", F.col("set").alias("uset"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
            .withColumn("left_key", F.xxhash64("rep", "copy")))
    dealt = (pairs.join(copies, apart("u") == F.col("cu")).withColumn("copy_of", F.pmod(F.xxhash64("v"), F.col("copies")).cast("int"))
             .withColumn("pair_key", F.xxhash64("u", "copy_of"))
             .join(left, (F.col("pair_key") == F.col("left_key")) & (F.col("u") == F.col("rep")) & (F.col("copy_of") == F.col("copy")))
             .select("u", "v", "uset"))
    both = dealt.join(sets.select(F.col("rep").alias("r2"), F.col("set").alias("vset")), F.col("v") == F.col("r2")).select("u", "v", "uset", "vset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for k in range(b.num_rows):
                x, y = (np.frombuffer(b.column(c)[k].as_buffer(), np.uint64) for c in (2, 3))
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["u", "v"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(handing_back(run), "u long, v long")


def _open_nodes(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(grp, k, rep, n, cls, main) of the large nodes whose members are of several classes; nodes of equal members
    once.  ``main`` marks the node's most frequent class, so that the rows meet their nodes in one join only."""
    rows = _classed(members, classes).select(F.col("node").alias("grp"), _size_class().alias("k"), "rep", "n", "cls")
    per = rows.groupBy("grp", "cls").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("rep")).alias("x1"),
                                         F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("x2"))
    nodes = (per.groupBy("grp").agg(F.count("*").alias("classes"), F.sum("c").alias("members"), F.bit_xor("x1").alias("x1"),
                                    F.bit_xor("x2").alias("x2"), F.max_by("cls", F.struct("c", "cls")).alias("most"))
             .where("classes > 1").groupBy("members", "x1", "x2").agg(F.min(F.struct("grp", "most")).alias("one"))
             .select(apart("one.grp").alias("at"), "one.most"))
    return rows.join(nodes, apart("grp") == F.col("at")).select("grp", "k", "rep", "n", "cls", (F.col("cls") == F.col("most")).alias("main"))


def _most_frequent(rows: DataFrame) -> DataFrame:
    """The rows (grp, cls, ...) with ``main``, which marks their group's most frequent class."""
    most = (rows.groupBy("grp", "cls").agg(F.count("*").alias("c")).groupBy("grp").agg(F.max_by("cls", F.struct("c", "cls")).alias("most"))
            .select(apart("grp").alias("at"), "most"))
    return rows.join(most, apart("grp") == F.col("at")).withColumn("main", F.col("cls") == F.col("most")).drop("at", "most")


def _size_class() -> Column:
    # Sets of similarity 2/3 or more differ in size by less than 1.5: they are of the same or adjacent classes.
    return F.floor(F.log("n") / np.log(1.5)).cast("long")


def _block_pairs(rows: DataFrame, weight: Column, limit: int) -> DataFrame:
    """The rows (grp, k, cls, rep, n, main) under each pair of blocks they are in: (pair, side, rep, n, cls).  Blocks are
    parts of a group's size class of bounded weight; blocks of its most frequent class do not meet each other."""
    rows = stage(rows.select(F.xxhash64("grp", "k", "main").alias("unit"), "grp", "k", "main", "rep", "n", "cls"), "minhash-open")
    units = rows.groupBy("unit", "grp", "k", "main").agg(F.ceil(F.sum(weight) / limit).cast("long").alias("blocks"))
    blocks = units.select("grp", "k", "main", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                                                                    lambda i: F.xxhash64("unit", i))).alias("one"))
    other = blocks.select(F.col("grp").alias("grp2"), F.explode(F.array("k", F.col("k") - 1)).alias("k2"), F.col("k").alias("own"),
                          F.col("main").alias("main2"), F.col("one").alias("two"))
    pairs = stage(blocks.join(other, (F.col("grp") == F.col("grp2")) & (F.col("k") == F.col("k2")))
                  .where(~(F.col("main") & F.col("main2")) & ((F.col("own") > F.col("k")) | (F.col("one") <= F.col("two"))))
                  .select("one", "two", F.xxhash64("one", "two").alias("pair")), "minhash-blocks")
    rows = (rows.join(units.select(apart("unit").alias("at"), "blocks"), apart("unit") == F.col("at"))
            .select(F.xxhash64("unit", F.pmod(F.xxhash64("rep"), F.col("blocks"))).alias("block"), "rep", "n", "cls"))
    sides = (pairs.select(F.col("one").alias("at"), "pair", F.lit(0).cast("long").alias("side"))
             .unionByName(pairs.where("one <> two").select(F.col("two").alias("at"), "pair", F.lit(1).cast("long").alias("side"))))
    return rows.join(sides, F.col("block") == F.col("at")).select("pair", "side", "rep", "n", "cls")


def _stars(likes):
    """Over rows (pair, side, rep, n, cls, bytes) sorted by pair: links (u, v) that connect what ``likes`` connects,
    each member with one other of its group at most."""
    def links(side, rep, n, cls, held):
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        b = b if len(b) else a
        if not len(a):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        some = (cls[a][:, None] != cls[b][None, :]) & (rep[a][:, None] != rep[b][None, :])
        ok = np.zeros((len(rep), len(rep)), bool)
        if some.any():
            ok[np.ix_(a, b)] = some & likes(n[a], n[b], [held[k] for k in a], [held[k] for k in b])
        ok |= ok.T
        label = np.full(len(rep), -1)
        for k in np.flatnonzero(ok.any(1)):
            if label[k] < 0:
                label[k], front = k, np.array([k])
                while len(front):
                    front = np.flatnonzero(ok[front].any(0) & (label < 0))
                    label[front] = k
        linked = np.flatnonzero((label >= 0) & (label != np.arange(len(rep))))
        return rep[label[linked]], rep[linked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(cols):
            u, v = links(*cols)
            return pa.RecordBatch.from_arrays([R.long_array(u), R.long_array(v)], names=["u", "v"])

        pair, held = None, None
        for b in batches:
            if b.num_rows == 0:
                continue
            key = b.column(0).to_numpy()
            cols = [b.column(k).to_numpy() for k in range(1, 5)]
            bytes_ = b.column(5).to_pylist()
            cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            for x, y in zip(cut[:-1], cut[1:], strict=True):
                part = [*(c[x:y] for c in cols), bytes_[x:y]]
                if held is not None and pair == key[x]:
                    held = [*(np.concatenate([p, q]) for p, q in zip(held[:4], part[:4], strict=True)), held[4] + part[4]]
                    continue
                if held is not None:
                    yield out(held)
                pair, held = key[x], part
        if held is not None:
            yield out(held)
    return run


def _alike(percent: int):
    """Estimate and size of two lists of signatures, as for the members of a small node."""
    def likes(n, m, x, y):
        x, y = (np.frombuffer(b"".join(z), np.uint32).reshape(len(z), COORDINATES) for z in (x, y))
        same = np.zeros((len(x), len(y)), np.uint8)
        for k in range(COORDINATES):
            same += x[:, k, None] == y[None, :, k]
        return (same >= ESTIMATE * COORDINATES) & (100 * np.minimum(n[:, None], m[None, :]) >= percent * np.maximum(n[:, None], m[None, :]))
    return likes


def _similar(percent: int):
    """100 * intersection >= percent * union, on two lists of full sets."""
    def likes(n, m, x, y):
        sets = [np.frombuffer(z, np.uint64) for z in x + y]
        owner = np.repeat(np.arange(len(sets)), [len(z) for z in sets])
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        again = times[column] > 1
        owner, column = owner[again], (np.cumsum(times > 1) - 1)[column[again]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros((len(x), len(y)), np.int64)
        last = int(column[-1]) + 1 if len(column) else 0
        for c in range(0, last, COLUMNS):  # dense products of 0 and 1: exact
            i, j = np.searchsorted(column, [c, c + COLUMNS])
            dense = np.zeros((len(sets), COLUMNS), np.float32)
            dense[owner[i:j], column[i:j] - c] = 1
            common += (dense[:len(x)] @ dense[len(x):].T).astype(np.int64)
        return 100 * common >= percent * (n[:, None] + m[None, :] - common)
    return likes


def _open_links(open_: DataFrame, reps: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect all pairs of ``open_`` of different classes and a similarity of ``percent`` or more."""
    parts = int(open_.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compared(rows, weight, limit, content, likes):
        met = _block_pairs(rows, weight, limit).join(content, F.col("rep") == F.col("r"))
        return (met.select("pair", "side", "rep", "n", "cls", "held").repartition(parts, "pair").sortWithinPartitions("pair")
                .mapInArrow(handing_back(_stars(likes)), "u long, v long"))

    # Written first: a task that compared and contracted its links too would hold two Python workers.
    maybe = stage(compared(open_, F.lit(1), BLOCK_MEMBERS, reps.select(F.col("rep").alias("r"), F.col("sig").alias("held")), _alike(percent)), "minhash-maybe")
    groups = components(maybe, "minhash-groups")
    discard(maybe)
    rows = (groups.join(reps.select("rep", "n"), F.col("node") == F.col("rep"))
            .join(classes, F.col("rep") == F.col("member"), "left")
            .select(F.col("component").alias("grp"), _size_class().alias("k"), "rep", "n", F.coalesce("class", "rep").alias("cls")))
    return compared(_most_frequent(rows), F.col("n") + MEMBER, BLOCK_SHINGLES, sets.select(F.col("rep").alias("r"), F.col("set").alias("held")), _similar(percent))


def _joined(links: DataFrame, classes: DataFrame | None) -> DataFrame:
    if classes is not None:
        links = links.unionByName(classes.select(F.col("member").alias("u"), F.col("class").alias("v")))
    return components(links, "minhash-classes").withColumnsRenamed({"node": "member", "component": "class"})


def near_duplicates(docs: DataFrame, percent: int = 75, shingle: int = SHINGLE, trees: int = TREES,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_shingles, component_id (smallest doc_id reachable over confirmed links), kept.
    ``percent`` must be 67 or more for the stated recall."""
    texts = keyed_texts(docs, id_col, text_col)
    sketches = stage(texts.mapInArrow(handing_back(_sketches(shingle)), "doc_id long, n long, d1 long, d2 long, sig binary"), "minhash-sketches")
    reps = stage(sketches.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig")), "minhash-reps")
    small, large = _tree_nodes(reps, trees)
    members = stage(_members(large), "minhash-members")
    discard(large)
    any_large = not members.isEmpty()
    tried = classes = sets = None
    for round_ in range(1, ROUNDS + 1):
        found = stage(_small_pairs(small, reps, classes, percent), "minhash-candidates") if round_ <= 2 else None
        if round_ > 2 and not any_large:
            break
        pairs = found.where("u <> v") if found is not None else None
        if any_large:
            leaders = _leader_pairs(members, classes, round_, percent)
            pairs = leaders if pairs is None else pairs.unionByName(leaders)
        pairs = pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried.withColumnsRenamed({"u": "tu", "v": "tv"}), (F.col("u") == F.col("tu")) & (F.col("v") == F.col("tv")), "left_anti")
        pairs = stage(pairs, "minhash-pairs")
        if round_ == 1:
            wanted = found.select(F.col("u").alias("rep")).unionByName(members.select("rep")).distinct()
            sets = stage(_sets(texts, wanted, shingle), "minhash-sets")
        elif pairs.isEmpty():
            break
        new = stage(_confirm(pairs, sets, percent), "minhash-links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        if round_ > 2 and new.isEmpty():
            break
        if round_ == 1 or not new.isEmpty():
            classes = _joined(new, classes)
    if any_large:  # the rounds' draws may have missed pairs: compare all that still cross classes
        open_ = stage(_open_nodes(members, classes), "minhash-open-nodes")
        if not open_.isEmpty():
            new = stage(_open_links(open_, reps, classes, sets, percent), "minhash-links")
            if not new.isEmpty():
                classes = _joined(new, classes)
    discard(sets, small, members)
    own = (sketches.where("n > 0").select("doc_id", "n", "d1", "d2")
           .join(reps.select(F.col("n").alias("rn"), F.col("d1").alias("r1"), F.col("d2").alias("r2"), "rep"),
                 (F.col("n") == F.col("rn")) & (F.col("d1") == F.col("r1")) & (F.col("d2") == F.col("r2")))
           .select("doc_id", "n", "rep").join(classes, F.col("rep") == F.col("member"), "left")
           .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class", "rep").alias("component_id")))
    alone = sketches.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    out = own.unionByName(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))
    return null_ids(out, "doc_id", "component_id")


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The documents, unchanged, that are the first of their class; rows repeating a doc_id stay or go together."""
    gone = (near_duplicates(docs, id_col=id_col, text_col=text_col, **kw).where(~F.col("kept"))
            .select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_gone")).distinct())
    return docs.join(gone.hint("shuffle_hash"), F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)) == gone["_gone"], "left_anti")
