import random
import re

import numpy as np
import pytest

from icuflow.llm import components, minhash_dedup

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = _WORD.findall(t)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows, percent=75):
    """All pairs on full sets, found through shared shingles, and union-find."""
    sets = {}
    for d, t in rows:
        sets.setdefault(d, shingles(t))
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by = {}
    for d, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(d)
    seen = set()
    for ds in by.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    x, y = sets[a], sets[b]
                    if 100 * len(x & y) >= percent * len(x | y):
                        p, q = sorted((root(a), root(b)))
                        parent[q] = p
    least = {}
    for d in sorted(sets):
        least.setdefault(root(d), d)
    return {d: (len(s), least[root(d)], least[root(d)] == d) for d, s in sets.items()}


def got(df):
    return {r[0]: (r[1], r[2], r[3]) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()}


def corpus(seed, groups=12, size=8, hot=0):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("ab cd ef gh ij kl mn op qr st".split()) + str(rnd.randint(0, 200))
    rows, k = [], 0
    for g in range(groups):
        base = [word() for _ in range(rnd.randint(3, 150))]
        for _ in range(hot if g == 0 and hot else rnd.randint(1, size)):
            t = list(base)
            for _ in range(rnd.randint(0, max(1, len(t) // 25))):
                t[rnd.randrange(len(t))] = word()
            rows.append((k, rnd.choice([" ", "\n", "  "]).join(x.upper() if rnd.random() < 0.1 else x for x in t)))
            k += rnd.randint(1, 3)
    rnd.shuffle(rows)
    return rows + [(100000, None), (100001, ""), (100002, " \n"), (100003, "one two"), (100004, "ONE  two")]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(minhash_dedup.near_duplicates(df)) == brute(rows)


def test_large_nodes_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "NODE", 4)
    monkeypatch.setattr(minhash_dedup, "PAIRS_A_COPY", 5)
    rows = corpus(3, groups=4, size=6, hot=60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(minhash_dedup.near_duplicates(df)) == brute(rows)


def family(members, planted):
    """Members of similarity 196 / 272 = 0.72 to each other: a common text with a tail each; of each planted pair
    the tails share 6 to 9 words, for 0.76 to 0.78."""
    base = " ".join(f"b{i}" for i in range(200))
    rows = []
    for k in range(members):
        tail = [f"t{k}x{i}" for i in range(38)]
        if k % 2 and k // 2 < planted:
            shared = 6 + k // 2 % 4
            tail[:shared] = [f"t{k - 1}x{i}" for i in range(shared)]
        rows.append((k, base + " " + " ".join(tail)))
    random.Random(5).shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 100])
def test_pairs_that_meet_only_in_large_nodes(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK_MEMBERS", block)
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", block * 700)
    few = family(40, 6)
    assert sum(c != d for d, (_, c, _) in brute(few).items()) == 6
    members, planted = 700, 60
    df = spark.createDataFrame(family(members, planted), "doc_id long, text string").repartition(3)
    want = {k: (234, k - (k % 2 if k // 2 < planted else 0)) for k in range(members)}
    assert {d: x[:2] for d, x in got(minhash_dedup.near_duplicates(df)).items()} == want


def test_empty_table_null_and_repeated_ids_and_extra_columns(spark):
    assert got(minhash_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))) == {}
    t = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, t, 1), (5, t + " x", 1), (9, "other words", 1), (9, "other words", 1)], "doc_id long, text string, rep int")
    assert got(minhash_dedup.near_duplicates(df)) == {None: (36, None, True), 5: (37, None, False), 9: (1, 9, True)}
    kept = minhash_dedup.keep(df)
    assert kept.columns == df.columns and sorted(r["text"] for r in kept.collect()) == ["other words", "other words", t]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 300), (50, 50)] + [(500 + i, 500) for i in range(1, 30)]
    out = {r[0]: r[1] for r in components.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert all(out[i] == 1 for i in range(2, 41)) and out[200] == out[300] == 100 and out[529] == 500


def test_query_against_brute_force_on_the_driver_table(spark):
    from icuflow.llm import queries
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got(queries.op1_minhash_dedup(spark, sf)) == brute([tuple(r) for r in docs])


def thue_morse(bits, letters):
    a, b = letters
    for _ in range(bits):
        a, b = a + b, b + a
    return a, b


def test_words_whose_power_sums_are_equal_are_different_words(spark):
    """Thue-Morse words collide under any sum of powers modulo 2^64; alone and among others they stay apart."""
    rows = []
    for k, letters in enumerate(("ab", "xy", ("\u00e4", "\u00f6"))):
        one, two = thue_morse(11, letters)
        rows += [(10 * k, one), (10 * k + 1, two), (10 * k + 2, one), (10 * k + 3, f"a b c d {one} f g"), (10 * k + 4, f"a b c d {two} f g")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(minhash_dedup.near_duplicates(df)) == brute(rows)
    assert [r for r in got(minhash_dedup.near_duplicates(df)).values()].count((1, 0, True)) == 1


def test_a_lower_percent_also_lowers_the_size_filter(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(words[:104])), (2, " ".join(words[:76])), (3, " ".join(words[200:300])), (4, " ".join(words[200:273]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 70)
    assert want[2][1] == 1 and got(minhash_dedup.near_duplicates(df, percent=70)) == want and got(minhash_dedup.near_duplicates(df)) == brute(rows)
    monkeypatch.setattr(minhash_dedup, "NODE", 1)  # by way of the large nodes
    assert got(minhash_dedup.near_duplicates(df, percent=70)) == want


def test_open_nodes_carry_their_most_frequent_class(spark):
    """Node 1 is open, node 2 has its members again, node 3 is of one class, node 4 is open by a member without links:
    each row meets its node once and comes out with its node's most frequent class marked."""
    nodes = {1: [10, 11, 12, 13], 2: [10, 11, 12, 13], 3: [10, 11], 4: [10, 11, 14], 5: [12, 13]}
    of = {r: sorted(g for g, m in nodes.items() if r in m) for r in range(10, 15)}
    members = spark.createDataFrame([(r, 20, g) for r, g in of.items()], "rep long, n long, nodes array<long>")
    classes = spark.createDataFrame([(10, 10), (11, 10), (12, 10)], "member long, class long")
    rows = minhash_dedup._open_nodes(members, classes)
    got_ = sorted((r["grp"], r["rep"], r["cls"], r["main"]) for r in rows.select("grp", "rep", "cls", "main").collect())
    assert [x for x in got_ if x[0] in (1, 2)] == [(1, 10, 10, True), (1, 11, 10, True), (1, 12, 10, True), (1, 13, 13, False)]
    assert [x for x in got_ if x[0] == 4] == [(4, 10, 10, True), (4, 11, 10, True), (4, 14, 14, False)]
    assert {r for r in got_ if r[0] == 5} == {(5, 12, 10, False), (5, 13, 13, True)} and not [x for x in got_ if x[0] == 3]


def least_reached(links):
    near = {}
    for u, v in links:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    out = {}
    for first in sorted(near):
        front = [] if first in out else [first]
        while front:
            x = front.pop()
            if x not in out:
                out[x] = first
                front += near[x]
    return out


@pytest.mark.parametrize("at_once", [1 << 18, 4])
def test_components_of_one_task_and_of_star_rounds(spark, monkeypatch, at_once):
    """Every node of a link comes out once, the smallest of its component too."""
    monkeypatch.setattr(components, "LINKS", at_once)
    rnd = random.Random(9)
    links = [(rnd.randrange(-150, 150), rnd.randrange(-150, 150)) for _ in range(130)] + [(300 + i, 301 + i) for i in range(60)] + [(400, 400 + i) for i in range(1, 40)]
    links = [(u, v) for u, v in links if u != v]
    rows = components.components(spark.createDataFrame(links + links[:20] + [(7000, 7000)], "u long, v long").repartition(7)).collect()
    assert len(rows) == len({r["node"] for r in rows}) and {r["node"]: r["component"] for r in rows} == least_reached(links)


def test_links_that_a_task_holds_take_no_rounds(spark, monkeypatch):
    """A long chain over many partitions is written twice: as each task's stars, and as components."""
    written, stage = [], components.stage
    monkeypatch.setattr(components, "stage", lambda df, name: written.append(name) or stage(df, name))
    out = components.components(spark.createDataFrame([(i, i + 1) for i in range(500)], "u long, v long").repartition(16))
    assert len(written) == 2 and {r["component"] for r in out.collect()} == {0} and out.count() == 501


def test_the_first_member_of_a_group_of_open_members_is_compared_too(spark):
    """Two open members of equal signatures and a similarity of 95 / 105: the smaller names their group and is in it."""
    sets = {rep: np.array([*range(95), *range(base, base + 5)], np.uint64) for rep, base in ((3, 1000), (8, 2000))}
    sig = bytes(4 * minhash_dedup.COORDINATES)
    open_ = spark.createDataFrame([(1, 11, rep, 100, rep, rep == 3) for rep in sets], "grp long, k long, rep long, n long, cls long, main boolean")
    reps = spark.createDataFrame([(rep, 100, sig) for rep in sets], "rep long, n long, sig binary")
    classes = spark.createDataFrame([], "member long, class long")
    full = spark.createDataFrame([(rep, s.tobytes()) for rep, s in sets.items()], "rep long, set binary")
    assert {frozenset(r) for r in minhash_dedup._open_links(open_, reps, classes, full, 75).collect()} == {frozenset((3, 8))}
    assert minhash_dedup._open_links(open_, reps, classes, full, 95).collect() == []
