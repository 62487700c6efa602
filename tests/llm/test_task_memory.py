import re

import numpy as np
import pyarrow as pa
import pytest

from icuflow.llm import common, components, minhash_dedup


def own_mb():
    with open("/proc/self/smaps_rollup") as f:
        return sum(map(int, re.findall(r"\n(?:Private_Dirty|Private_Clean|Swap):\s+(\d+)", f.read()))) / 1024


def test_a_task_hands_its_memory_back(spark):
    """A worker that has ended a task holds little more than before it, though a live value lies above what was freed."""
    def work(batches):
        for b in batches:
            many = [np.ones(8000) for _ in range(3000)]  # 192 MB in arrays too small for mappings of their own
            work.kept = np.ones(10)
            del many
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["id"])

    rows = [pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["id"])]
    before = own_mb()
    assert [b.num_rows for b in common.handing_back(work)(iter(rows))] == [2]
    if common._c_library() is None:
        pytest.skip("no malloc_trim here")
    assert own_mb() < before + 60


def python_chains(plan):
    """Python operators that take another one's rows inside the same stage: no exchange between them."""
    chains, above = 0, []
    for line in plan.splitlines():
        m = re.match(r"^([ :+\-|*()\d]*)(\w+)", line)
        if not m or not m[2][0].isupper():
            continue
        depth = len(m[1].replace("*", "").split("(")[0].rstrip())
        above = [a for a in above if a[0] < depth]
        if "MapInArrow" in m[2]:
            for _, name in reversed(above):
                if "Exchange" in name:
                    break
                if "MapInArrow" in name:
                    chains += 1
                    break
        above.append((depth, m[2]))
    return chains


def test_no_task_that_links_open_nodes_holds_two_python_workers(spark, monkeypatch):
    plans = []

    def spied(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return common.stage(df, name)

    monkeypatch.setattr(minhash_dedup, "stage", spied)
    monkeypatch.setattr(components, "stage", spied)
    sets = {1: range(40), 3: range(100, 140), 8: range(101, 141)}
    open_ = spark.createDataFrame([(1, 9, r, 40, r, False) for r in sets], "grp long, k long, rep long, n long, cls long, main boolean")
    reps = spark.createDataFrame([(r, 40, np.resize(np.array(x, np.uint32), 64).tobytes()) for r, x in sets.items()], "rep long, n long, sig binary")
    classes = spark.createDataFrame([(1, 1)], "member long, class long")
    full = spark.createDataFrame([(r, np.array(x, np.uint64).tobytes()) for r, x in sets.items()], "rep long, set binary")
    minhash_dedup._open_links(open_, reps, classes, full, 75)
    names = {n for n, _ in plans}
    assert "minhash-groups" in names
    assert [(n, p) for n, p in plans if python_chains(p)] == []
    # The measure itself sees a chain.
    two = open_.select("rep").mapInArrow(lambda b: b, "rep long").mapInArrow(lambda b: b, "rep long")
    assert python_chains(two._jdf.queryExecution().executedPlan().toString()) == 1
    assert python_chains(two.repartition(2, "rep").mapInArrow(lambda b: b, "rep long")._jdf.queryExecution().executedPlan().toString()) == 1
