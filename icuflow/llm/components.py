"""Connected components of a table of links by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import apart, discard, handing_back, stage

# A task contracts this many links at a time: a few MB of arrays.
LINKS = 1 << 18


def _least(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links (u, v), each with the smallest that it reaches over them."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        if np.array_equal(x, y):
            break
        least = np.minimum(x, y)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while not np.array_equal(up := label[label], label):
            label = up
    return nodes, nodes[label]


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (u > v) that connect what the links (u, v) connect."""
    node, least = _least(u, v)
    return node[node != least], least[node != least]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u > v) that connect what a task's links connect; repeated links and cycles go."""
    u = v = np.zeros(0, np.int64)

    def out():
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    for b in batches:
        u, v = (np.concatenate([x, b.column(k).to_numpy()]) for k, x in enumerate((u, v)))
        if len(u) >= LINKS:
            u, v = _stars(u, v)
            if len(u) > LINKS // 2:
                yield out()
                u = v = np.zeros(0, np.int64)
    u, v = _stars(u, v)
    yield out()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of links that are no more than a task contracts at a time."""
    u, v = (np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 2, *((b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches), strict=True))
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _least(u, v)], names=["node", "component"])


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame, near: DataFrame) -> DataFrame:
    least = near.select(apart("u").alias("w"), F.least("u", "m").alias("m"))
    return _both(edges).where("v > u").join(least, apart("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(down: DataFrame) -> DataFrame:
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least.select(apart("u").alias("w"), "m"), apart("u") == F.col("w"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(u, v) links to (node, component): the smallest node reachable, for every node that has a link.

    Each task contracts the links that it reads, ``LINKS`` at a time.  While more than ``LINKS`` are left, star
    rounds over the whole table go on: a hub's rows are joined, never gathered, and each round is written to the
    shared folder.  Rounds grow with the logarithm of a component's size at most; they end when every node has
    the smallest of its component as its only smaller neighbour or has none, or when the rest is one task's.
    """
    edges = stage(links.select("u", "v").where("u <> v").mapInArrow(handing_back(_contract), "u long, v long"), name)
    while True:
        if edges.count() <= LINKS:
            out = stage(edges.coalesce(1).mapInArrow(handing_back(_whole), "node long, component long"), name)
            discard(edges)
            return out
        near = stage(_both(edges).groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most")), name)
        if near.where("m < u and most <> m").isEmpty():
            discard(edges)
            return near.select(F.col("u").alias("node"), F.least("u", "m").alias("component"))
        down = stage(_large_star(edges, near), name)
        new = stage(_small_star(down), name)
        discard(edges, near, down)
        edges = stage(new.mapInArrow(handing_back(_contract), "u long, v long"), name)
        discard(new)
