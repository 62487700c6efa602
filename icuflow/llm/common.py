"""Helpers shared by the text operators: batches of whole texts as byte arrays, stage files."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts are processed in groups of about this many bytes, so that the arrays a
# task holds stay small however many rows Spark puts in an Arrow batch.  One
# longer text forms a group of its own and is still processed whole.
GROUP_BYTES = 1 << 20


# Stands for a null id inside an operator, whose arrays hold plain integers.
NULL_ID = -(1 << 63)


def keyed_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) under fixed names; every other column is left out of the scan."""
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col(text_col).alias("text"))


def null_ids(df: DataFrame, *cols: str) -> DataFrame:
    """Give null ids back as null."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(NULL_ID)) for c in cols or ("doc_id",)})


def text_groups(batches: Iterator[pa.RecordBatch], group_bytes: int = GROUP_BYTES
                ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (ids, bytes, offsets) of groups of whole texts; a null text counts as empty."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = batch.column(batch.schema.get_field_index("text")).fill_null("").cast(pa.large_string())
        ids = batch.column(batch.schema.get_field_index("doc_id")).to_numpy(zero_copy_only=False)
        buffers = texts.buffers()
        n = len(texts)
        offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
        data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
        first = 0
        while first < n:
            last = int(np.searchsorted(offsets, offsets[first] + group_bytes, side="right")) - 1
            last = min(max(last, first + 1), n)
            yield ids[first:last], data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
            first = last


@functools.cache
def _c_library():
    """The process's own C library, if it has glibc's ``malloc_trim``."""
    try:
        lib = ctypes.CDLL(None)
        return lib if hasattr(lib, "malloc_trim") else None
    except (OSError, TypeError):
        return None


def return_memory() -> None:
    """Give memory that Arrow and numpy have freed back to the system."""
    pa.default_memory_pool().release_unused()
    if _c_library() is not None:
        _c_library().malloc_trim(0)


def handing_back(run):
    """``run``, a function for ``mapInArrow``, which returns its memory when it ends.  A Python worker outlives its
    task and waits for another one; without this it would go on holding the most that any of its tasks had."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        return_memory()
    return task


def row_filter(df: DataFrame, text_col: str, judge, setup=lambda: None) -> DataFrame:
    """Rows of ``df``, unchanged, whose text ``judge(state, bytes, offsets)`` marks True; ``setup`` makes each
    task's state.  Rows are judged where they lie: no join, so repeated ids and other columns do not matter."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup()
        for b in batches:
            texts = pa.RecordBatch.from_arrays([pa.array(np.arange(b.num_rows)), b.column(at)], names=["doc_id", "text"])
            marks = [np.asarray(judge(state, data, offsets), bool) for _, data, offsets in text_groups([texts])]
            yield b.filter(pa.array(np.concatenate([*marks, np.zeros(0, bool)])))

    return df.mapInArrow(handing_back(run), df.schema)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: lineage is cut, and a
    lost executor costs a re-read.  Shuffle files of the finished job are then released."""
    from icuflow.session import scratch_path  # only here: tasks load this module without the rest of the library
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    release(spark)
    return out


def discard(*staged: DataFrame) -> None:
    """Delete stage files whose content later stages hold already."""
    for df in staged:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stage_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files that no live DataFrame refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def apart(column: str) -> Column:
    """The same key under another expression.  A join on it exchanges both sides anew, so that adaptive
    execution can split a frequent key; reusing an aggregation's partitioning would pin it to one task."""
    return F.col(column).bitwiseXOR(F.lit(1).cast("long"))


def crc_bucket(id_col: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``: the fold of a row."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(buckets)


def bounded_sample(df: DataFrame, id_col: str, bound: int, salt: int = 0) -> DataFrame:
    """At most ``bound`` rows, chosen by a hash of the id: a repeatable sample for fitting."""
    return df.orderBy(F.xxhash64(F.col(id_col), F.lit(salt)), F.col(id_col)).limit(bound)


def starts_of(offsets: np.ndarray) -> np.ndarray:
    """Owner index of each byte of a group."""
    return np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
