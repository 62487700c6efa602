"""Global positions over a total order, fully distributed.

Spark's window functions without ``PARTITION BY`` move every row into one
task (H13).  This operator instead:

1. range-partitions the rows on the order and sorts inside each partition
   (one shuffle, balanced by sampling);
2. checkpoints that layout to the shared checkpoint folder, so every later
   job sees identical partitions even after an executor is lost;
3. aggregates one total row per partition (at most ``num_partitions`` rows,
   a bounded summary) and turns them into per-partition offsets;
4. adds offset and local position inside the JVM, without another shuffle.

Used for splits and folds along orders other than (hash, key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint, shuffle_partitions


ROWS_PER_PARTITION = 2_000_000
_ORDERABLE = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
              T.BinaryType)
MIN_ROWS_PER_TASK = 50_000


def partitions_for(rows: int | None, spark) -> int:
    """Range partitions for ``rows`` rows.

    About ``ROWS_PER_PARTITION`` rows each at scale (the count grows with the
    data, no upper cap), but at least one task per core of
    ``spark.sql.shuffle.partitions`` while tasks keep ``MIN_ROWS_PER_TASK``
    rows; tiny inputs get one partition.  Unknown sizes use the shuffle
    partition setting.
    """
    base = shuffle_partitions(spark)
    if rows is None:
        return base
    rows = int(rows)
    by_size = -(-rows // ROWS_PER_PARTITION)
    by_cores = min(base, -(-rows // MIN_ROWS_PER_TASK))
    return max(1, by_size, by_cores)


def with_prefix(df: DataFrame, order: Sequence[Column | str], index_col: str = "pos", num_partitions: int | None = None, rows: int | None = None,
                unique_order: bool = False) -> DataFrame:
    """Add a 0-based global ``index_col`` along ``order``.

    Put a unique tie-breaker last in ``order`` when positions must be reproducible.
    ``rows`` (if known) sizes the range partitions.  ``unique_order=True``
    states that no two rows tie on ``order`` (e.g. one row per key after a
    group-by), which makes the row-id tie-breaker unnecessary.
    """
    n = num_partitions or partitions_for(rows, df.sparkSession)
    # A row id as last sort key: rows that tie on ``order`` (a hot value may
    # hold a third of the data) still get distinct range keys, so the range
    # partitioner can spread them over several partitions.  The id is taken
    # after a local sort on the order and every sortable column (no shuffle):
    # the rows of an input partition are fixed, so a task re-run after an
    # executor loss numbers them the same way and sends every row to the same
    # range partition as before (identical rows are interchangeable).
    base = df
    if not unique_order:
        named = {o for o in order if isinstance(o, str)}
        sortable = [f.name for f in df.schema.fields if isinstance(f.dataType, _ORDERABLE) and f.name not in named]
        base = df.sortWithinPartitions(*order, *sortable).withColumn("_tb", F.monotonically_increasing_id())
        order = [*order, F.col("_tb")]
    ranged = reliable_checkpoint(base.repartitionByRange(n, *order).sortWithinPartitions(*order)).drop("_tb")

    totals = (ranged.groupBy(F.spark_partition_id().alias("_pid"))
              .agg(F.count(F.lit(1)).alias("_n")).collect())
    totals = sorted(totals, key=lambda r: r["_pid"])
    offsets: dict[int, int] = {}
    run = 0
    for r in totals:
        offsets[r["_pid"]] = run
        run += r["_n"]

    # Inside a checkpointed partition the row order is fixed, so
    # monotonically_increasing_id() encodes (partition id << 33) + local
    # position deterministically.  The offsets table has one row per partition
    # (bounded by the partition count), so broadcasting it is safe at any size.
    offs = ranged.sparkSession.createDataFrame([(int(p), int(o)) for p, o in offsets.items()], "_pid int, _off long")
    with_id = (ranged.withColumn("_mid", F.monotonically_increasing_id())
               .withColumn("_pid", F.shiftright(F.col("_mid"), 33).cast("int")))
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (with_id.join(F.broadcast(offs), on="_pid", how="left")
            .withColumn(index_col, (F.coalesce(F.col("_off"), F.lit(0)) + local).cast("long"))
            .drop("_mid", "_pid", "_off"))
