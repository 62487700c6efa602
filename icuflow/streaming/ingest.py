"""Incremental (Structured Streaming) form of the event preparation.

Not a new operator: the same window, typing, grouping and outlier steps as
the batch job, applied to event files as they arrive.  The ICU start times
are a static table (stream-static join), so the per-event work is stateless
and every micro-batch appends its cleaned rows to a Parquet sink.  The
hourly mean (A5) is also offered as an event-time aggregation with a
watermark for continuous feeds, so its state stays bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dictionary as D
from ..operators import clean, windows
from ..session import persist, shuffle_partitions


def read_event_stream(spark: SparkSession, directory: str, schema, glob: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files under ``directory`` as an unbounded table (explicit schema).

    A single file is read as the only match in its folder.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isFile():
        directory, glob = path.getParent().toString(), path.getName()
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(directory)


def clean_event_stream(chart: DataFrame, stays: DataFrame, hours: float, items: Iterable[str] | None = None,
                       groups: Mapping[str, Iterable[str]] = D.ITEM_GROUPS, unit_rules=D.UNIT_RULES,
                       codes: Sequence[tuple[str, str]] = D.CATEGORY_CODES,
                       rules=D.OUTLIER_RULES_13, partition_static: bool = True) -> DataFrame:
    """Streaming chart events -> cleaned, grouped events of the first ``hours`` of the stay.

    ``stays`` (hadm_id, intime) is static; each micro-batch joins against it.
    Micro-batches are planned without adaptive execution, so a large static
    side would be shuffled again by every batch.  It is therefore
    hash-partitioned on the admission key once and cached (MEMORY_AND_DISK):
    a sort-merge join then shuffles only the batch's own rows, and a small
    static side is still broadcast.
    """
    if partition_static:
        spark = stays.sparkSession
        stays = persist(stays.select("hadm_id", "intime").repartition(shuffle_partitions(spark), "hadm_id"))
    w = windows.chart_window(chart, stays, hours, items)
    typed = clean.type_chart_events(w.select(*clean.EVENT_COLUMNS), clean.EVENT_COLUMNS, codes, unit_rules)
    return clean.drop_outliers(clean.assign_groups(typed, "itemid", groups), rules)


def hourly_mean_stream(events: DataFrame, watermark: str = "2 hours", hadm: str = "hadm_id",
                       item: str = "itemid", time_col: str = "charttime", value: str = "value") -> DataFrame:
    """A5 on a stream: mean per (admission, item, event-time hour).

    The watermark bounds the state: an hour is final (and emitted in append
    mode) once event time has passed its end plus the allowed lateness.
    """
    return (events.withWatermark(time_col, watermark)
            .groupBy(hadm, item, F.window(time_col, "1 hour").alias("hour"))
            .agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n"))
            .select(hadm, item, F.col("hour.start").alias("hour_start"), value, "n"))


def run_available(sdf: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                  batch_fn: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Process everything available now into a Parquet sink, then read the sink.

    The checkpoint folder records offsets and commits, so a restart after a
    failure neither loses nor duplicates micro-batches.
    """
    w = sdf.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if batch_fn is not None:
        q = w.foreachBatch(batch_fn).trigger(availableNow=True).start()
    else:
        q = w.format("parquet").option("path", path).trigger(availableNow=True).start()
    q.awaitTermination()
    return sdf.sparkSession.read.parquet(path)
