"""CSV sources and sinks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Fixed value: the name pattern of a table file.
_TABLE_NAME = re.compile(r"(\w+)(\.csv)?$")


def infer_table_name(path: str) -> str:
    """S3: view name from a path: last word before an optional ``.csv``."""
    m = _TABLE_NAME.search(path)
    return m.group(1) if m else path


def load_csv_table(spark: SparkSession, path: str, table_name: str | None = None,
                   schema: StructType | str | None = None) -> DataFrame:
    """Header CSV, comma separated, malformed rows dropped, view registered.

    Without ``schema`` every column is a string (header names); with a
    schema the columns are typed on read (no inference pass).  CSV column
    pruning is switched off for this read so that DROPMALFORMED judges
    whole rows even when only some columns are used later (H3).
    """
    reader = (spark.read.option("header", "true").option("mode", "DROPMALFORMED")
              .option("sep", ",").option("columnPruning", "false"))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    df.createOrReplaceTempView(table_name or infer_table_name(path))
    return df


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite a header CSV directory; one file only when asked."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").option("sep", ",").csv(path)


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate stage as Parquet and read it back.

    The re-read DataFrame has no lineage to the inputs, so a lost executor
    re-reads the stage files instead of recomputing the upstream joins.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
