"""Sources and sinks."""

from .csv import infer_table_name, load_csv_table, write_csv, write_stage
from .tables import register_views, table

__all__ = ["infer_table_name", "load_csv_table", "write_csv", "write_stage", "register_views", "table"]
