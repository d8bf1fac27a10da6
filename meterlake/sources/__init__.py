"""Sources and sinks: raw CSV, the curated Parquet table, the stand-in readings."""
from .raw import RAW_HEADERS, RENAMES, read_raw_csv, normalize_columns
from .standin import standin_readings, standin_raw_frame, as_raw_frame, events_readings, load_table
from .curated import (
    write_curated, read_curated, register_table, write_clean_csv, write_table,
    partition_predicate,
)

__all__ = [
    "RAW_HEADERS", "RENAMES", "read_raw_csv", "normalize_columns", "standin_readings",
    "standin_raw_frame", "as_raw_frame", "events_readings", "load_table", "write_curated", "read_curated",
    "register_table", "write_clean_csv", "write_table", "partition_predicate",
]
