"""Trip sources: text lines, CSV, Parquet."""

from tripmetrics.sources.readers import (
    csv_quality,
    from_rows,
    generic_schema,
    header_line,
    input_folders,
    listed_bytes,
    read_csv,
    read_csv_permissive,
    read_csv_records,
    read_lines,
    read_parquet,
    read_sketches,
    read_staged,
    read_trips,
    record_widths,
)
from tripmetrics.sources.scratch import scratch_path

__all__ = [
    "csv_quality",
    "from_rows",
    "generic_schema",
    "header_line",
    "input_folders",
    "listed_bytes",
    "read_csv",
    "read_csv_permissive",
    "read_csv_records",
    "read_lines",
    "read_parquet",
    "read_sketches",
    "read_staged",
    "read_trips",
    "record_widths",
    "scratch_path",
]
