"""Sources and sinks: header CSV, ``::``-delimited records, ragged baskets."""

from quarry.sources.text import (
    parse_delimited_records,
    read_delimited_records,
    read_header_csv,
    read_ragged_baskets,
    with_line_ids,
    write_csv_lines,
    write_delimited_records,
    write_header_csv,
    write_ragged_baskets,
)
from quarry.sources.tables import load_table

__all__ = [
    "load_table", "parse_delimited_records", "read_delimited_records", "read_header_csv", "read_ragged_baskets",
    "with_line_ids", "write_csv_lines", "write_delimited_records", "write_header_csv", "write_ragged_baskets",
]
