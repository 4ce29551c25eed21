"""Sources and sinks: delimited text, tables, models, reports."""

from linclass.sources.delimited import (
    CORRUPT,
    Header,
    header_of,
    lines_from_table,
    load_csv_inferred,
    load_delimited,
    parse_lines,
    read_header,
    read_lines,
)
from linclass.sources.models import load_model, save_model, timestamped_path
from linclass.sources.reports import write_tables

__all__ = [
    "CORRUPT",
    "Header",
    "header_of",
    "lines_from_table",
    "load_csv_inferred",
    "load_delimited",
    "load_model",
    "parse_lines",
    "read_header",
    "read_lines",
    "save_model",
    "timestamped_path",
    "write_tables",
]
