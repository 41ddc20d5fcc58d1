"""Sources and sinks: driver-table fixture, typed CSV, text and pair files."""

from facturo.sources.bound import CsvScan, csv_headers, scan_csv_bound
from facturo.sources.files import (
    result_roundtrip,
    scan_csv_typed,
    scan_pairs,
    scan_text_lines,
    write_csv,
    write_pairs,
    write_parquet,
    write_text_lines,
)
from facturo.sources.fixture import RAW_SQL, invoice_lines, read_table

__all__ = [
    "CsvScan",
    "RAW_SQL",
    "csv_headers",
    "invoice_lines",
    "read_table",
    "result_roundtrip",
    "scan_csv_bound",
    "scan_csv_typed",
    "scan_pairs",
    "scan_text_lines",
    "write_csv",
    "write_pairs",
    "write_parquet",
    "write_text_lines",
]
