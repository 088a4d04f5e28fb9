"""Sources: driver Parquet tables, the profiles view, CSV with quarantine."""

from plumage.sources.csv import bad_rows, good_rows, malformed_report, read_csv, scan_with_quarantine
from plumage.sources.tables import TABLES, load_table, profiles

__all__ = [
    "TABLES",
    "bad_rows",
    "good_rows",
    "load_table",
    "malformed_report",
    "profiles",
    "read_csv",
    "scan_with_quarantine",
]
