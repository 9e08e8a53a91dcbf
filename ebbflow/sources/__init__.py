"""Scans, sinks and materialised layers."""

from ebbflow.sources.delimited import conform, read_movement_files, scan_delimited
from ebbflow.sources.files import file_name_fields, list_files
from ebbflow.sources.layers import materialise, shared_folder
from ebbflow.sources.naming import from_published, to_published
from ebbflow.sources.sinks import (
    read_table,
    readback_report,
    store_metrics,
    upsert_metrics,
    write_months,
    write_partitioned,
    write_report,
    write_table,
)

__all__ = [
    "conform",
    "file_name_fields",
    "from_published",
    "list_files",
    "materialise",
    "read_movement_files",
    "read_table",
    "readback_report",
    "scan_delimited",
    "shared_folder",
    "store_metrics",
    "to_published",
    "upsert_metrics",
    "write_months",
    "write_partitioned",
    "write_report",
    "write_table",
]
