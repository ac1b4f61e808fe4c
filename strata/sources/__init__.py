"""Scans: tables, snapshots and the paged record source."""

from strata.sources.scans import (  # noqa: F401
    list_snapshots, read_json_records, read_snapshot, read_table, union_all,
)
