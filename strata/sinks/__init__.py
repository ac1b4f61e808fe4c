"""Writes: snapshots published whole, value partitions, exports, retention."""

from strata.sinks.writes import (  # noqa: F401
    delete_layer, drop_partitions, export_csv, path_exists, read_csv, retain_snapshots, stage,
    unstage, write_partitioned, write_snapshot, write_snapshots, write_table,
)
