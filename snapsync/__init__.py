"""Snapshots of database tables, copied with Spark."""

from snapsync.operators.copy import copy_all, failed_tables
from snapsync.operators.sink import read_snapshot
from snapsync.options import CatalogTarget, ConnectorTarget, CopyOptions, FileTarget, load_settings
from snapsync.sources.files import FileSource
from snapsync.sources.jdbc import JdbcSource

__all__ = [
    "CatalogTarget",
    "ConnectorTarget",
    "CopyOptions",
    "FileSource",
    "FileTarget",
    "JdbcSource",
    "copy_all",
    "failed_tables",
    "load_settings",
    "read_snapshot",
]
