"""Which tables of the catalog to copy."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapsync.options import CopyOptions
from snapsync.sources import catalog
from snapsync.sources.base import Opened, local_frame

log = logging.getLogger(__name__)


def select_tables(tables: DataFrame, options: CopyOptions) -> DataFrame:
    """All tables with a ``skip_reason``, NULL for those to copy.

    The first reason that holds counts: ``empty``, then ``not_whitelisted``, then
    ``blacklisted``. An empty list does not restrict anything. Names are compared
    in lower case on both sides.
    """
    name = F.lower("table_name")
    reason = F.when(F.col("table_rows") == 0, F.lit("empty"))
    if options.whitelist:
        reason = reason.when(~name.isin(sorted(options.whitelist)), F.lit("not_whitelisted"))
    if options.blacklist:
        reason = reason.when(name.isin(sorted(options.blacklist)), F.lit("blacklisted"))
    return tables.withColumn("skip_reason", reason)


def selected(tables: DataFrame) -> DataFrame:
    return tables.filter(F.col("skip_reason").isNull())


def listed(name: str, options: CopyOptions) -> bool:
    """Whether the allow and deny lists let a table through."""
    lower = name.lower()
    return lower not in options.blacklist and (
        not options.whitelist or lower in options.whitelist
    )


def check_empty_estimates(opened: Opened, tables: DataFrame, options: CopyOptions) -> DataFrame:
    """Row counts of zero that are only estimates, checked by looking for a row.

    A stale zero would otherwise leave a filled table out. Tables that the lists drop
    are not looked into. One that cannot be read counts as unknown: its copy will fail,
    and report why.
    """
    if not opened.probe_empty_estimates():
        return tables
    zeros = [r.table_name for r in tables.filter("table_rows = 0").select("table_name").collect()]

    def unknown(name: str) -> bool:
        if not listed(name, options):
            return True
        try:
            return not opened.read(name).isEmpty()
        except Exception as e:
            log.warning("no look into %s: %s", name, type(e).__name__)
            return True

    with ThreadPoolExecutor(max_workers=8) as pool:
        filled = [name for name, there in zip(zeros, pool.map(unknown, zeros)) if there]
    if not filled:
        return tables
    # NULL: count unknown.
    known = F.when(~F.col("table_name").isin(filled), F.col("table_rows"))
    return tables.withColumn("table_rows", known)


def chosen_tables(opened: Opened, options: CopyOptions, sizes: str = "stored") -> DataFrame:
    """The catalog's tables with a ``skip_reason``, collected once.

    The lists come first: only tables that they let through are measured.
    """
    tables = catalog.tables(opened, sizes, lambda name: listed(name, options))
    rows = select_tables(check_empty_estimates(opened, tables, options), options)
    return local_frame(opened.spark, rows.collect(), rows.schema)
