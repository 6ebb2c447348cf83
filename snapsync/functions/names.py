"""Names of target tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date format of dated target names.
DATE_FORMAT = "yyyyMMdd"


def quoted(name: str) -> str:
    """A Spark column or table name that survives dots and spaces."""
    return "`" + name.replace("`", "``") + "`"


def target_name(name: Column | str, prefix: str = "", dated: Column | str | None = None) -> Column:
    """``<prefix><name>``, with ``_<yyyyMMdd>`` of a date column if one is given.

    The date is an input, not today, so that a rerun finds the same table.
    """
    name = F.col(name) if isinstance(name, str) else name
    parts = [F.lit(prefix), name]
    if dated is not None:
        parts += [F.lit("_"), F.date_format(dated, DATE_FORMAT)]
    return F.concat(*parts)


def qualified_name(name: Column | str, database: str, project: str | None = None) -> Column:
    """``database.name`` or ``project:database.name``."""
    name = F.col(name) if isinstance(name, str) else name
    qualified = F.concat_ws(".", F.lit(database), name)
    return qualified if project is None else F.concat_ws(":", F.lit(project), qualified)
