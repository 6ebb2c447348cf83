"""Rows as lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapsync.functions.names import quoted


# Fixed value: the cell width of a rendered row.
CELL_WIDTH = 50


def render_fixed_width(df: DataFrame, width: int = CELL_WIDTH) -> DataFrame:
    """One ``line`` per row: its cells, left-aligned and padded to ``width``.

    A NULL shows as ``null``; a longer value is kept whole. The lines are ready for
    ``write.text``.
    """
    cells = [
        F.format_string(f"%-{width}s", F.col(quoted(c)).cast("string")) for c in df.columns
    ]
    return df.select(F.concat(*cells).alias("line"))
