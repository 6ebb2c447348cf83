"""Targets brought in line with sources that were edited, range by range.

Source and target are cut into the same key ranges, and each range has a digest on either
side: how many rows, and a sum of their hashes that does not depend on order. Ranges that
differ are cut again, and only they are read again, until they are small. What then differs
is copied, as a part that stands for all rows of these ranges; the rest is not touched. So
rows that changed, came late, were deleted or got another key are found without a marker.

Of the rows only digests travel: one row a range and task. Both sides are read once whole,
then just their differing ranges, as filters that reach the files' statistics or the
database's index.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapsync.functions.checksums import DIGEST, digest
from snapsync.functions.names import quoted
from snapsync.operators.parts import Range, free_name, in_ranges

log = logging.getLogger(__name__)

FAN = 64  # ranges that the whole, and then each differing one, is cut into
LEAF_ROWS = 10_000  # a range of so many rows is copied rather than cut again
MOST = 256  # ranges that are filtered by: the nearest ones are joined beyond it
# Ranges that are cut again in a round, so that FAN times as many digests reach the driver. Were
# there more, those joined to MOST would hold nearly all that is between: they are copied uncut.
OPEN = 16 * MOST


def cut(low: int, high: int, n: int) -> list[tuple[int, int]]:
    """``low..high`` as up to ``n`` ranges of nearly one width."""
    n = min(n, high - low + 1)
    starts = [low + i * (high - low + 1) // n for i in range(n)] + [high + 1]
    return [(a, b - 1) for a, b in zip(starts, starts[1:])]


def _start(key: str, low: int, width: int, kind: str) -> Column:
    """The least key of the range that a row is in, of ranges of one width from ``low`` on."""
    k = F.col(quoted(key)).cast(kind)
    return k - (k - F.lit(str(low)).cast(kind)) % F.lit(str(width)).cast(kind)


def digests(df: DataFrame, key: str, start: Column) -> dict[int | None, tuple[int, ...]]:
    """The digest of each range that has rows, by its least key; that of NULL keys by None."""
    rows = df.groupBy(start.alias("start")).agg(*digest(df.schema)).collect()
    number = lambda k: None if k is None else int(k)
    return {number(r["start"]): tuple(r[c] for c in DIGEST) for r in rows}


def fewer(ranges: Sequence[Range], most: int = MOST) -> list[Range]:
    """Ranges in order, neighbours joined; the least gaps are closed until ``most`` are left."""
    found: list[list[int | None]] = []
    for low, high in ranges:
        if found and found[-1][1] + 1 == low:
            found[-1][1] = high
        else:
            found.append([low, high])
    if len(found) > most:
        gaps = sorted(range(1, len(found)), key=lambda i: found[i][0] - found[i - 1][1])
        closed = set(gaps[: len(found) - most])
        joined = [found[0]]
        for i, r in enumerate(found[1:], 1):
            if i in closed:
                joined[-1][1] = r[1]
            else:
                joined.append(r)
        found = joined
    return [tuple(r) for r in found]


def _within(df: DataFrame, key: str, ranges: Sequence[Range], start: Column) -> DataFrame:
    """The rows whose range, which begins at ``start``, is one of ``ranges``."""
    near = fewer(ranges, max(len(ranges), 1))
    rows = df.filter(in_ranges(key, fewer(near)))
    if len(near) <= MOST:
        return rows
    name = free_name(df.schema, "start")
    starts = df.sparkSession.createDataFrame([(str(a),) for a, _ in ranges], f"{name} string")
    return rows.join(F.broadcast(starts), start.cast("string") == F.col(name), "left_semi")


def differing(source: DataFrame, target: DataFrame, key: str, leaf_rows: int = LEAF_ROWS) -> list[Range]:
    """The ranges of the integral ``key`` in which the rows of both sides are not the same.

    NULL keys are in a range without a least key. Both sides have the same columns. The
    ranges of a round have one width, a power of two, so that a row's is found by its key
    alone, however many there are.
    """
    k = F.col(quoted(key))
    span = [F.min(k).cast("decimal(38,0)").alias("low"), F.max(k).cast("decimal(38,0)").alias("high")]
    spans = [df.agg(*span).first() for df in (source, target)]
    lows, highs = [int(s.low) for s in spans if s.low is not None], [int(s.high) for s in spans if s.low is not None]
    found: list[Range] = []
    low, high = (min(lows), max(highs)) if lows else (0, 0)
    kind = "bigint" if -(2**63) <= low and high < 2**63 and high - low < 2**63 else "decimal(38,0)"
    width = 1 << max((high - low).bit_length() - FAN.bit_length() + 1, 0)
    n = (high - low) // width + 1
    # NULL keys go with all that is below the first key, which is nothing.
    open_ranges: list[Range] = [(None, low - 1), *cut(low, low + n * width - 1, n)]
    sides = [source, target]
    while open_ranges:
        ours, theirs = (digests(df, key, _start(key, low, width, kind)) for df in sides)
        coarse: list[Range] = []
        most = 0
        for a, b in open_ranges:
            mine, other = ours.get(a), theirs.get(a)
            if mine == other:
                continue
            rows = max(mine[0] if mine else 0, other[0] if other else 0)
            if a is None or a == b or rows <= leaf_rows:
                found.append((a, min(b, high)))
            else:
                coarse.append((a, b))
                most = max(most, rows)
        if len(coarse) > OPEN:
            found, coarse = found + [(a, min(b, high)) for a, b in coarse], []
        log.info("%s of %s ranges are cut again", len(coarse), len(open_ranges))
        # Into no more than it takes for half of what is copied at once.
        pieces = min(FAN, width, 1 << (2 * most // max(leaf_rows, 1)).bit_length())
        open_ranges = [piece for a, b in coarse for piece in cut(a, b, pieces)]
        start, near = _start(key, low, width, kind), [(a, min(b, high)) for a, b in coarse]
        sides = [_within(df, key, near, start) for df in (source, target)]
        width //= pieces
    return fewer(sorted(found, key=lambda r: (r[0] is not None, r[0] or 0)))


def reconciled(
    source: DataFrame, target: DataFrame, row: Mapping[str, Any], leaf_rows: int = LEAF_ROWS
) -> tuple[list[Range], DataFrame]:
    """The differing ranges of a table and the source's rows in them."""
    key = row["append_key"]
    ranges = differing(source, target, key, leaf_rows)
    return ranges, source.filter(in_ranges(key, ranges))
