"""Near-duplicates by SimHash: fingerprints that differ in few bits are linked.

With up to D differing bits, D // 2 + 1 segments leave at least one segment that differs
in at most one bit. Each distinct fingerprint is indexed under every segment with every
single bit of it deleted; two fingerprints that meet under such a variant are compared.
Variants that more than ``CROWD`` fingerprints share are not paired. Their fingerprints
meet at points instead: each goes to all points within D // 2 bits of it, and a point
links what it gathers in a star, which is exact and linear in the fingerprints.

Copies collapse to one fingerprint before anything is paired, so the size of a group of
copies does not matter. Components come from alternating star contractions, each
written to the shared folder; the driver sees row counts only.

Words are runs of bytes other than space and \\t \\n \\v \\f \\r, with A-Z in lower
case; NULL and texts without words have fingerprint zero and link like any other.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapsync.functions.checksums import row_hash
from snapsync.llm.common import dealt, many, slices, texts, written

SEED = 42
BITS = 64
CROWD = 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Signed 64-bit SimHash: a bit is set if it is set in over half of the hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, 4096):
        block = hashes[start : start + 4096].astype("<u8").view(np.uint8)
        ones += np.unpackbits(block.reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, row: Column | None = None
):
    """``doc_id``, ``text_hash`` (of the text as it is, or ``row``) and ``fp`` of every row."""
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        (F.xxhash64(F.col(f"`{text}`")) if row is None else row).alias("text_hash"),
        F.col(f"`{text}`").alias("text"),
    )

    def run(batches):
        for batch in slices(batches):
            found = [fingerprint(t, shingle) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found, pa.int64())],
                ["doc_id", "text_hash", "fp"],
            )

    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    cuts = np.linspace(0, BITS, distance // 2 + 2).astype(int).tolist()
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _bits(mask: int) -> int:
    """A 64-bit mask as the signed number that Spark has for it."""
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _variants(fps: DataFrame, distance: int) -> DataFrame:
    """One row per fingerprint, segment and deleted bit: (seg, bit, rest, fp)."""
    keys = []
    for seg, (start, width) in enumerate(_segments(distance)):
        for bit in range(width):
            mask = ((1 << width) - 1 << start) & ~(1 << start + bit)
            rest = F.col("fp").bitwiseAND(F.lit(_bits(mask)))
            tag = seg * BITS + bit
            keys.append(F.struct(F.lit(tag).cast("short").alias("tag"), rest.alias("rest")))
    return fps.select("fp", F.inline(F.array(*keys)))


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _met_once(distance: int) -> Column:
    """True for one of the variants that a pair shares through equal segments.

    Where the segment is equal the pair meets under all of its variants: the first
    counts. Where it differs they meet under the one that lacks the differing bit.
    """
    seg = F.floor(F.col("tag") / BITS)
    mask = F.lit(None).cast("long")
    for i, (start, width) in enumerate(_segments(distance)):
        segment = _bits((1 << width) - 1 << start)
        mask = F.when(seg == i, F.lit(segment)).otherwise(mask)
    differ = F.col("a").bitwiseXOR(F.col("b")).bitwiseAND(mask) != 0
    return differ | (F.col("tag") % BITS == 0)


def _ball(radius: int) -> list[int]:
    """Masks of at most ``radius`` bits."""
    return [
        _bits(sum(1 << b for b in bits))
        for r in range(radius + 1)
        for bits in combinations(range(BITS), r)
    ]


def _meetings(fps: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) among crowded fingerprints, by the points they share."""
    inner, outer = distance // 2, distance - distance // 2
    near = len(_ball(inner))
    points = F.array(
        *[
            F.struct(
                F.col("fp").bitwiseXOR(F.lit(mask)).alias("point"), F.lit(i < near).alias("near")
            )
            for i, mask in enumerate(_ball(outer))
        ]
    )
    spread = fps.select("fp", F.inline(points))
    heads = (
        spread.filter("near").groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n"))
    )
    if inner == outer:
        heads = heads.filter("n > 1")
    met = dealt(spread).join(heads, "point").filter(F.col("fp") != F.col("a"))
    return met.select("a", F.col("fp").alias("b")).distinct()


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Linked pairs (a, b) of distinct fingerprints ``fp``.

    Every pair returned differs in ``distance`` bits or fewer. Pairs of uncrowded
    variants are all there; crowded fingerprints are linked through stars, so that the
    components are those of all pairs.
    """
    if not 0 <= distance <= 3:
        raise ValueError("distances from 0 to 3 bits")
    # As many tasks as a shuffle has: a row becomes 64, so few small rows are much work.
    # Dealt in turn, as hashed ones would be joined again into few tasks.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = _variants(fps.repartition(tasks), distance)
    sizes = variants.groupBy("tag", "rest").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(dealt(variants).join(sizes, ["tag", "rest"]), "simhash-shared")
    some = shared.filter(F.col("n") <= CROWD)
    left = some.select("tag", "rest", F.col("fp").alias("a"))
    right = some.select("tag", "rest", F.col("fp").alias("b"))
    pairs = (
        dealt(left, many(shared)).join(right, ["tag", "rest"])
        .filter(F.col("a") < F.col("b"))
        .filter(_met_once(distance) & (_distance("a", "b") <= distance))
        .select("a", "b")
        .distinct()
    )
    crowd = shared.filter(F.col("n") > CROWD).select("fp").distinct()
    return pairs.unionByName(_meetings(crowd, distance)).distinct()


def _unsettled(edges: DataFrame) -> bool:
    """True unless every ``a`` has one ``b``, which is the least of its star and no ``a``."""
    below, up = F.lit(1).alias("below"), (F.col("a") < F.col("b")).alias("up")
    ends = edges.select(F.col("a").alias("node"), below, up).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(True).alias("up"))
    )
    ends = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("up").alias("up"))
    return bool(ends.filter("below > 1 OR below = 1 AND up").take(1))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, of all nodes of (a, b)."""
    edges = written(edges.select("a", "b").filter("a <> b"), "simhash-edges")
    # No round makes more edges than it gets.
    wide = many(edges)
    while _unsettled(edges):
        # Large star: neighbours above a node go to the least of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (
            dealt(both, wide).join(least, F.col("a") == F.col("u"))
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        # Small star: neighbours below a node, and the node, go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), "m")
        joined = dealt(large, wide).join(least, F.col("a") == F.col("u"))
        small = joined.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = written(small.distinct(), "simhash-star")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()


def groups(signed: DataFrame, distance: int = 2) -> DataFrame:
    """``fp`` and ``root`` (the fingerprint that names its component), each ``fp`` once."""
    fps = signed.select("fp").distinct()
    roots = components(links(fps, distance))
    joined = dealt(fps, many(signed)).join(roots, F.col("fp") == F.col("node"), "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest ``doc_id`` linked to each row.

    One row per row of ``df``; rows without a doc_id take part, and get NULL where no
    row of their component has one.
    """
    signed = written(fingerprints(df, key, text, shingle), "simhash-signed")
    rooted = written(groups(signed, distance), "simhash-groups")
    least = signed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    wide = many(signed)
    of_root = dealt(rooted, wide).join(least, "fp")
    of_root = of_root.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = dealt(rooted, wide).join(of_root, "root").select("fp", "component_id")
    return dealt(signed, wide).join(ids, "fp").select("doc_id", "fp", "component_id")


def representatives(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """One row of ``df`` per component: that of the smallest doc_id, NULL ids last.

    Of rows with one doc_id that whose hash over all columns is least stays; of rows that
    repeat as a whole, one. Columns may have any names. Rows that are alone in their
    component pass by; only the others, and a few that a filter of bounded size lets
    through, travel with their texts.
    """
    signed = written(fingerprints(df, key, text, shingle, row_hash(df.schema)), "simhash-signed")
    rooted = written(groups(signed, distance), "simhash-groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    least = signed.groupBy("fp").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    wide = many(signed)
    of_root = dealt(rooted, wide).join(least, "fp").groupBy("root")
    of_root = written(of_root.agg(F.min("first").alias("first"), F.sum("n").alias("n")), "simhash-firsts")
    crowded = dealt(rooted, wide).join(of_root.filter("n > 1"), "root").select("fp")
    crowded = dealt(signed, wide).join(crowded, "fp").select("text_hash").distinct()
    bits, words = _word_map(crowded)
    hashed = row_hash(df.schema)
    rows = df.select(F.struct("*").alias("row"), hashed.alias("hash"), F.pmod(hashed, F.lit(bits)).alias("place"))
    # No more rows than the map has words, which is bounded.
    rows = rows.join(F.broadcast(words), F.floor(F.col("place") / 64) == F.col("word"), "left")
    bit = F.call_function("shiftright", F.col("bits"), (F.col("place") % 64).cast("int"))
    met = F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False))
    # Hashes do not compress: files of these are no smaller than what a broadcast holds.
    first = of_root.select(F.col("first.text_hash").alias("hash"))
    chosen = rows.filter(met).select("row", "hash").join(first, "hash", "left_semi").dropDuplicates(["hash"])
    return rows.filter(~met).select("row", "hash").unionByName(chosen).select("row.*")


MAP_BITS = 1 << 25  # at most: half a million words


def _word_map(hashes: DataFrame) -> tuple[int, DataFrame]:
    """A bit map of hashes: how many bits, and its words that are not 0 as (word, bits)."""
    wanted = hashes.count()
    bits = min(MAP_BITS, 1 << max(16, (16 * wanted).bit_length()))
    place = F.pmod(F.col(hashes.columns[0]), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    words = hashes.select(F.floor(place / 64).alias("word"), bit.alias("bit"))
    return bits, written(words.groupBy("word").agg(F.bit_or("bit").alias("bits")), "simhash-map")
