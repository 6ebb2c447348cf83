"""Documents whose sets of word n-grams have a Jaccard similarity of a threshold or more.

Shingles are hashed into groups; how many of a set fall into each group makes the set a
point, and sum(min(a, b)) over the coordinates of two points bounds how many shingles the
sets share. Points are packed into R-trees whose nodes keep the greatest coordinates below
them: two nodes whose bound is less than what any link needs are not looked into. Pairs of
points that survive are verified on their sets.

A tree holds a page of bounded size. Which points must be in one tree is found from group
counts as well, in exact steps. Points are cut into bands of groups, more than two linked
sets can differ in, so that two linked points agree in a band (``keys``): a point is told
by the first bands that suffice, bands of one shingle left aside where others do. Points
that agree in any band, directly or through others, make a block. A block that fits a page
is joined in its tree. Larger ones are dealt to pages by a hash, joined there, then by one
representative of each component found; pages of what is still apart are paired last, size
by size, so that no link is lost and no task holds more than two pages.

Equal sets are one point, so copies cost nothing; pairs that are known to be connected are
not verified again. Shingles and sets are told apart by 64-bit hashes (sets also by their size).

Words are runs of bytes other than space and \\t \\n \\v \\f \\r, with A-Z in lower case. A
text with fewer words than a shingle has one shingle, of all its words; one without words,
or NULL, has none and links with nothing. Rows that repeat are rows of the same set; a NULL
doc_id takes part, and is the greatest. Texts are taken whole, however long; other columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapsync.llm.common import bit_map, expand, mapped, slices, texts, written
from snapsync.llm.simhash import components

SHINGLE, PERCENT = 4, 85
GROUPS = 64
HEAVY = 2  # shingles of a band that tells enough
FAN = 8  # children of a tree's node
# Shingles on a page; a document counts for OVERHEAD more, so a page has 4096 at most.
PAGE, OVERHEAD = 1 << 20, 256
PAIRS = 1 << 15  # bounds that are computed at a time
KEYS = 1 << 20  # band keys that a task sorts at a time


# Sets and bands ----------------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    """Hashes whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = text.lower().split()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if not words:
        return hashes
    size = min(size, len(words))
    found = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        found = _spread(found * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(found)])
    return np.unique(found)


def digest(own: np.ndarray) -> int | None:
    return xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63) if len(own) else None


def differences(n: int, percent: int = PERCENT) -> int:
    """Shingles by which a set of ``n`` and a linked set can differ, both ways together."""
    return (100 - percent) * (n + 100 * n // percent) // (100 + percent)


def schemes(n: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """(number, largest size) of the size ranges that ``n`` is in; linked sizes share one."""
    found, number, low, high = [], 0, 1, 12
    while low <= n:
        if n <= high:
            found.append((number, high))
        number += 1
        low = percent * (high + 1) // 100
        high = max(2 * low, 3 * high // 2)
    return found


def keys(own: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Band keys of a set: linked sets that are not equal share one.

    Two linked sets differ in ``differences`` bands at most. Of the bands with ``HEAVY``
    shingles each set gives one more than that, the first ones; a set that has fewer gives
    all bands, light and empty ones too.
    """
    most = differences(len(own), percent)
    if not most:
        return np.empty(0, np.uint64)
    found = []
    high_bits = own >> np.uint64(32)
    for number, high in schemes(len(own), percent):
        # No more bands differ than the largest size can differ by; an eighth for light ones.
        bands = differences(high, percent) * 9 // 8 + 2
        band = (high_bits * np.uint64(bands)) >> np.uint64(32)
        sizes = np.bincount(band.astype(np.int64), minlength=bands)
        # Hashes are sorted, so bands are runs.
        sums = np.diff(np.r_[np.uint64(0), np.cumsum(own, dtype=np.uint64)][np.r_[0, np.cumsum(sizes)]])
        told = np.flatnonzero(sizes >= HEAVY)
        told = told[: most + 1] if len(told) > most else np.arange(bands)
        place = np.uint64(number << 32) + told.astype(np.uint64)
        found.append(_spread(sums[told] ^ _spread(place + np.uint64(1))))
    return np.concatenate(found)


def _row(key: str, text: str):
    return F.xxhash64(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`"))


def sets(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Per row: doc_id, row (a hash of it), n (shingles), node (digest of the set), keys."""
    rows = df.select(
        F.col(f"`{key}`").alias("doc_id"), _row(key, text).alias("row"), F.col(f"`{text}`").alias("text")
    )
    schema = rows.select(
        "doc_id", "row", F.lit(0).cast("long").alias("n"),
        F.lit(0).cast("long").alias("node"), F.array(F.lit(0).cast("long")).alias("keys"),
    ).schema
    for field in schema.fields:
        field.nullable = True

    def run(batches):
        for batch in slices(batches):
            own = [shingles(t, size) for t in texts(batch)]
            bands = [keys(s, percent) for s in own]
            offsets = np.cumsum([0, *map(len, bands)]).astype(np.int32)
            flat = np.concatenate(bands).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row"),
                    pa.array([len(s) for s in own], pa.int64()),
                    pa.array([digest(s) for s in own], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                ["doc_id", "row", "n", "node", "keys"],
            )

    return rows.mapInArrow(run, schema)


# Blocks ------------------------------------------------------------------


def _sorted_keys(batches):
    """(key, node) arrays, sorted and distinct, of about ``KEYS`` at a time."""
    waiting, n = [], 0

    def ready():
        key = np.concatenate([k for k, _ in waiting])
        node = np.concatenate([v for _, v in waiting])
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        fresh = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])]
        return key[fresh], node[fresh]

    for batch in batches:
        lists = batch.column("keys")
        sizes = pc.list_value_length(lists).to_numpy()
        key = lists.flatten().to_numpy()
        waiting.append((key, np.repeat(batch.column("node").to_numpy(zero_copy_only=False), sizes)))
        n += len(key)
        if n >= KEYS:
            yield ready()
            waiting, n = [], 0
    if n:
        yield ready()


def agreeing(signed: DataFrame) -> DataFrame:
    """Links (a, b) that connect all nodes which share a key.

    Nodes of a key are chained, first those that a task meets together, then one of each
    task, so that no key has more rows than there are tasks.
    """
    rows = signed.filter("size(keys) > 0").select("node", "keys")

    def chained(batches):
        for key, node in _sorted_keys(batches):
            same = key[1:] == key[:-1]
            both = np.unique(np.column_stack([node[:-1][same], node[1:][same]]), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"]
            )

    def firsts(batches):
        for key, node in _sorted_keys(batches):
            first = np.r_[True, key[1:] != key[:-1]]
            yield pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(node[first])], ["key", "node"])

    near = rows.mapInArrow(chained, "a long, b long")
    far = rows.mapInArrow(firsts, "key long, node long").select(
        F.lag("node").over(Window.partitionBy("key").orderBy("node")).alias("a"), F.col("node").alias("b")
    )
    return near.unionByName(far.filter("a <> b")).distinct()


# Trees -------------------------------------------------------------------


class Forest:
    """Components of rows, by their least row."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
        return a != b

    def labels(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up


class Tree:
    """An R-tree of points in the order given: per level the corners of its nodes."""

    def __init__(self, block: np.ndarray, n: np.ndarray, counts: np.ndarray):
        # A level: (least block, greatest block, least size, greatest size, greatest counts).
        self.levels = [(block, block, n, n, counts)]
        while len(self.levels[-1][0]) > 1:
            at = np.arange(0, len(self.levels[-1][0]), FAN)
            low, high, small, large, upper = self.levels[-1]
            self.levels.append(
                (
                    np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                    np.minimum.reduceat(small, at), np.maximum.reduceat(large, at),
                    np.maximum.reduceat(upper, at, axis=0),
                )
            )

    def _can_link(self, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        low, high, small, large, upper = self.levels[level]
        can = (low[i] <= high[j]) & (low[j] <= high[i])
        can &= (percent * small[j] <= 100 * large[i]) & (percent * small[i] <= 100 * large[j])
        at = np.flatnonzero(can)
        shared = np.minimum(upper[i[at]], upper[j[at]]).sum(1, dtype=np.int64)
        can[at] = (100 + percent) * shared >= percent * (small[i[at]] + small[j[at]])
        return can

    def pairs(self, percent: int, apart):
        """Arrays (a, b), a < b, of points that may link.

        ``apart(level, i, j)`` says which pairs of nodes are still of interest.
        """
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, i, j = stack.pop()
            if len(i) > PAIRS:
                stack.append((level, i[PAIRS:], j[PAIRS:]))
                i, j = i[:PAIRS], j[:PAIRS]
            if not level:
                here = i < j
                i, j = i[here], j[here]
            on = apart(level, i, j)
            i, j = i[on], j[on]
            on = self._can_link(level, i, j, percent)
            i, j = i[on], j[on]
            if not len(i):
                continue
            if not level:
                yield i, j
                continue
            size = len(self.levels[level - 1][0])
            first, others = FAN * i, FAN * j
            left = np.minimum(FAN, size - first)
            a = expand(first, left)
            right = np.repeat(np.minimum(FAN, size - others), left)
            b = expand(np.repeat(others, left), right)
            a = np.repeat(a, right)
            # Of a node with itself, each pair once.
            stack.append((level - 1, a[a <= b], b[a <= b]))


def _counts(own: list[np.ndarray]) -> np.ndarray:
    """How many shingles of each set fall into each group."""
    row = np.repeat(np.arange(len(own)), [len(s) for s in own])
    group = (np.concatenate(own) % np.uint64(GROUPS)).astype(np.int64)
    counts = np.bincount(row * GROUPS + group, minlength=len(own) * GROUPS)
    return counts.reshape(len(own), GROUPS).astype(np.int32)


def linked(
    block: np.ndarray, own: list[np.ndarray], known: np.ndarray | None = None, percent: int = PERCENT
) -> np.ndarray:
    """Per row the number of its component, by the links between rows of a block.

    Rows that ``known`` gives one number are connected already.
    """
    n = np.array([len(s) for s in own], np.int64)
    # Sets that are alike mostly have the same least hash, and lie next to each other.
    order = np.lexsort(([s[0] for s in own], block))
    own = [own[i] for i in order]
    tree = Tree(block[order], n[order], _counts(own))
    forest = Forest(len(own))
    if known is not None:
        _, first, same = np.unique(known[order], return_index=True, return_inverse=True)
        forest.up = first[same.ravel()]
    pure = [None] * len(tree.levels)  # per level: the one component of a node, or -1

    def refresh():
        pure[0] = forest.labels().copy()
        for level in range(1, len(pure)):
            at = np.arange(0, len(pure[level - 1]), FAN)
            least = np.minimum.reduceat(pure[level - 1], at)
            pure[level] = np.where(least == np.maximum.reduceat(pure[level - 1], at), least, -1)

    def apart(level, i, j):
        return (pure[level][i] < 0) | (pure[level][i] != pure[level][j])

    refresh()
    for some, others in tree.pairs(percent, apart):
        joined = False
        for a, b in zip(some.tolist(), others.tolist()):
            if forest.find(a) == forest.find(b):
                continue
            shared = len(np.intersect1d(own[a], own[b], assume_unique=True))
            if 100 * shared >= percent * (len(own[a]) + len(own[b]) - shared):
                forest.join(a, b)
                joined = True
        if joined:
            refresh()
    label = np.empty(len(own), np.int64)
    label[order] = order[forest.labels()]
    return label


# Pages -------------------------------------------------------------------


def _read_again(df: DataFrame, picks: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``picks`` (row and other columns) with ``own``, the shingles of the row.

    Texts are read again, but only the sets of rows that the filter lets through travel,
    one of each set and task.
    """
    sent = df.sparkSession.sparkContext.broadcast(bit_map(picks, "row"))
    rows = df.select(_row(key, text).alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        filled = sent.value
        seen: set[int] = set()
        for whole in batches:
            wanted = mapped(filled, whole.column("row").to_numpy())
            for batch in slices([whole.filter(pa.array(wanted))]):
                row = batch.column("row").to_pylist()
                fresh = [i for i, r in enumerate(row) if not (r in seen or seen.add(r))]
                batch = batch.take(pa.array(fresh, pa.int64()))
                own = [shingles(t, size).tobytes() for t in texts(batch)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(own, pa.binary())], ["row", "own"]
                )

    # A row that repeats is in several tasks: the first of its key counts.
    return picks.join(rows.mapInArrow(run, "row long, own binary"), "row").drop("row")


def _paged(df: DataFrame, *page: str) -> DataFrame:
    """Rows of a page in one task, one after another."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *page).sortWithinPartitions(*page)


LABELS = "node long, label long"


def _joined(df: DataFrame, percent: int) -> DataFrame:
    """Rows (page, part, node, known, own) as (node, label), page by page.

    Rows of a page have one label if links on it connect them, or ``known`` is the same.
    Pages that are small share a tree, which keeps them apart.
    """

    def run(batches):
        waiting: list = []
        size = 0

        def ready():
            page = np.array([r[:2] for r in waiting], np.int64)
            block = np.unique(page, axis=0, return_inverse=True)[1].ravel()
            known = np.column_stack([block, np.array([r[3] for r in waiting], np.int64)])
            known = np.unique(known, axis=0, return_inverse=True)[1].ravel()
            node = np.array([r[2] for r in waiting], np.int64)
            own = [np.frombuffer(r[4], np.uint64) for r in waiting]
            label = linked(block, own, known, percent)
            # The least node names what is connected.
            least = np.full(len(node), np.iinfo(np.int64).max)
            np.minimum.at(least, label, node)
            return pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(least[label])], ["node", "label"]
            )

        last = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page", "part", "node", "known", "own"))):
                # Only between pages, as what lies on one must meet.
                if size >= PAGE and row[:2] != last:
                    yield ready()
                    waiting, size = [], 0
                waiting.append(row)
                last = row[:2]
                size += len(row[4]) // 8 + OVERHEAD
        if waiting:
            yield ready()

    rows = df.select("page", "part", "node", "known", "own")
    return _paged(rows, "page", "part").mapInArrow(run, LABELS)


def rooted(
    df: DataFrame, signed: DataFrame, key: str = "doc_id", text: str = "text",
    size: int = SHINGLE, percent: int = PERCENT,
) -> DataFrame:
    """``node`` and ``label``, one for all nodes that links connect, of every node of
    ``signed`` (a written table of ``sets``) that may have links."""
    blocks = components(agreeing(signed)).select("node", F.col("root").alias("block"))
    points = signed.filter("size(keys) > 0").groupBy("node").agg(
        F.min("row").alias("row"), F.max("n").alias("n")
    )
    points = written(points.join(blocks, "node"), "ngram-points")
    weight = F.sum(F.col("n") + OVERHEAD)

    def dealt(rows, known):
        """Points on the pages of their blocks, as many as a block needs."""
        pages = rows.groupBy("block").agg(F.ceil(weight / PAGE).alias("pages"))
        part = F.pmod(F.xxhash64("node"), F.col("pages")).alias("part")
        return rows.join(pages, "block").select("row", F.col("block").alias("page"), part, "node", known)

    pages = dealt(points, F.col("node").alias("known"))
    labels = written(_joined(_read_again(df, pages, key, text, size), percent), "ngram-labels")
    several = points.groupBy("block").agg(F.ceil(weight / PAGE).alias("pages")).filter("pages > 1")
    large = points.join(several.select("block"), "block")
    large = written(large.join(labels, "node"), "ngram-large")
    if not large.take(1):
        return labels

    # Representatives of what the pages of a block connect.
    first = large.filter("node = label").drop("label")
    pages = dealt(first, F.col("node").alias("known"))
    more = _joined(_read_again(df, pages, key, text, size), percent)
    more = more.select(F.col("node").alias("label"), F.col("label").alias("known"))
    more = written(more, "ngram-labels")
    large = written(large.join(more, "label").drop("label"), "ngram-large")
    # Blocks that are not one component yet: sizes that can link, page against page.
    apart = large.groupBy("block").agg(F.min("known").alias("x"), F.max("known").alias("y"))
    rest = large.join(apart.filter("x <> y").select("block"), "block")
    if rest.take(1):
        met = written(_crossed(df, rest, key, text, size, percent), "ngram-crossed")
        # A label that pages share connects what they connect.
        roots = components(met.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(
            rest.select(F.col("node").alias("a"), F.col("known").alias("b"))
        ))
        large = large.join(roots, "node", "left")
        large = large.withColumn("known", F.coalesce("root", "known")).drop("root")
    last = large.select("node", F.col("known").alias("last"))
    labels = labels.join(last, "node", "left")
    return labels.select("node", F.coalesce("last", "label").alias("label"))


def _crossed(df: DataFrame, rest: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """Labels of the pages of blocks that are of several components, two pages at a time.

    Linked sizes are in the same or in neighbouring steps. A component that fills a page of
    its step has pages of its own, which need not be paired among themselves.
    """
    step = F.floor(F.log(F.col("n")) / float(np.log(100 / percent))).cast("int")
    rest = rest.withColumn("step", step)
    weight = F.sum(F.col("n") + OVERHEAD)
    of = rest.groupBy("block", "step", "known").agg(weight.alias("weight"))
    of = of.select("block", "step", "known", F.col("weight"), (F.col("weight") >= PAGE).alias("alone"))
    shared = of.filter("NOT alone").groupBy("block", "step").agg(F.ceil(F.sum("weight") / PAGE).alias("shared"))
    of = of.join(shared, ["block", "step"], "left")
    parts = F.when(F.col("alone"), F.ceil(F.col("weight") / PAGE)).otherwise(F.col("shared"))
    of = of.select("block", "step", "known", "alone", parts.alias("parts"))
    tag = F.when(F.col("alone"), F.col("known"))
    spread = F.when(F.col("alone"), F.xxhash64("node")).otherwise(F.xxhash64("known"))
    rows = rest.join(of, ["block", "step", "known"]).select(
        "row", "block", "step", "node", "known", tag.alias("tag"), F.pmod(spread, F.col("parts")).alias("part")
    )
    rows = written(
        rows.withColumn("page", F.xxhash64("block", "step", "tag", "part")), "ngram-rest"
    )
    pages = rows.select("block", "step", "tag", "page").distinct()
    other = pages.select("block", *[F.col(c).alias(f"{c}2") for c in ("step", "tag", "page")])
    pairs = (
        pages.join(other, "block")
        .filter("abs(step - step2) <= 1 AND page <= page2")
        .filter("tag IS NULL OR tag2 IS NULL OR tag <> tag2")
        .select("page", "page2", F.xxhash64("page", "page2").alias("pair"))
    )
    pairs = written(pairs, "ngram-page-pairs")
    sides = pairs.select("pair", "page").unionByName(pairs.select("pair", F.col("page2").alias("page"))).distinct()
    texts = _read_again(df, rows.select("row", "page", "node", "known"), key, text, size)
    met = texts.join(sides, "page").select(
        F.col("pair").alias("page"), F.lit(0).alias("part"), "node", "known", "own"
    )
    return _joined(met, percent)


# Rows --------------------------------------------------------------------


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Per row: doc_id, n_shingles, and component_id, the least doc_id linked to the row."""
    if not 50 <= percent <= 100:
        raise ValueError("similarities of 50 to 100 percent")
    signed = written(sets(df, key, text, size, percent), "ngram-sets")
    roots = rooted(df, signed, key, text, size, percent)
    least = signed.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    of = least.join(roots, "node", "left").select("node", "least", F.coalesce("label", "node").alias("root"))
    of = written(of, "ngram-roots")
    ids = of.join(of.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    rows = signed.select("doc_id", F.col("n").alias("n_shingles"), "node")
    found = rows.join(ids.select("node", "component_id"), "node", "left")
    # Without shingles a row is alone.
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", own.alias("component_id"))
