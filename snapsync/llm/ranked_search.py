"""Ranked search of all documents for each item, by scanning texts with one automaton.

An Aho-Corasick automaton over the terms of all items, each between boundary marks, runs
over the normalised text of every document once: what it finds is how often each term is in
the text, so there is no index of the documents. A term leads to the items that have it.
Document frequencies, counts and lengths come from the same scan, written to the shared
folder; a second pass over these small rows scores. A task keeps the best ``top`` documents
of each item, so that what leaves it does not grow with its documents; ranks are then made
in two steps, so that no task meets the candidates of all tasks for an item.

The items are the stated queries. They are read in blocks of ``BLOCK_BYTES`` of text and
``BLOCK_ITEMS`` items, a few hundred MB in a task, each block with an automaton and a scan of
its own. A benchmark of tens of megabytes is one block; the documents are never rewritten.

Terms are runs of letters a-z, digits and all that is not ASCII, with A-Z in lower case.
NULL texts have no terms. Rows of one item id are one item, as are those with a NULL id;
items without terms find nothing. Document rows that repeat are ranked each, a NULL doc_id
after the others of its score. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapsync.llm.common import expand, slices, texts, written

TOP = 50
BLOCK_BYTES, BLOCK_ITEMS = 32 << 20, 1 << 16
HITS = 1 << 20  # that a task works on at a time
SHARES = 64  # of an item's candidates, ranked apart first

_WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
NORMAL = bytes(b if b in _WORD else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))
MARK = " "


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


@dataclass(frozen=True)
class Items:
    """The items of a search: ids, distinct terms, and the items that have each term."""

    ids: list
    terms: list[bytes]
    starts: np.ndarray  # where the items of each term begin in ``of``, and the end
    of: np.ndarray

    def pairs_only(self) -> Items:
        """Without the terms' letters."""
        return replace(self, terms=[])


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[Items]:
    """All items, those of a block at a time; rows of one id are in one block."""
    rows = benchmark.select(
        F.col(f"`{item}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text")
    ).filter("text IS NOT NULL")
    total, n = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    several = max((total or 0) // BLOCK_BYTES, n // BLOCK_ITEMS) + 1
    for block in range(several):
        has: dict = {}
        for row in rows.filter(F.pmod(F.xxhash64("id"), F.lit(several)) == block).collect():
            has.setdefault(row.id, set()).update(terms_of(bytes(row.text)))
        ids = sorted(has, key=lambda i: (i is None, i))
        of: dict[bytes, list[int]] = {}
        for number, i in enumerate(ids):
            for term in has[i]:
                of.setdefault(term, []).append(number)
        terms = sorted(of)
        starts = np.cumsum([0, *(len(of[t]) for t in terms)])
        places = np.fromiter(chain.from_iterable(of[t] for t in terms), np.int64, starts[-1])
        yield Items(ids, terms, starts, places)


class Counter:
    """Counts terms in texts."""

    def __init__(self, terms: list[bytes]):
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, term in enumerate(terms):
            self.automaton.add_word(MARK + term.decode("latin-1") + MARK, i)
        if terms:
            self.automaton.make_automaton()

    def count(self, normal: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, occurrences) of all terms in normalised texts, by text and term."""
        ends = np.cumsum([1, *(len(t) + 1 for t in normal)])
        if not len(self.automaton):
            return (np.empty(0, np.int64),) * 3
        whole = MARK + MARK.join(t.decode("latin-1") for t in normal) + MARK
        n = len(self.automaton)
        found = chain.from_iterable(self.automaton.iter(whole))
        both, occurrences = np.empty(0, np.int64), np.empty(0, np.int64)
        # Some hits at a time, as a long text has many.
        while len(hits := np.fromiter(islice(found, 2 * HITS), np.int64).reshape(-1, 2)):
            # A hit ends on the mark after its term, which stands before the next text at most.
            document = np.searchsorted(ends, hits[:, 0], side="left") - 1
            some, times = np.unique(document * n + hits[:, 1], return_counts=True)
            both, where = np.unique(np.r_[both, some], return_inverse=True)
            occurrences = np.bincount(where, np.r_[occurrences, times]).astype(np.int64)
        return both // n, both % n, occurrences


def length(normal: bytes) -> int:
    """How many terms a normalised text has."""
    inside = np.frombuffer(normal, np.uint8) != 32
    return int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(len(inside) > 0 and inside[0])


def scanned(df: DataFrame, terms: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document that has any term: doc_id, n (how many), and which of ``terms``, how often."""
    rows = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = rows.select(
        "doc_id", F.lit(0).cast("long").alias("n"),
        F.array(F.lit(0)).alias("terms"), F.array(F.lit(0).cast("long")).alias("tf"),
    ).schema
    for field in schema.fields:
        field.nullable = True
    sent = df.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        counter = Counter(sent.value)
        for batch in slices(batches):
            normal = [t.translate(NORMAL) for t in texts(batch)]
            n = np.array([length(t) for t in normal], np.int64)
            document, term, tf = counter.count(normal)
            sizes = np.bincount(document, minlength=len(normal))
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n),
                    pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(tf)),
                ],
                ["doc_id", "n", "terms", "tf"],
            ).filter(pa.array(n > 0))

    return rows.mapInArrow(run, schema)


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def scores(
    n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray,
    items: Items, weights: np.ndarray, documents: int, total: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, score) of each pair with a term in common; ``term`` is by document."""
    if int(n.max(initial=0)) * 50 * documents < 1 << 63:
        m = 50 + 50 * n * documents // total
    else:
        m = np.array([50 + 50 * int(v) * documents // total for v in n], np.int64)
    document = np.repeat(np.arange(len(n)), sizes)
    gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[document]))
    fan = items.starts[term + 1] - items.starts[term]
    width = len(items.ids)
    place = items.of[expand(items.starts[term], fan)] + np.repeat(document, fan) * width
    if len(n) * width <= 4 * HITS:
        found = np.zeros(len(n) * width, np.int64)
        np.add.at(found, place, np.repeat(gain, fan))
        both = np.flatnonzero(found)
        found = found[both]
    else:
        both, where = np.unique(place, return_inverse=True)
        found = np.zeros(len(both), np.int64)
        np.add.at(found, where, np.repeat(gain, fan))
    return both // width, both % width, found


def candidates(
    found: DataFrame, items: Items, weights: np.ndarray, documents: int, total: int, top: int
) -> DataFrame:
    """The ``top`` best documents of each item in each task: item (its number), doc_id, score."""
    sent = found.sparkSession.sparkContext.broadcast((items.pairs_only(), weights))
    kind = found.schema["doc_id"].dataType.simpleString()
    rows = found.filter(F.size("terms") > 0)

    def pieces(batch, items):
        """Rows in order, of about ``HITS`` pairs of a term and an item that has it."""
        sizes = pc.list_value_length(batch.column("terms")).to_numpy()
        fan = np.diff(items.starts)[batch.column("terms").flatten().to_numpy()]
        piece = np.cumsum(np.add.reduceat(fan, np.cumsum(sizes) - sizes)) // HITS
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)

    def kept(rows):
        """The best of each item, by score and then by id."""
        rows = rows.sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
        item = rows.column("item").to_numpy()
        return rows.filter(pa.array(np.arange(len(item)) - np.searchsorted(item, item) < top))

    def run(batches):
        items, weights = sent.value
        best = None
        least = np.ones(len(items.ids), np.int64)  # score that a document needs
        for batch in batches:
            for piece in pieces(batch, items) if batch.num_rows else ():
                terms = piece.column("terms")
                document, item, score = scores(
                    piece.column("n").to_numpy(),
                    pc.list_value_length(terms).to_numpy(),
                    terms.flatten().to_numpy().astype(np.int64),
                    piece.column("tf").flatten().to_numpy(),
                    items, weights, documents, total,
                )
                good = score >= least[item]
                rows = pa.table(
                    {
                        "item": item[good].astype(np.int32),
                        "doc_id": piece.column("doc_id").take(pa.array(document[good])),
                        "score": score[good],
                    }
                )
                best = kept(rows if best is None else pa.concat_tables([best, rows]))
                item = best.column("item").to_numpy()
                last = np.flatnonzero(np.arange(len(item)) - np.searchsorted(item, item) == top - 1)
                least[item[last]] = np.maximum(best.column("score").to_numpy()[last], 1)
        if best is not None:
            yield from best.combine_chunks().to_batches()

    return rows.mapInArrow(run, f"item int, doc_id {kind}, score long")


def ranked(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", top: int = TOP,
) -> DataFrame:
    """Each item's ``top`` best documents: item_id, rank (from 1), doc_id, score."""
    whole = [_ranked(df, items, benchmark.schema[item], key, text, top) for items in blocks(benchmark, item, item_text)]
    return reduce(DataFrame.unionByName, whole)


def _ranked(df: DataFrame, items: Items, item, key: str, text: str, top: int) -> DataFrame:
    spark = df.sparkSession
    found = written(scanned(df, items.terms, key, text), "search-scan")
    documents, total = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One number for each term of the items.
    counted = found.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    frequency = dict(map(tuple, counted))
    weights = np.array([weight(documents, frequency.get(t, 0)) for t in range(len(items.terms))], np.int64)
    best = candidates(found, items, weights, documents, max(total, 1), top)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # Ranked by shares first: no task sorts an item's candidates of all tasks.
    share = Window.partitionBy("item", "share").orderBy(*order)
    every = Window.partitionBy("item").orderBy(*order)
    best = best.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)))
    best = best.withColumn("place", F.row_number().over(share)).filter(F.col("place") <= top)
    best = best.withColumn("rank", F.row_number().over(every)).filter(F.col("rank") <= top)
    names = spark.createDataFrame([*enumerate(items.ids)], f"item int, item_id {item.dataType.simpleString()}")
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
