"""Benchmark decontamination by one Aho-Corasick automaton over the items.

Text is normalised to words (bytes a-z, 0-9 and all that is not ASCII, with A-Z in lower
case) with single spaces between them. Every window of ten consecutive words of an item, or
the whole of a shorter one, is a pattern. Each item is cut into chunks of five words, of
which any window has a whole one: the automaton has the chunks, so it is as large as the
items and not ten times that. A document is scanned once; where a chunk ends, the windows
around it are looked up by their hash. What is found is mapped to words and, through the
words, to the original text.

A task holds the automaton and the windows' numbers, some 60 bytes for each byte of the
items, of ``BLOCK_BYTES`` of item text at most (2 GB). A larger benchmark has several
automata, one after another in the same scan, each with workers of its own; documents are
never written in between. Occurrences carry a pattern's number, and the ids of items are
looked up once for a document.

NULL texts have no words, items without words have no pattern. Rows of one item id are one
item; a NULL id is one of them. Documents that repeat, and texts of any length, are scanned
each as a whole; equal windows of several items are one pattern. Other columns are kept as
they are, also those with names that are used here. Empty tables contaminate nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapsync.llm.common import expand, slices, texts

WINDOW = 10
BLOCK_BYTES = 32 << 20

_WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
NORMAL = bytes(b if b in _WORD else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def _hash(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words), len(words))


@dataclass(frozen=True)
class Patterns:
    """The windows of items by their hash, and the chunks that lead to them."""

    chunks: dict[str, frozenset[tuple[int, int]]]  # (words of the window, words before the chunk)
    hashes: np.ndarray  # sorted; a window's number is its place
    starts: np.ndarray  # where the items of each window begin in ``of``, and the end
    of: np.ndarray
    items: list[str]


def patterns(items: list[tuple[str, bytes]], window: int = WINDOW) -> Patterns:
    size = (window + 1) // 2
    names = sorted({i for i, _ in items})
    number = {n: i for i, n in enumerate(names)}
    chunks: dict[str, set[tuple[int, int]]] = {}
    hashes, of = [], []
    for item, text in items:
        words = words_of(text)
        if not words:
            continue
        n = min(window, len(words))
        for s in range(len(words) - n + 1):
            # The first whole chunk of the window, or all of a short item.
            before = -s % size if n == window else 0
            own = words[s + before : s + before + (size if n == window else n)]
            key = b" ".join([b"", *own, b""]).decode("latin-1")
            chunks.setdefault(key, set()).add((n, before))
            hashes.append(_hash(words[s : s + n]))
            of.append(number[item])
    both = np.unique(np.array([hashes, of], np.uint64).reshape(2, -1), axis=1)
    known, starts = np.unique(both[0], return_index=True)
    places = {k: frozenset(v) for k, v in chunks.items()}
    return Patterns(places, known, np.r_[starts, both.shape[1]], both[1].astype(np.int64), names)


class Scanner:
    def __init__(self, items: list[tuple[str, bytes]] | Patterns, window: int = WINDOW):
        self.patterns = items if isinstance(items, Patterns) else patterns(items, window)
        # Chunks that lead to the same places share them.
        kinds = sorted({*self.patterns.chunks.values()}, key=sorted)
        self.kinds = [sorted(k) for k in kinds]
        at = {k: i for i, k in enumerate(kinds)}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for chunk, places in self.patterns.chunks.items():
            self.automaton.add_word(chunk, (chunk.count(" ") - 1) * len(kinds) + at[places])
        if len(self.automaton):
            self.automaton.make_automaton()

    def found(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, word after the last, and number of each pattern that occurs."""
        none = (np.empty(0, np.int64),) * 3
        if not len(self.automaton) or not words:
            return none
        text = b" ".join([b"", *words, b""]).decode("latin-1")
        ends = [*self.automaton.iter(text)]
        if not ends:
            return none
        # A chunk ends on the space after its last word: the n-th space, n words in.
        spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
        after = np.searchsorted(spaces, [end for end, _ in ends]).tolist()
        tried = set()
        for a, (_, value) in zip(after, ends):
            length, kind = divmod(value, len(self.kinds))
            for n, before in self.kinds[kind]:
                start = a - length - before
                if start >= 0 and start + n <= len(words):
                    tried.add((start, n))
        tried = sorted(tried)
        hashes = np.array([_hash(words[s : s + n]) for s, n in tried], np.uint64)
        place = np.searchsorted(self.patterns.hashes, hashes)
        there = place < len(self.patterns.hashes)
        there[there] = self.patterns.hashes[place[there]] == hashes[there]
        spans = np.array(tried, np.int64).reshape(-1, 2)[there]
        return spans[:, 0], spans.sum(1), place[there]

    def items_of(self, numbers: np.ndarray) -> list[str]:
        """The items that have any of the patterns, each once."""
        known = np.unique(numbers)
        starts = self.patterns.starts
        members = np.unique(self.patterns.of[expand(starts[known], starts[known + 1] - starts[known])])
        return [self.patterns.items[i] for i in members.tolist()]

    def scan(self, words: list[bytes]) -> list[tuple[int, int, tuple[str, ...]]]:
        """First word, word after the last, and items of each pattern that occurs."""
        return [
            (a, b, tuple(self.items_of(np.array([n]))))
            for a, b, n in zip(*(x.tolist() for x in self.found(words)))
        ]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The words in any range, as ranges in order that do not touch."""
    found: list[list[int]] = []
    for a, b in sorted(ranges):
        if found and a <= found[-1][1]:
            found[-1][1] = max(found[-1][1], b)
        else:
            found.append([a, b])
    return [(a, b) for a, b in found]


# The automaton that a worker made last, by its name; its next tasks use it again.
_kept: dict[str, Scanner] = {}


def _scanner(name: str, sent) -> Scanner:
    if name not in _kept:
        _kept.clear()
        _kept[name] = Scanner(sent.value)
    return _kept[name]


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text"):
    """The items as lists of (id, text), each of about ``BLOCK_BYTES`` of text; one is the rule."""
    rows = benchmark.select(
        F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("item"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    ).filter("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // BLOCK_BYTES + 1
    for block in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == block)
        yield [(r.item, bytes(r.text)) for r in part.distinct().collect()]


def _scanners(df: DataFrame, benchmark: DataFrame, window: int):
    """For each automaton a function that tasks get it from."""
    for items in blocks(benchmark):
        sent = df.sparkSession.sparkContext.broadcast(patterns(items, window))
        name = uuid.uuid4().hex
        yield lambda name=name, sent=sent: _scanner(name, sent)


FOUND = "struct<n_words:long,ranges:array<struct<start:int,end:int>>,items:array<string>>"


def spans(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    column: str = "spans",
) -> DataFrame:
    """``df`` with ``column``: how many words, which are in windows, and of which items.

    Ranges of words are in order and do not touch; items are sorted. A column of that name,
    in any case of letters, is replaced.
    """
    kept = [c for c in df.columns if c.lower() != column.lower()]
    rows = df.select(F.struct(*[f"`{c}`" for c in kept]).alias("row"), F.lit(None).cast(FOUND).alias("found"))
    at, schema = kept.index(text), rows.schema
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("ranges", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ("items", pa.list_(pa.string())),
        ]
    )
    for scanner_of in _scanners(df, benchmark, window):

        def run(batches, scanner_of=scanner_of):
            scanner = scanner_of()
            for whole in batches:
                own = pa.record_batch([whole.column("row"), whole.column("found"), whole.column("row").field(at)], ["row", "found", "text"])
                for batch in slices([own]):
                    found = []
                    for old, t in zip(batch.column("found").to_pylist(), texts(batch)):
                        words = words_of(t)
                        starts, ends, numbers = scanner.found(words)
                        ranges = [*zip(starts.tolist(), ends.tolist())]
                        items = scanner.items_of(numbers)
                        if old:
                            ranges += [(r["start"], r["end"]) for r in old["ranges"]]
                            items += old["items"]
                        ranges = [{"start": a, "end": b} for a, b in merged(ranges)]
                        found.append({"n_words": len(words), "ranges": ranges, "items": sorted({*items})})
                    yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, kind)], ["row", "found"])

        rows = rows.mapInArrow(run, schema)
    return rows.select("row.*", F.col("found").alias(column))


def character_spans(text: str, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges of a text as ranges of its characters."""
    coded = text.encode()
    normal = np.frombuffer(coded.translate(NORMAL), np.uint8)
    edge = np.diff(np.r_[0, (normal != 32).astype(np.int8), 0])
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [
        (len(coded[: begins[a]].decode()), len(coded[: ends[b - 1]].decode())) for a, b in hits
    ]


def contamination(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_words, n_hit (words inside windows), items (sorted), contaminated."""
    rows = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = spans(rows, benchmark, column="found")
    hit = F.aggregate(
        "found.ranges", F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["start"]).cast("long")
    )
    return found.select(
        "doc_id", "found.n_words", hit.alias("n_hit"), "found.items", (F.size("found.ranges") > 0).alias("contaminated")
    )


def clean(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` in which no window of the benchmark occurs."""
    schema = df.schema
    for scanner_of in _scanners(df, benchmark, WINDOW):

        def run(batches, scanner_of=scanner_of):
            scanner = scanner_of()
            for batch in slices(batches, text):
                hit = [len(scanner.found(words_of(t))[0]) > 0 for t in texts(batch, text)]
                yield batch.filter(pa.array([not h for h in hit], pa.bool_()))

        df = df.mapInArrow(run, schema)
    return df
