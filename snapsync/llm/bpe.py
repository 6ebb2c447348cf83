"""Byte-level BPE encoding and decoding with a public tokenizer file.

A task encodes the words it has not met yet together: the symbols of all of them lie in
one flat array, and each round merges, in every word at once, the pair of lowest rank.
Ranks come from a binary search over the sorted pair keys. The token ids of a word are
kept for the next texts of the task; that memory is bounded by ``CACHE_WORDS``.

NULL texts are empty. Special tokens in a text are cut out first and become their ids,
as the tokenizers library does by default.
"""

from __future__ import annotations

import json
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, DataType, LongType, StringType, StructField, StructType

from snapsync.llm.common import expand, slices

# Fixed value: the pattern that splits texts of this kind of tokenizer into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS = 300_000
NO_RANK = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that a vocabulary of this kind writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    others = (b for b in range(256) if b not in letters)
    letters |= {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class ByteBpe:
    """The model of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec["pre_tokenizer"]
        if (
            model["type"] != "BPE"
            or splitter != splitter | {"type": "ByteLevel", "add_prefix_space": False}
            or not splitter.get("use_regex", True)
            or spec["normalizer"]
            or any(model.get(k) for k in ("dropout", "end_of_word_suffix", "byte_fallback"))
            or any(model.get(k) for k in ("continuing_subword_prefix", "ignore_merges"))
        ):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        self.size = max(vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        result = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # A round merges all places of a pair at once. That equals one merge after the
        # other where a merge's parts were made by earlier ones.
        made = np.full(self.size, -1, np.int64)
        made[result[::-1]] = np.arange(len(pairs))[::-1]
        if (np.maximum(made[left], made[right]) >= np.arange(len(pairs))).any():
            raise ValueError(f"{path}: a merge comes before the merges of its parts")
        keys = left * self.size + right
        self.ranks = np.argsort(keys, kind="stable")
        self.keys = keys[self.ranks]
        self.results = result
        # Decoding, and special tokens.
        to_byte = {c: b for b, c in enumerate(letters)}
        self.pieces = {i: bytes(to_byte[c] for c in token) for token, i in vocab.items()}
        added = spec.get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path}: added tokens that take in their surroundings")
        self.special = {t["content"]: t["id"] for t in added}
        self.pieces |= {i: s.encode() for s, i in self.special.items()}
        self.words = regex.compile(PATTERN)
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {s: k for k, s in enumerate(self.special)}
        self.ids = np.array([*self.special.values()], np.int64)
        self.starts = np.arange(len(self.special) + 1, dtype=np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one word after another, and each word's count."""
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [symbols[:0]], [word[:0]]
        if not len(self.keys):
            return symbols, lengths

        def ranked(at: np.ndarray) -> np.ndarray:
            """Rank of the pair that begins at each place."""
            after = np.minimum(at + 1, len(symbols) - 1)
            same = (after > at) & (word[after] == word[at])
            return np.where(same, self._rank(symbols[at], symbols[after]), NO_RANK)

        rank = ranked(np.arange(len(symbols)))
        while len(symbols):
            # The lowest rank of each word; words without one are finished.
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[first, len(word)])
            lowest = np.minimum.reduceat(rank, first)
            if (finished := lowest == NO_RANK).any():
                out = np.repeat(finished, size)
                done_symbols.append(symbols[out])
                done_words.append(word[out])
                symbols, word, rank = symbols[~out], word[~out], rank[~out]
                size, lowest = size[~finished], lowest[~finished]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == np.repeat(lowest, size))
            # In a run of overlapping places (a a a) every second one merges.
            head = np.r_[True, np.diff(hits) != 1]
            run = np.flatnonzero(head)[np.cumsum(head) - 1]
            hits = hits[(np.arange(len(hits)) - run) % 2 == 0]
            symbols[hits] = self.results[rank[hits]]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            at = (np.cumsum(keep) - 1)[hits]
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            rank[at] = ranked(at)
            before = at[at > 0] - 1
            rank[before] = ranked(before)
        order = np.argsort(where := np.concatenate(done_words), kind="stable")
        return np.concatenate(done_symbols)[order], np.bincount(where, minlength=len(words))

    def _learn(self, words: set[str]) -> None:
        fresh = [*words]
        ids, counts = self.merge([w.encode() for w in fresh])
        self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
        self.starts = np.r_[self.starts, self.starts[-1] + np.cumsum(counts)]
        self.ids = np.r_[self.ids, ids]

    def split(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return self.words.findall(text)
        words = []
        for i, part in enumerate(self.cut.split(text)):
            words += [part] if i % 2 else self.words.findall(part)
        return words

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after another, and where each text begins and ends."""
        split = [self.split(t) for t in texts]
        words = [w for text in split for w in text]
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        if len(missing := np.flatnonzero(at < 0)):
            fresh = {words[i] for i in missing.tolist()}
            if len(self.known) + len(fresh) > CACHE_WORDS:
                # The words that were known are needed as well.
                self._forget()
                fresh, missing = set(words) - self.known.keys(), np.arange(len(words))
            self._learn(fresh)
            at[missing] = [self.known[words[i]] for i in missing.tolist()]
        counts = self.starts[at + 1] - self.starts[at]
        ids = self.ids[expand(self.starts[at], counts)]
        ends = np.r_[0, np.cumsum([len(text) for text in split])].astype(np.int64)
        return ids.astype("<u4"), np.r_[0, np.cumsum(counts)][ends]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


@cache
def model(path: str) -> ByteBpe:
    return ByteBpe(path)


ADDED = {"n_tokens": LongType(), "ids": BinaryType()}


def _with(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = {n: batch.column(n) for n in batch.schema.names if n.lower() not in columns}
    return pa.RecordBatch.from_pydict(kept | columns)


def _schema(df: DataFrame, added: dict[str, DataType]) -> StructType:
    # Spark tells no names apart by case.
    kept = [f for f in df.schema if f.name.lower() not in added]
    return StructType(kept + [StructField(n, t) for n, t in added.items()])


def encode(df: DataFrame, path: str, text: str = "text", check: bool = False) -> DataFrame:
    """``df`` with ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers).

    With ``check`` also ``decoded``, the text that the ids give back, from the same pass.
    Columns of those names, in any case of letters, are replaced; all others are kept. NULL
    is an empty text; texts are encoded whole, however long, and rows that repeat each.
    """
    added = ADDED | ({"decoded": StringType()} if check else {})

    def run(batches):
        bpe = model(path)
        for batch in slices(batches, text):
            column = ["" if t is None else t for t in batch.column(text).to_pylist()]
            ids, ends = bpe.encode(column)
            own = [ids[a:b] for a, b in zip(ends, ends[1:])]
            columns = {
                "n_tokens": pa.array(np.diff(ends), pa.int64()),
                "ids": pa.array([i.tobytes() for i in own], pa.binary()),
            }
            if check:
                columns["decoded"] = pa.array([bpe.decode(i) for i in own], pa.string())
            yield _with(batch, columns)

    return df.mapInArrow(run, _schema(df, added))


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the text of the column ``ids``; NULL ids give an empty text."""

    def run(batches):
        bpe = model(path)
        for batch in slices(batches, ids):
            packed = batch.column(ids).to_pylist()
            found = [bpe.decode(np.frombuffer(p or b"", "<u4")) for p in packed]
            yield _with(batch, {"decoded": pa.array(found, pa.string())})

    return df.mapInArrow(run, _schema(df, {"decoded": StringType()}))
