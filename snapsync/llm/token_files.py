"""Token ids in binary shard files with a minimal perfect hash index.

A shard holds the documents of a range of ids, in ascending order (rows of one id by
their token ids), and SHARD_BYTES or one document at most. Its file begins with
the raw token ids (little-endian unsigned integers, one document after another); then
come the index and a trailer that says where the index begins:

    ids | doc ids | hash levels | fingerprints | starts | counts | trailer | newline

The hash maps a key (doc id, and how many rows of the shard before have the same id) to
one of n slots without collisions: each level is a bit array in which keys that are alone at
their place set a bit, the others go on to the next level; the slot is the number of bits
before. A slot stores a fingerprint of its key, which tells an absent key from a present
one, and where the ids of the document begin and how many there are.

Files are written through Spark's text writer, one value per file, so they land in any
store and only when their task commits. The folder names of a shard carry its first and
last id and its counts; the manifest is read from them, without opening a file. NULL doc
ids come first. NULL texts are empty: they have the end id only.

Tasks get shares of the key (doc id, then token ids) that hold about as many bytes each, by
a sample of the bytes. An id with more than one share is cut by its token ids; rows alike
in their first KEY_BYTES of those are dealt to all shares that end or begin with them.
What a share has above SHARD_BYTES goes to further shards of the same task. The manifest
says how many rows of a shard's first id are in the shards before.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapsync.llm.common import expand, slices, texts, written
from snapsync.storage import Storage, workspace

# Of text in a share, on average; of token ids in a shard, at most.
SHARD_BYTES = 16 << 20
DOC_BYTES = 256  # What a document costs besides
POINTS, HOT_POINTS = 128, 16  # of the sample, for each share
KEY_BYTES = 4096  # of token ids, by which the rows of one id are cut
# The most points that the driver gets (8 bytes), and of hot ids (KEY_BYTES): 64 MB each.
MOST_POINTS, MOST_HOT_POINTS = 1 << 23, 1 << 14
PIECES = 1 << 24  # shards of a share
CACHE_WORDS = 500_000
# Words that are encoded as one text.
JOINED_WORDS = 1000
MAGIC = b"TOKSHRD1"
TRAILER = struct.Struct("<8sQQQIII")  # magic, index offset, docs, NULL ids, width, levels, salt
LEVELS = 64


# Encoding ----------------------------------------------------------------


# Fixed value: the word pattern of the tokenizers that may be fed single words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
MARKS = ".,;:!?"
LANES = 3  # of eight bytes each: words of up to 24 bytes are told apart by them
LANE_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _by_words(spec: dict) -> bool:
    """Whether words between white space can be encoded one by one.

    That holds if every step treats white space as a boundary and drops it.
    """
    normalizer = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = normalizer.get("normalizers", [normalizer])
    plain = all(
        s["type"] in ("NFC", "Lowercase")
        or (s["type"], s.get("pattern"), s.get("content")) == ("Replace", {"Regex": "\\s+"}, " ")
        for s in steps
    )
    splitter = spec.get("pre_tokenizer") or {}
    first = splitter.get("pretokenizers", [splitter])[0]
    return (
        plain
        and first.get("type") == "Split"
        and first.get("behavior") == "Removed"
        and bool(first.get("invert"))
        and first.get("pattern") == {"Regex": WORD_PATTERN}
        and not spec.get("post_processor")
        and not any(t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens") or [])
    )


class WordTable:
    """Words by number. Short ones are found together, by their bytes as integers."""

    def __init__(self):
        self.hashes = np.empty(0, np.uint64)
        self.lanes = np.empty((LANES + 1, 0), np.uint64)
        self.numbers = np.empty(0, np.int64)
        self.others: dict[bytes, int] = {}
        self.size = 0
        # In how many calls a word was met, by its number.
        self.met = np.empty(0, np.int32)

    def numbered(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """The number of each word ``text[start:end]``, and the words that are new.

        ``text`` goes on for 32 bytes after the last word. New words get the next numbers,
        in the order in which they are returned.
        """
        size = ends - starts
        eights = np.ndarray((len(text) - 7,), "<u8", text.data, strides=(1,))
        lanes = np.empty((LANES + 1, len(starts)), np.uint64)
        for i in range(LANES):
            lanes[i] = eights[starts + 8 * i] & LANE_MASKS[np.clip(size - 8 * i, 0, 8)]
        lanes[LANES] = size
        hashes = scrambled(lanes[0], 11) + lanes[LANES]
        for i in range(1, LANES):
            hashes = scrambled(hashes ^ lanes[i], 11 + i)
        found, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, found)
        known = np.zeros(len(found), bool)
        inside = np.flatnonzero(at < len(self.hashes))
        known[inside] = self.hashes[at[inside]] == found[inside]
        # The hash only sorts: a word is one that is known if all its bytes are the same.
        odd = (size > 8 * LANES) | (lanes != lanes[:, first[of]]).any(0)
        clash = np.zeros(len(found), bool)
        clash[known] = (self.lanes[:, at[known]] != lanes[:, first[known]]).any(0)
        odd |= clash[of]
        # Only words that are not odd may be entered.
        fresh = ~known & ~odd[first]
        numbers = np.full(len(found), -1, np.int64)
        numbers[known] = self.numbers[at[known]]
        numbers[fresh] = self.size + np.arange(fresh.sum())
        self.size += int(fresh.sum())
        new = [text[a:b].tobytes() for a, b in zip(starts[first[fresh]], ends[first[fresh]])]
        self.hashes = np.insert(self.hashes, at[fresh], found[fresh])
        self.lanes = np.insert(self.lanes, at[fresh], lanes[:, first[fresh]], axis=1)
        self.numbers = np.insert(self.numbers, at[fresh], numbers[fresh])
        self.met = np.r_[self.met, np.zeros(len(new), np.int32)]
        self.met[numbers[numbers >= 0]] += 1
        out = numbers[of]
        # A word that shares the hash of an odd one is found by itself, too.
        odd |= out < 0
        for i in np.flatnonzero(odd).tolist():
            word = text[starts[i] : ends[i]].tobytes()
            if word not in self.others:
                self.others[word] = self.size
                self.size += 1
                new.append(word)
            out[i] = self.others[word]
        self.met = np.r_[self.met, np.zeros(self.size - len(self.met), np.int32)]
        return out, new

    def thin(self, most: int) -> np.ndarray:
        """Forget all words but those met often, ``most`` or fewer -> which stay, by number.

        Those get the next numbers from 0 on, and stay again if they are met again.
        """
        least = 2
        while (self.met >= least).sum() > most:
            least *= 2
        stay = self.met >= least
        stay[list(self.others.values())] = False
        rows = stay[self.numbers]
        self.hashes, self.lanes = self.hashes[rows], self.lanes[:, rows]
        self.numbers = (np.cumsum(stay) - 1)[self.numbers[rows]]
        self.others = {}
        self.size = int(stay.sum())
        self.met = np.ones(self.size, np.int32)
        return stay


class Encoder:
    """Ids by the tokenizers library; a word that a task has met is not encoded again,
    unless it was met too seldom to be kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_words = _by_words(spec)
        # A-Z may be put in lower case at once where the tokenizer does so anyway.
        self.lower = self.by_words and '"Lowercase"' in json.dumps(spec["normalizer"])
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Whether a token ends a word, for tokenizers that say so.
        suffix, self.ends = spec["model"].get("end_of_word_suffix"), None
        if self.by_words and suffix:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.marks = {}
        for m in MARKS if self.by_words else "":
            ids = self.tokenizer.encode(m, add_special_tokens=False).ids
            if len(ids) == 1:
                self.marks[m] = ids[0]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.words = WordTable()
        self.ids = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _forget(self):
        """Half of the words that a task may keep stay at most."""
        stay = self.words.thin(CACHE_WORDS // 2)
        counts = np.diff(self.starts)[stay]
        self.ids = self.ids[expand(self.starts[:-1][stay], counts)]
        self.starts = np.r_[0, np.cumsum(counts)]

    def _joined(self, part: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are encoded as one text, and how many each word has."""
        text = " ".join(part)
        if self.ends is not None and "".join(part).isalpha():
            (coded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(coded.ids, np.uint32)
            # A word of letters has one token that ends a word; if that adds up, each has.
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(part):
                return ids, np.diff(last, prepend=-1)
        coded = self.tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(coded.ids, np.uint32)
        # A token belongs to the word in which it starts.
        begins = np.cumsum([0, *(len(w) + 1 for w in part[:-1])])
        at = np.fromiter((o[0] for o in coded.offsets), np.int64, len(ids))
        of = np.searchsorted(begins, at, side="right") - 1
        return ids, np.bincount(of, minlength=len(part))

    def _learn(self, new: list[bytes]) -> None:
        """Ids of words, which get the next places."""
        words = [w.decode() for w in new]
        # A mark right after letters is a token of its own, the same after any.
        mark = np.full(len(words), -1, np.int64)
        for i, w in enumerate(words):
            if w[-1] in self.marks and w[:-1].isalpha():
                words[i], mark[i] = w[:-1], self.marks[w[-1]]
        letters = np.array([w.isalpha() for w in words], bool)
        # Words of letters are joined with their like, which is cheaper.
        order = np.argsort(~letters, kind="stable")
        cut = int(letters.sum())
        ids, counts = [], []
        for low, high in ((0, cut), (cut, len(words))):
            for i in range(low, high, JOINED_WORDS):
                part = [words[k] for k in order[i : min(i + JOINED_WORDS, high)].tolist()]
                own, n = self._joined(part)
                ids.append(own)
                counts.append(n)
        flat, n = np.concatenate(ids), np.concatenate(counts)
        # Back from the order of encoding, with the marks.
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        begins, n = (np.cumsum(n) - n)[place], n[place]
        whole = n + (mark >= 0)
        starts = np.cumsum(whole) - whole
        out = np.empty(int(whole.sum()), np.uint32)
        out[expand(starts, n)] = flat[expand(begins, n)]
        out[(starts + n)[mark >= 0]] = mark[mark >= 0]
        self.ids = np.concatenate([self.ids, out])
        self.starts = np.r_[self.starts, self.starts[-1] + np.cumsum(whole)]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each begins and ends."""
        if not self.by_words:
            coded = [
                self.tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in texts
            ]
            ends = np.r_[0, np.cumsum([len(ids) for ids in coded])].astype(np.int64)
            return np.fromiter((i for ids in coded for i in ids), np.uint32, ends[-1]), ends
        joined = b"\n".join([b"", *texts, b" " * 32])
        text = np.frombuffer(joined.lower() if self.lower else joined, np.uint8)
        edge = np.diff(SPACES[text].astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
        if self.words.size > CACHE_WORDS:
            self._forget()
        at, new = self.words.numbered(text, starts, ends)
        if new:
            self._learn(new)
        counts = self.starts[at + 1] - self.starts[at]
        ids = self.ids[expand(self.starts[at], counts)]
        begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
        return ids, np.r_[0, np.cumsum(counts)][np.searchsorted(starts, begins)]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


# The index ---------------------------------------------------------------


def scrambled(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit integers, another one for each seed."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def key_hashes(ids: np.ndarray, null: np.ndarray, ordinals: np.ndarray, salt: int) -> np.ndarray:
    first = scrambled(ids.astype(np.int64).view(np.uint64), 2 * salt)
    first = np.where(null, np.uint64(0xA5A5A5A5A5A5A5A5), first)
    return scrambled(first + scrambled(ordinals.astype(np.uint64), 1), 2 * salt + 1)


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (scrambled(hashes, 1001) >> np.uint64(32)).astype(np.uint32)


def build_levels(hashes: np.ndarray) -> list[np.ndarray] | None:
    """The bit arrays of a minimal perfect hash; None if two keys have one hash."""
    levels, rest = [], hashes
    while len(rest):
        if len(levels) == LEVELS:
            return None
        size = 64 * (len(rest) // 32 + 1)
        place = (scrambled(rest, 7 + len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size)[place] == 1
        bits = np.zeros(size, np.uint8)
        bits[place[alone]] = 1
        levels.append(bits)
        rest = rest[~alone]
    return levels


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        flat = np.concatenate(levels) if levels else np.empty(0, np.uint8)
        self.before = np.cumsum(flat, dtype=np.int64) - flat
        self.first = np.cumsum([0, *map(len, levels)])

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some keys that are absent."""
        found = np.full(len(hashes), -1, np.int64)
        rest = np.arange(len(hashes))
        for i, bits in enumerate(self.levels):
            place = scrambled(hashes[rest], 7 + i) % np.uint64(len(bits))
            place = place.astype(np.int64)
            hit = bits[place] == 1
            found[rest[hit]] = self.before[self.first[i] + place[hit]]
            rest = rest[~hit]
        return found


def ordinals_of(ids: np.ndarray, null: np.ndarray) -> np.ndarray:
    """How many rows before have the same id; ids are sorted, NULLs first."""
    n = len(ids)
    if not n:
        return np.empty(0, np.int64)
    head = np.r_[True, (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])]
    return np.arange(n) - np.flatnonzero(head)[np.cumsum(head) - 1]


def shard_bytes(ids: np.ndarray, null: np.ndarray, tokens: list[bytes], width: int) -> bytes:
    """The file of a shard, from document ids in order and their packed token ids."""
    n = len(ids)
    counts = np.array([len(t) // width for t in tokens], np.int64)
    starts = np.cumsum(counts) - counts
    ordinals = ordinals_of(ids, null)
    for salt in range(8):
        hashes = key_hashes(ids, null, ordinals, salt)
        if (levels := build_levels(hashes)) is not None:
            break
    else:
        raise ValueError("no perfect hash found")
    slot = PerfectHash(levels).slots(hashes)
    prints, at, size = np.empty(n, "<u4"), np.empty(n, "<u8"), np.empty(n, "<u4")
    prints[slot], at[slot], size[slot] = fingerprints(hashes), starts, counts
    payload = b"".join(tokens)
    index = [ids.astype("<i8").tobytes()]
    for bits in levels:
        index += [struct.pack("<Q", len(bits)), np.packbits(bits, bitorder="little").tobytes()]
    index += [prints.tobytes(), at.tobytes(), size.tobytes()]
    trailer = TRAILER.pack(MAGIC, len(payload), n, int(null.sum()), width, len(levels), salt)
    return b"".join([payload, *index, trailer])


class Shard:
    """A shard file that has been read."""

    def __init__(self, content: bytes):
        content = memoryview(content)[:-1]
        magic, offset, n, n_null, width, n_levels, self.salt = TRAILER.unpack(
            content[-TRAILER.size :]
        )
        if magic != MAGIC:
            raise ValueError("not a shard file")
        self.ids = np.frombuffer(content, f"<u{width}", offset // width)
        self.docs = np.frombuffer(content, "<i8", n, offset)
        self.null = np.arange(n) < n_null
        offset += 8 * n
        levels = []
        for _ in range(n_levels):
            (size,) = struct.unpack_from("<Q", content, offset)
            packed = np.frombuffer(content, np.uint8, size // 8, offset + 8)
            levels.append(np.unpackbits(packed, bitorder="little"))
            offset += 8 + size // 8
        self.hash = PerfectHash(levels)
        self.prints = np.frombuffer(content, "<u4", n, offset)
        self.starts = np.frombuffer(content, "<u8", n, offset + 4 * n)
        self.counts = np.frombuffer(content, "<u4", n, offset + 12 * n)

    def find(self, ids, null, ordinals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each key is there, where its ids begin, and how many there are."""
        hashes = key_hashes(ids, null, ordinals, self.salt)
        slot = self.hash.slots(hashes)
        there = slot >= 0
        there[there] = self.prints[slot[there]] == fingerprints(hashes[there])
        at = np.where(there, slot, 0)
        if not len(self.prints):
            return there, at, at
        return there, self.starts[at].astype(np.int64), self.counts[at].astype(np.int64)


# Writing and reading -----------------------------------------------------

# Folder names that carry the manifest. ``tail`` rows have the last id.
PARTS = ["shard", "first", "last", "docs", "tail", "tokens"]
FILES = ", ".join(
    ["path string, modificationTime timestamp, length long, content binary"]
    + [f"{name} long" for name in PARTS]
)


def _sampled(rows: DataFrame, step: int, path: str | None = None, end: int = 0) -> DataFrame:
    """``doc_id`` at each ``step`` bytes of the rows; with a tokenizer, their first token ids.

    A long document is there once for each step that it fills.
    """

    def run(batches):
        held = step * (TaskContext.get().partitionId() * 0.6180339887 % 1)
        for batch in batches:
            size = pc.fill_null(batch.column("size"), 0).to_numpy().astype(np.int64) + DOC_BYTES
            passed = ((held + np.cumsum(size)) // step).astype(np.int64)
            times = np.diff(passed, prepend=0)
            held = held + int(size.sum()) - step * int(passed[-1]) if len(size) else held
            at = np.flatnonzero(times)
            out = [batch.column("doc_id").take(pa.array(np.repeat(at, times[at])))]
            if path:
                own = encoder(path)
                found = []
                for i in at.tolist():
                    ids, _ = own.encode(texts(batch.slice(i, 1)))
                    key = np.r_[ids, end].astype(f"<u{own.width}").tobytes()[:KEY_BYTES]
                    found += [key] * int(times[i])
                out.append(pa.array(found, pa.binary()))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "key"][: len(out)])

    size = F.octet_length("text").alias("size")
    if path:
        return rows.select("doc_id", size, "text").mapInArrow(run, "doc_id long, key binary")
    return rows.select("doc_id", size).mapInArrow(run, "doc_id long")


def _thinned(points: DataFrame, most: int) -> pa.Table:
    """The points, or every k-th of them in their order, such that about ``most`` are left.

    They are sorted by Spark; the driver gets no more, whatever the table's size. Bounds are
    cut from fewer points then, and shares grow instead of their number.
    """
    points = written(points, "token-points")
    every = -(-points.count() // most)
    if every <= 1:
        return points.toArrow()

    def run(batches):
        passed = every // 2
        for batch in batches:
            at = np.arange(batch.num_rows) + passed
            yield batch.take(pa.array(np.flatnonzero(at % every == every - 1)))
            passed += batch.num_rows

    order = points.columns
    ordered = points.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, points.schema).toArrow()


class Shares:
    """Bounds of the shares of (doc_id, token ids), NULLs first."""

    def __init__(self, rows: DataFrame, path: str, end: int):
        points = _thinned(_sampled(rows, max(SHARD_BYTES // POINTS, 1)), MOST_POINTS).column("doc_id")
        n = len(points) // POINTS + 1
        nulls = points.null_count
        ids = np.sort(points.drop_null().to_numpy())
        at = np.arange(1, n) * len(points) // n
        self.nulls = int((at < nulls).sum())
        self.ids = ids[at[self.nulls :] - nulls]
        self.count = n
        # Ids with several bounds, and those as token ids.
        found, times = np.unique(self.ids, return_counts=True)
        self.hot: dict[int | None, list[bytes]] = {}
        several = [None] * (self.nulls > 1) + found[times > 1].tolist()
        if not several:
            return
        hot = F.col("doc_id").isin([d for d in several if d is not None])
        if self.nulls > 1:
            hot = F.col("doc_id").isNull() | hot
        keys = _sampled(rows.filter(hot), max(SHARD_BYTES // HOT_POINTS, 1), path, end)
        keys = _thinned(keys, MOST_HOT_POINTS)
        grouped = {d: [] for d in several}
        for d, key in zip(*(keys.column(c).to_pylist() for c in ("doc_id", "key"))):
            grouped[d].append(key)
        for d in several:
            low, high = 0, nulls
            if d is not None:
                low, high = (nulls + np.searchsorted(ids, d, side) for side in ("left", "right"))
            of, own = at[(low <= at) & (at < high)], sorted(grouped[d]) or [b""]
            self.hot[d] = [own[i] for i in ((of - low) * len(own) // (high - low)).tolist()]

    def of(self, docs: pa.Array, ids: list[bytes], seen: Counter) -> np.ndarray:
        """The share of each row. ``seen`` counts alike rows of a task."""
        null = docs.is_null().to_numpy(zero_copy_only=False)
        own = docs.fill_null(0).to_numpy()
        share = self.nulls + np.searchsorted(self.ids, own, side="right")
        share[null] = self.nulls
        if not self.hot:
            return share
        hot = np.isin(own, [d for d in self.hot if d is not None]) & ~null
        if None in self.hot:
            hot |= null
        first = self.nulls + np.searchsorted(self.ids, own, side="left")
        first[null] = 0
        task = TaskContext.get().partitionId()
        for i in np.flatnonzero(hot).tolist():
            d, key = None if null[i] else int(own[i]), ids[i][:KEY_BYTES]
            cuts = self.hot[d]
            low, high = bisect_left(cuts, key), bisect_right(cuts, key)
            if low < high:
                # By content and count, not by place: a task that is run again deals alike.
                crc = zlib.crc32(ids[i])
                low += (crc + task + seen[d, crc]) % (high - low + 1)
                seen[d, crc] += 1
            share[i] = first[i] + low
        return share


def write(df: DataFrame, path: str, end: int, key: str = "doc_id", text: str = "text") -> str:
    """Encode ``df`` with the tokenizer file ``path`` -> the folder of the shard files."""
    spark = df.sparkSession
    rows = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    shares = Shares(rows, path, end)
    sent = spark.sparkContext.broadcast(shares)
    most = SHARD_BYTES

    def encode(batches):
        own = encoder(path)
        kind = f"<u{own.width}"
        last = np.array([end], kind).tobytes()
        seen = Counter()
        for batch in slices(batches):
            ids, ends = own.encode(texts(batch))
            ids = ids.astype(kind)
            packed = [ids[a:b].tobytes() + last for a, b in zip(ends, ends[1:])]
            docs = batch.column("doc_id")
            share = sent.value.of(docs, packed, seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(share, pa.int32()), docs, pa.array(packed, pa.binary())],
                ["share", "doc_id", "ids"],
            )

    coded = rows.mapInArrow(encode, "share int, doc_id long, ids binary")
    # A task for each share: hashed numbers would put several into one.
    dealt = coded.repartitionById(shares.count, "share")
    dealt = dealt.sortWithinPartitions("share", "doc_id", "ids")

    def build(batches):
        width = encoder(path).width
        share, piece, held, docs, tokens = None, 0, 0, [], []

        def whole():
            column = pa.chunked_array(docs, pa.int64()).combine_chunks()
            null = column.is_null().to_numpy(zero_copy_only=False)
            ids = column.fill_null(0).to_numpy()
            content = shard_bytes(ids, null, tokens, width)
            tail = int(((ids == ids[-1]) & (null == null[-1])).sum())
            found = [share * PIECES + piece, column[0].as_py(), column[-1].as_py(), len(ids), tail]
            found.append(sum(map(len, tokens)) // width)
            return pa.RecordBatch.from_arrays(
                [*(pa.array([v], pa.int64()) for v in found), pa.array([content], pa.binary())],
                [*PARTS, "value"],
            )

        for batch in batches:
            of = batch.column("share").to_numpy()
            cost = pc.binary_length(batch.column("ids")).to_numpy().astype(np.int64) + DOC_BYTES
            a = 0
            while a < len(of):
                if share is not None and of[a] != share:
                    yield whole()
                    share, piece, held, docs, tokens = None, 0, 0, [], []
                share = int(of[a])
                filled = held + np.cumsum(cost[a : np.searchsorted(of, share, side="right")])
                n = int(np.searchsorted(filled, most, side="right"))
                if not n and held:
                    yield whole()
                    piece, held, docs, tokens = piece + 1, 0, [], []
                    continue
                n = max(n, 1)
                docs.append(batch.column("doc_id").slice(a, n))
                tokens += batch.column("ids").slice(a, n).to_pylist()
                held, a = int(filled[n - 1]), a + n
        if share is not None:
            yield whole()

    folder = workspace(spark, "token-shards")
    files = dealt.mapInArrow(build, ", ".join(f"{p} long" for p in PARTS) + ", value binary")
    files = files.withColumn("value", F.col("value").cast("string"))
    files.write.partitionBy(*PARTS).text(folder)
    return folder


def _files(spark: SparkSession, folder: str) -> DataFrame:
    if not any("=" in name for name in Storage(spark, folder).child_names()):
        return spark.createDataFrame([], FILES)
    found = spark.read.format("binaryFile").load(folder)
    return found.withColumns({p: F.col(p).cast("long") for p in PARTS})


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard: its ids, counts, and what the shards before it have.

    ``base`` counts their token ids, ``ordinal`` their rows with this shard's first id.
    """
    order = Window.orderBy("shard")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    found = _files(spark, folder).select(*PARTS)
    found = found.withColumn("upto", F.sum("tail").over(Window.partitionBy("last").orderBy("shard")))
    goes_on = F.lag("last").over(order).eqNullSafe(F.col("first"))
    return found.select(
        *PARTS,
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"),
        F.when(goes_on, F.coalesce(F.lag("upto").over(order), F.lit(0))).otherwise(0).alias("ordinal"),
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, looked up in the index: doc_id, start, n_tokens, ids_crc32."""

    def run(batches):
        for batch in batches:
            for number, content in zip(*(batch.column(c) for c in ("shard", "content"))):
                shard = Shard(content.as_py())
                ordinals = ordinals_of(shard.docs, shard.null)
                there, starts, counts = shard.find(shard.docs, shard.null, ordinals)
                if not there.all():
                    raise ValueError("a document is not in the index of its shard")
                crc = [
                    zlib.crc32(shard.ids[a : a + c].astype("<u4").tobytes())
                    for a, c in zip(starts.tolist(), counts.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number.as_py()] * len(crc), pa.int64()),
                        pa.array(shard.docs, pa.int64(), mask=shard.null),
                        pa.array(starts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["shard", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    files = _files(spark, folder).select("shard", "content")
    found = files.mapInArrow(
        run, "shard long, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    bases = manifest(spark, folder).select("shard", "base")
    return found.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def lookup(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """``doc_id``, ``ids`` for each key of ``keys.doc_id`` that is there (its first row).

    A key goes to the first shard that ends with it or later; the shard's bytes come to
    its keys. The list of shards is the only thing that is sent to all executors.
    """
    shards = _files(spark, folder).filter("last IS NOT NULL").select("shard", "last")
    shards = shards.orderBy("shard").collect()
    lasts = np.array([s["last"] for s in shards], np.int64)
    numbers = np.array([s.shard for s in shards], np.int64)
    sent = spark.sparkContext.broadcast((lasts, numbers))

    def route(batches):
        lasts, numbers = sent.value
        for batch in batches:
            docs = batch.column("doc_id").drop_null()
            at = np.searchsorted(lasts, docs.to_numpy(), side="left")
            docs, at = docs.filter(pa.array(at < len(lasts))), at[at < len(lasts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[at], pa.int64()), docs], ["shard", "doc_id"]
            )

    def find(key, asked, file):
        ids = asked.column("doc_id").to_numpy()
        if not len(ids) or not file.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64()))})
        shard = Shard(file.column("content")[0].as_py())
        there, at, n = shard.find(ids, np.zeros(len(ids), bool), np.zeros(len(ids), np.int64))
        found = [shard.ids[a : a + c].tolist() for a, c in zip(at[there].tolist(), n[there].tolist())]
        return pa.table(
            {"doc_id": pa.array(ids[there]), "ids": pa.array(found, pa.list_(pa.int64()))}
        )

    wanted = keys.select(F.col("doc_id").cast("long")).distinct()
    routed = wanted.mapInArrow(route, "shard long, doc_id long")
    files = _files(spark, folder).select("shard", "content")
    return (
        routed.groupBy("shard")
        .cogroup(files.groupBy("shard"))
        .applyInArrow(find, "doc_id long, ids array<long>")
    )
