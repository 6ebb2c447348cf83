import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapsync.llm import ngram_join as nj

SCHEMA = "doc_id long, text string"


def shingles(text, size=4):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows, percent=85, size=4):
    """(doc_id, n, component) of each row, by comparing all pairs."""
    own = [shingles(t, size) for _, t in rows]
    root = [*range(len(rows))]

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            shared = len(own[a] & own[b])
            if own[a] and 100 * shared >= percent * len(own[a] | own[b]):
                root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(
        ((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, own))), key=str
    )


def joined(df, **options):
    return sorted((tuple(r) for r in nj.near_duplicates(df, **options).collect()), key=str)


def clusters(seed, n, long=90):
    """Texts in families of edited copies, chains of edits, and texts that share a passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(50)]
    rows = []
    while len(rows) < n:
        base = [word() for _ in range(rng.choice([1, 3, 6, 12, 30, long]))]
        kind = rng.random()
        if kind < 0.3:
            base = passage + base[:14]
        for _ in range(rng.choice([1, 1, 2, 8])):
            rows.append((rng.randrange(10**6), " ".join(base)))
            at = rng.randrange(len(base))
            base = [*base]
            if rng.random() < 0.5:
                base[at] = word()
            elif rng.random() < 0.5:
                base.insert(at, word())
            else:
                base.append(word())
    return rows


@pytest.mark.parametrize("percent", [60, 85, 100])
def test_linked_sets_share_a_key(percent):
    rng = np.random.default_rng(percent)
    for n in [1, 2, 5, 6, 7, 11, 12, 13, 22, 23, 40, 150, 700]:
        for _ in range(6):
            own = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
            # As many swaps and additions as a link allows.
            while True:
                other, low = own.copy(), rng.integers(0, 2)
                for _ in range(rng.integers(0, nj.differences(n, percent) + 1)):
                    fresh = rng.integers(0, 1 << 64, 1, np.uint64)
                    other = np.r_[other[1:], fresh] if low else np.r_[other, fresh]
                other = np.unique(other)
                shared = len(np.intersect1d(own, other))
                if 100 * shared >= percent * (n + len(other) - shared):
                    break
            if len(other) != n or shared != n:
                assert np.intersect1d(nj.keys(own, percent), nj.keys(other, percent)).size, (n, len(other), shared)


@pytest.mark.parametrize("seed", range(4))
def test_tree_connects_what_all_pairs_do(seed):
    rng = random.Random(seed)
    rows = [t for _, t in clusters(seed, 150)]
    own = [nj.shingles(t.encode()) for t in rows]
    block = np.array([rng.randrange(2) for _ in own])
    known = np.array([rng.randrange(150) for _ in own])
    for labels in (None, known):
        got, expected = nj.linked(block, own, labels), nj.Forest(len(own))
        for a in range(len(own)):
            for b in range(a):
                shared = len(np.intersect1d(own[a], own[b]))
                near = 100 * shared >= 85 * (len(own[a]) + len(own[b]) - shared)
                if labels is not None and labels[a] == labels[b]:
                    expected.join(a, b)
                if near and block[a] == block[b]:
                    expected.join(a, b)
        named = [[*map(x.tolist().index, x.tolist())] for x in (got, expected.labels())]
        assert named[0] == named[1]


@pytest.mark.parametrize("page", [1 << 20, 2000])
def test_against_brute_force(spark, monkeypatch, page):
    """Also with pages so small that blocks fill many of them."""
    monkeypatch.setattr(nj, "PAGE", page)
    rows = clusters(1, 250)
    rows += [rows[3]] * 5 + [(None, rows[4][1]), (None, "alone here"), (-3, None), (-2, ""), (-2, " \n"), (-1, "ONE"), (-9, "one")]
    rows += [(-20, "a b"), (-21, "a  B"), (-30, "word " * 9000), (-31, "word " * 5)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.withColumns({"node": F.lit(1), "row": F.lit("x"), "n": F.lit(2), "page": F.lit(3)})
    assert joined(df) == brute(rows)


def test_one_block_of_many_pages(spark, monkeypatch):
    """Edited copies of one text: two far components and a few outsiders in one block."""
    monkeypatch.setattr(nj, "PAGE", 4000)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        text = [*base]
        for at in range(18 if i % 3 else 0):
            text[at + 20] = f"x{at}"
        text[rng.randrange(15)] = f"y{i}"
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert joined(df) == brute(rows)


def test_other_sizes_and_thresholds(spark):
    rows = clusters(9, 80, long=25)
    df = spark.createDataFrame(rows, SCHEMA)
    assert joined(df, size=2, percent=60) == brute(rows, 60, 2)
    with pytest.raises(ValueError):
        nj.near_duplicates(df, percent=20)


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert joined(df) == []
    assert joined(spark.createDataFrame([(1, None), (None, "")], SCHEMA)) == [(1, 0, 1), (None, 0, None)]
