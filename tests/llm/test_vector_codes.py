import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapsync.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=8, size=16, rounds=6):
    """Codes by measuring every entry, in plain integers."""
    kept = [
        (i, [math.floor(4096 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    ids = sorted({i for i, _, _ in kept if i is not None})[:size]
    first = [next(v for i, v, _ in kept if i == k) for k in ids]
    width = len(first[0]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for v in first] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for _, v, _ in kept:
                own[nearest(cut(v)[p], books[p])[1]].append(cut(v)[p])
            books[p] = [
                [sum(c) // len(members) for c in zip(*members)] if members else e
                for members, e in zip(own, books[p])
            ]
    out, by_label = [], {}
    for i, v, label in kept:
        found = [nearest(cut(v)[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append([i, label, bytes(n for _, n in found), error])
    numbers = ",".join(str(x) for b in books for e in b for x in e)
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    return sorted([(*r, by_label[r[1]]) for r in out], key=str), digest


def found(df, **options):
    got, books = vc.compressed(df, **options)
    return sorted((tuple(r) for r in got.select("vec_id", "label", "code", "error", "label_error").collect()), key=str), books


def plain(rows):
    return [(i, label, None if c is None else bytes(c), e, t) for i, label, c, e, t in rows]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("ties", [False, True])
def test_orchard_finds_what_measuring_all_does(seed, ties):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-3 if ties else -900, 4 if ties else 900, (16, 4))
    entries[7] = entries[3]
    points = rng.integers(-4 if ties else -1000, 5 if ties else 1000, (2000, 4))
    apart = ((points[:, None] - entries[None]) ** 2).sum(2)
    best, least = vc.Orchard(entries).nearest(points)
    assert (best == apart.argmin(1)).all() and (least == apart.min(1)).all()


def test_one_entry():
    best, least = vc.Orchard(np.array([[1, 2]])).nearest(np.array([[1, 2], [4, 6]]))
    assert best.tolist() == [0, 0] and least.tolist() == [0, 25]


def rows_of(n, dimension, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, dimension))
    rows = []
    for i in range(n):
        v = (middle[i % 5] * 0.2 + rng.normal(size=dimension) * 0.05).tolist()
        rows.append((1000 - 3 * i, v, None if i % 7 == 0 else i % 3))
    return rows


def test_against_brute_force(spark):
    rows = rows_of(150, 16)
    rows += [(5001, None, 1), (-5, [None, *[0.1] * 15], 1), (-6, [math.nan] * 16, 2), (-7, [math.inf] * 16, 2)]
    # Copies in hot numbers, of one id and of many.
    rows += [rows[0]] * 40 + [(2000 + i, rows[1][1], 9) for i in range(60)] + [(None, rows[2][1], None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    df = df.withColumns({"code": F.lit(1), "vector": F.lit("x"), "of": F.lit(2), "x": F.lit(3)})
    got, books = found(df)
    expected, digest = brute(rows)
    assert plain(got) == expected
    assert books.digest() == digest
    codes, _ = vc.compressed(df)
    back = codes.select("code", vc.decoded(F.col("code"), books).alias("v")).first()
    assert back.v == np.concatenate([books.entries[p, c] for p, c in enumerate(back.code)]).tolist()


def test_few_vectors_and_other_lengths(spark):
    rows = [(1, [0.5] * 8, 1), (2, [-0.5] * 8, 1), (3, [0.1] * 5, None), (4, [], None)]
    got, books = found(spark.createDataFrame(rows, SCHEMA))
    assert plain(got) == [
        (1, 1, bytes(8), 0, 0), (2, 1, bytes([1] * 8), 0, 0), (3, None, None, None, None), (4, None, None, None, None),
    ]
    assert books.entries.shape == (8, 2, 1)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], 1)]])
def test_nothing_to_learn(spark, rows):
    got, books = found(spark.createDataFrame(rows, SCHEMA))
    assert plain(got) == ([(1, 1, None, None, None)] if rows and rows[0][1] == [] else [])
    assert books.digest() == hashlib.sha256(b"").hexdigest()


def test_too_large(spark):
    with pytest.raises(Exception, match="or greater"):
        found(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA))
