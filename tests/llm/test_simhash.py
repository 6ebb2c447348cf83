import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from snapsync.llm import common, simhash

SCHEMA = "doc_id long, text string"


def slow_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes, distance):
    """Smallest node reachable through links of at most ``distance`` bits."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(sorted(nodes), 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {n: find(n) for n in nodes}


def signed(x):
    return x - 2**64 if x >> 63 else x


@pytest.mark.parametrize("text", ["", " \n", "One", "one two", "A b C d", "x " * 5000, "é Ö z ß q"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) % 2**64 == slow_fingerprint(text)


def clustered(seed, n):
    """Fingerprints in tight clusters, chains and at random."""
    random.seed(seed)
    found = {0, 2**64 - 1}
    base = random.getrandbits(64)
    for _ in range(n):
        found.add(base ^ sum(1 << b for b in random.sample(range(64), random.choice([1, 2, 3, 4]))))
        found.add(random.getrandbits(64))
    chain = random.getrandbits(64)
    for _ in range(30):
        chain ^= sum(1 << b for b in random.sample(range(64), 2))
        found.add(chain)
    return [signed(x) for x in found]


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
@pytest.mark.parametrize("crowd", [2, 16, 10_000])
def test_groups_equal_those_of_all_pairs(spark, monkeypatch, distance, crowd):
    if distance == 3 and crowd == 16:
        pytest.skip("as the others")
    monkeypatch.setattr(simhash, "CROWD", crowd)
    nodes = clustered(distance, 60 if distance < 3 else 25)
    df = spark.createDataFrame([(n,) for n in nodes], "fp long")
    got = {r.fp: r.root for r in simhash.groups(df, distance).collect()}
    expected = slow_components(nodes, distance)
    assert got == expected


def test_long_chain(spark):
    nodes = [*range(200)]
    edges = spark.createDataFrame([*zip(nodes, nodes[1:]), (7, 7)], "a long, b long")
    assert {(r.node, r.root) for r in simhash.components(edges).collect()} == {(n, 0) for n in nodes}


def test_nulls_ties_and_copies(spark):
    rows = [(9, "a b c d"), (4, "A  b c D"), (4, "A  b c D"), (None, "a b c d"), (7, None), (5, ""), (None, "q r s t u")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(
        ((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str
    )
    assert got == sorted([(9, 4), (4, 4), (4, 4), (None, 4), (7, 5), (5, 5), (None, None)], key=str)
    clash = df.withColumns({"fp": F.lit(1), "component_id": F.lit("x"), "text_hash": F.lit(2)})
    kept = simhash.representatives(clash)
    assert kept.columns == clash.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [
        (4, "A  b c D"), (5, ""), (None, "q r s t u"),
    ]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.representatives(df.limit(0)).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """The plans of what simhash writes, by label, as they stand before they run."""
    found = {}

    def noted(df, label):
        found.setdefault(label, []).append(plan_of(df))
        return common.written(df, label)

    monkeypatch.setattr(simhash, "written", noted)
    return found


def test_what_becomes_many_rows_is_not_broadcast(spark, plans):
    """Spark takes the 64 variants of a fingerprint, or its 65 points, for one row."""
    fps = common.written(spark.createDataFrame([(n,) for n in clustered(1, 20)], "fp long"), "fps")
    simhash.links(fps)
    (plan,) = plans["simhash-shared"]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    for distance in (1, 2):
        plan = plan_of(simhash._meetings(fps, distance))
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


# Copies, and texts of which every shingle but one is that of the next text.
TEXTS = [(i, " ".join(f"v{j}" for j in range(i // 3, i // 3 + 200))) for i in range(60)] + [(100 + i, f"w{i} x{i} y{i} z{i}") for i in range(40)]


def slow_rows(rows):
    """(doc_id, fp, smallest doc_id linked to it) of each row."""
    prints = {d: slow_fingerprint(t) for d, t in rows}
    root, least = slow_components(set(prints.values()), 2), {}
    for d, p in sorted(prints.items()):
        least.setdefault(root[p], d)
    return {(d, signed(p), least[root[p]]) for d, p in prints.items()}


def test_representatives_of_many_rows_broadcast_a_map_only(spark, monkeypatch, plans):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    found = simhash.representatives(df)
    assert {"simhash-shared", "simhash-edges", "simhash-star", "simhash-groups", "simhash-firsts", "simhash-map"} <= {*plans}
    assert [label for label, own in plans.items() if "Broadcast" in "".join(own)] == []
    assert {r.doc_id for r in found.collect()} == {least for _, _, least in slow_rows(TEXTS)}


def test_near_duplicates_of_many_rows_broadcast_nothing(spark, monkeypatch, plans):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    found = simhash.near_duplicates(df)
    joins = plan_of(found)
    assert joins.count("SortMergeJoin") == 3 and "Broadcast" not in joins
    assert [label for label, own in plans.items() if "Broadcast" in "".join(own)] == []
    assert {tuple(r) for r in found.collect()} == slow_rows(TEXTS)


def test_query(spark, sf_dir):
    from snapsync.llm.queries import op2_simhash

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {d: slow_fingerprint(t) for d, t in texts.items()}
    root = slow_components(set(prints.values()), 2)
    least = {}
    for d, p in prints.items():
        least[root[p]] = min(d, least.get(root[p], d))
    expected = {(d, f"{p:016x}", least[root[p]]) for d, p in prints.items()}
    assert {tuple(r) for r in op2_simhash(spark, sf_dir).collect()} == expected
