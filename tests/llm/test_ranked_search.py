import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from snapsync.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, top=50):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    of = {}
    for i, t in items:
        of.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in of.items():
        scored = []
        for d, c in counted:
            m = 50 + 50 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in own
                if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def ranked(docs, items, **options):
    return sorted((tuple(r) for r in rs.ranked(docs, items, **options).collect()), key=str)


DOCS = [
    (1, "alpha beta, BETA gamma"), (2, "betas alphabet"), (3, None), (4, ""), (5, "... \n"), (6, "Straße ÉCOLE école x1"),
    (7, "alpha beta, BETA gamma"), (7, "alpha beta, BETA gamma"), (None, "alpha"), (8, "alpha " * 30_000), (9, "a-b_c d"),
    (10, "beta\x00gamma\x7fdelta[alpha]"),
]
ITEMS = [(1, "Alpha beta?"), (2, "École STRASSE straße"), (3, None), (4, "!"), (5, "gamma"), (5, "delta gamma"), (None, "a b c d"), (6, "zzz")]


def frames(spark, docs=DOCS, items=ITEMS):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    d = d.withColumns({"n": F.lit(1), "item": F.lit(2), "terms": F.lit("x"), "score": F.lit(4)})
    return d, spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark):
    docs, items = frames(spark)
    assert ranked(docs, items) == brute(DOCS, ITEMS)


@pytest.mark.parametrize("top", [1, 3, 50])
@pytest.mark.parametrize("hits", [3, 1 << 20])
def test_top_and_ties(spark, monkeypatch, top, hits):
    # Two documents in three are copies: their scores are equal.
    docs = [(i, "common rare" if i % 3 else f"common word{i} rare rare") for i in range(200)]
    items = [(i, f"common rare word{3 * i}") for i in range(6)]
    monkeypatch.setattr(rs, "HITS", hits)
    monkeypatch.setattr(rs, "SHARES", 4)
    assert ranked(*frames(spark, docs, items), top=top) == brute(docs, items, top)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(rs, "BLOCK_ITEMS", 2)
    docs, items = frames(spark)
    assert len([*rs.blocks(items)]) > 2
    assert ranked(docs, items) == brute(DOCS, ITEMS)


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert ranked(docs.limit(0), items) == []
    assert ranked(docs, items.limit(0)) == []


def test_terms_meet_only_whole_words():
    counter = rs.Counter([b"ab", b"b", b"abc"])
    document, term, n = counter.count([b"ab b  b", b"", b"abc ab ab", b"xab"])
    assert [*zip(document.tolist(), term.tolist(), n.tolist())] == [(0, 0, 1), (0, 1, 2), (2, 0, 2), (2, 2, 1)]
    assert [rs.length(t) for t in (b"", b" ", b"a", b" a  bc ")] == [0, 0, 1, 2]
