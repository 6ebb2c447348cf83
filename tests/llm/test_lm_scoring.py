import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapsync.llm import lm_scoring as lm

END = b" end"


def part(doc):
    fold = zlib.crc32(str(doc).encode()) % 7 if doc is not None else 0
    return 0 if fold == 2 else 2 if fold == 5 else 1


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


def pairs(words):
    return [*zip([END, *words], words)]


def brute(rows):
    """Counts in dictionaries, weights by the same rounds on the same rounded estimates."""
    def counted(parts):
        own = [tokens(t) for d, t in rows if part(d) in parts]
        return Counter(w for o in own for w in o), Counter(p for o in own for p in pairs(o))

    def estimates(words, two, a, b, total):
        return (two[a, b] / max(words[a], 1), words[b] / max(total, 1), 1 / (len(words) + 1))

    def bucket(n):
        return int(math.log2(n)) + 1 if n else 0

    words, two = counted({1})
    cells = Counter()
    for d, t in rows:
        if part(d) == 2:
            for a, b in pairs(tokens(t)):
                p = estimates(words, two, a, b, sum(words.values()))
                steps = [int(np.rint(-np.log2(x) * lm.STEPS)) if x else -1 for x in p]
                cells[(bucket(words[a]), *steps)] += 1
    weights = lm.learnt(cells)
    words, two = counted({1, 2})
    n, v = sum(words.values()), len(words)
    out = []
    for d, t in rows:
        own = tokens(t)
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in own)
        score = sum(
            math.log10(np.dot(weights[bucket(words[a])], estimates(words, two, a, b, n)))
            for a, b in pairs(own)
        )
        out.append((d, part(d) == 0, len(own), sum(words[w] > 0 for w in own), n, base, score))
    return out


def same(got, expected):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got, expected = sorted(map(tuple, got), key=key), sorted(expected, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for g, e in zip(got, expected):
        assert g[5:] == pytest.approx(e[5:], rel=1e-7)


def test_query_against_dictionaries(spark, sf_dir, monkeypatch):
    from snapsync.llm.queries import op9_lm_scoring

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = op9_lm_scoring(spark, sf_dir).collect()
    same(got, expected)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    # Many batches and ranges give the same.
    monkeypatch.setattr(lm, "BATCH_BYTES", 60_000)
    same(lm.scored(docs).collect(), expected)


def test_nulls_repeats_long_and_clashing(spark):
    rows = [(i, t) for i in range(40) for t in (f"a b {i % 3}", "A  b c")]
    rows += [(None, "a b"), (None, None), (5, ""), (5, ""), (6, "é " * 30_000), (7, "w" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({"part": F.lit("x"), "batch": F.lit(1), "score": F.lit(2)})
    same(lm.scored(df).collect(), brute(rows))


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(d, "a b") for d in range(60) if part(d) == 0], "doc_id long, text string")
    assert lm.scored(df.limit(0)).count() == 0
    got = lm.scored(df).collect()
    assert len(got) == df.count() and {(r.train_tokens, r.n_known) for r in got} == {(0, 0)}
    assert all(math.isfinite(r.score) for r in got)


def test_packing():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5000):
        keys = np.unique(rng.integers(0, 2**64, n, np.uint64))
        assert (lm.unpacked_keys(lm.packed_keys(keys), len(keys)) == keys).all()
        counts = rng.integers(0, 2**40, n)
        assert (lm.unpacked_counts(lm.packed_counts(counts), n) == counts).all()


def test_three_words(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(None, ""), (None, "of the"), (2000, "of the of")]
    monkeypatch.setattr(lm, "BATCH_BYTES", 60_000)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm.scored(df, order=3).collect()

    def counted(parts):
        own = [[END, END, *tokens(t)] for d, t in rows if part(d) in parts]
        grams = [Counter(tuple(o[i - n : i + 1]) for o in own for i in range(2, len(o))) for n in (0, 1, 2)]
        seen = [Counter(tuple(o[i - n : i]) for o in own for i in range(2, len(o))) for n in (0, 1, 2)]
        return grams, seen

    def mixture(model, o, i):
        grams, seen = model
        p = [grams[n][tuple(o[i - n : i + 1])] / max(seen[n][tuple(o[i - n : i])], 1) for n in (2, 1, 0)]
        c2, c1 = seen[2][tuple(o[i - 2 : i])], seen[1][tuple(o[i - 1 : i])]
        state = lm.BUCKETS + int(math.log2(c2)) + 1 if c2 else int(math.log2(c1)) + 1 if c1 else 0
        return state, [*p, 1 / (len(grams[0]) + 1)]

    model, cells = counted({1}), Counter()
    for o in ([END, END, *tokens(t)] for d, t in rows if part(d) == 2):
        for i in range(2, len(o)):
            state, p = mixture(model, o, i)
            cells[(state, *(int(np.rint(-np.log2(x) * lm.STEPS)) if x else -1 for x in p))] += 1
    weights, model, want = lm.learnt(cells, 3), counted({1, 2}), []
    for o in ([END, END, *tokens(t)] for _, t in rows):
        mixed = (mixture(model, o, i) for i in range(2, len(o)))
        want.append(sum(math.log10(np.dot(weights[state], p)) for state, p in mixed))
    assert sorted(r.score for r in got) == pytest.approx(sorted(want), rel=1e-7)
