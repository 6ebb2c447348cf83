from collections import Counter

import pytest
from snapsync.llm import quality_rules as q

SPACES = " \t\n\x0b\x0c\r"


def slow_measures(text):
    words = (text or "").encode().split()
    lines = [line for line in (text or "").split("\n") if line.strip(SPACES)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    covered = {p for i, w in enumerate(windows) if n[w] > 1 for p in range(i, i + 8)}
    return (
        len(words), len(b"".join(words).decode()), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines), len(lines) - len(set(lines)), len(covered),
    )


TEXTS = [
    None, "", " \n\t", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 40, "é|ö <&> \x0b z\x0cq",
    "a b c d e f g h i j k l a b c d e f g h m n o", "same line\nsame line\n\nother\nsame line",
    " wide space \x1c x", "w " * 7 + "w", "word " * 30_000, "\r\nx\r\nx",
    " ".join(map(str, range(20_000))) + " 5 6 7 8 9 10 11 12 13",
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, measures string, n int"
    )
    return df


def test_measures(rows):
    got = {r.doc_id: tuple(r.measures) for r in q.measures(rows).collect()}
    assert got == {i: slow_measures(t) for i, t in enumerate(TEXTS)}


def test_ledger_policies_and_ablations(rows):
    ledger = q.ledger(rows.unionByName(rows)).cache()
    assert ledger.columns == ["doc_id", "text", "n", "measures", "failed_bits"]
    for policy in q.POLICIES.values():
        bits = [r.failed_bits & policy.mask for r in ledger.collect()]
        assert q.apply_policy(ledger, policy).count() == bits.count(0)
        got = {r.rule: tuple(r)[1:] for r in q.ablations(ledger, policy).collect()}
        for rule in policy.rules:
            one = q.BITS[rule]
            failed, alone = sum(b & one > 0 for b in bits), bits.count(one)
            assert got[rule] == (failed, alone, bits.count(0) + alone, len(bits))


def test_empty_table(rows):
    assert q.ledger(rows.limit(0)).count() == 0
    assert q.ablations(q.ledger(rows.limit(0))).count() == 0


def test_no_python_in_the_plan(rows):
    plan = q.apply_policy(q.ledger(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
