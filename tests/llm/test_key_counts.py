import numpy as np
import pytest

from snapsync.llm import key_counts as kc


def batches(seed, n, keys=400):
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 2**64, 300, np.uint64)
    found = []
    for b in range(n):
        own = np.unique(np.r_[rng.choice(pool, keys // 2), rng.integers(0, 2**64, keys // 2, np.uint64)])
        if b == 1:
            own = own[:0]
        found.append((own, rng.integers(0, 9, len(own)), rng.integers(0, 3, len(own)), bool(b % 2)))
    return found


def packs_of(spark, made):
    return spark.createDataFrame([(7_000_000_000 + b, b.to_bytes(4, "big")) for b in range(len(made))], "batch long, blob binary")


def asker(made):
    def ask(blob):
        keys, c0, c1, both = made[int.from_bytes(blob, "big")]
        yield 1, keys, c0, c1, both
        # Another kind with the same keys.
        yield 2, keys, c1, c1, both

    return ask


@pytest.mark.parametrize("fan,n", [(128, 9), (3, 9), (3, 14), (2, 9), (128, 1)])
def test_every_batch_gets_the_sums_of_its_keys(spark, monkeypatch, fan, n):
    monkeypatch.setattr(kc, "FAN", fan)
    made = batches(fan, n)
    answers, sums = kc.counted(packs_of(spark, made), asker(made), "test")
    total = [{}, {}]
    for keys, c0, c1, _ in made:
        for t, c in zip(total, (c0, c1)):
            for k, v in zip(keys.tolist(), c.tolist()):
                t[k] = t.get(k, 0) + v
    replies = answers.collect()
    for b, (keys, _, _, both) in enumerate(made):
        for kind in (1, 2):
            own = sorted((r for r in replies if r.sender == 7_000_000_000 + b and r.kind == kind), key=lambda r: r.span)
            got = [v for r in own for v in kc.unpacked_counts(bytes(r.c0), r.n).tolist()]
            assert got == [total[kind - 1][k] for k in keys.tolist()]
            assert all((r.c1 is not None) == both for r in own)
            if both:
                got = [v for r in own for v in kc.unpacked_counts(bytes(r.c1), r.n).tolist()]
                assert got == [total[1][k] for k in keys.tolist()]
    first = next(r for r in sums.collect() if r.kind == 1)
    a, b = (np.array([t[k] for k in total[0]]) for t in total)
    assert tuple(first)[1:] == (a.sum(), b.sum(), (a > 0).sum(), (a > b).sum())


def test_hops():
    assert kc.hops_for(1) == (1, 1) and kc.hops_for(128) == (1, 128)
    assert kc.hops_for(129) == (2, 12) and kc.hops_for(16_384) == (2, 128)
    for n in (1, 2, 5, 127, 200, 5000, 16_385, 8_000_000):
        hops, fan = kc.hops_for(n)
        assert fan**hops >= n and fan <= kc.FAN and (hops == 1 or kc.FAN ** (hops - 1) < n)


def test_messages_grow_with_the_batches(spark, monkeypatch):
    """Twice the batches make about twice the messages, not four times as many."""
    monkeypatch.setattr(kc, "FAN", 4)
    sent = []
    keep = kc.written

    def counted(df, label):
        out = keep(df, label)
        if label.endswith("asked") or label.endswith("answers"):
            sent.append(out.count())
        return out

    monkeypatch.setattr(kc, "written", counted)
    totals = []
    for n in (14, 28, 56):
        sent.clear()
        made = batches(5, n, 100)
        answers, _ = kc.counted(packs_of(spark, made), asker(made), "test")
        assert answers.count()
        totals.append(sum(sent) / n)
        # Each batch sends FAN messages a kind and hop at most, and is answered as often.
        hops, fan = kc.hops_for(n)
        assert sum(sent) <= 2 * 2 * hops * fan * n * 1.3 + fan**hops * 2
    assert totals[2] < 1.8 * totals[0]


def test_edges_of_ranges():
    keys = np.array([0, 1, 2**62, 2**63 - 1, 2**63, 2**64 - 1], np.uint64)
    for parts, fan in ((1, 1), (1, 2), (2, 2), (1, 7), (3, 5)):
        for span in range(parts):
            own = keys[[k * parts >> 64 == span for k in keys.tolist()]]
            for s, a, b in kc._split(own, span, parts, fan):
                assert all(k * parts * fan >> 64 == s for k in own[a:b].tolist())
