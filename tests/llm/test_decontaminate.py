import hashlib
import re

from pyspark.sql import functions as F

from snapsync.llm import decontaminate as dc

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    words = {i: WORDS.findall(lower(t)) for i, t in items}
    windows = {}
    for item, own in words.items():
        for k in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(tuple(own[k : k + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        own, hit, found = WORDS.findall(lower(text)), set(), set()
        for n in sizes:
            for k in range(len(own) - n + 1):
                if who := windows.get(tuple(own[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= who
        out.append((doc, len(own), len(hit), sorted(map(str, found)), bool(hit)))
    return out


PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ITEMS = [(1, PASSAGE), (2, "Short item"), (2, "Short item"), (3, None), (4, " .!"), (10, "short"), (5, PASSAGE)]
DOCS = [
    (1, f"x {PASSAGE.upper()} y"), (2, PASSAGE.replace(" ", "-\n")), (3, "alpha beta gamma"), (4, None), (5, ""),
    (6, "a SHORT, item. shorts"), (6, "a SHORT, item. shorts"), (7, "éalpha shortß short"), (8, "no " * 30_000 + PASSAGE),
    (None, "short"), (9, " ".join([PASSAGE] * 3)), (11, "alpha " + PASSAGE),
]


def frames(spark, docs=DOCS, items=ITEMS):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    return d.withColumns({"spans": F.lit(5), "items": F.lit("z")}), spark.createDataFrame(
        items, "item_id long, text string"
    )


def test_against_brute_force(spark):
    docs, items = frames(spark)
    got = sorted((tuple(r) for r in dc.contamination(docs, items).collect()), key=str)
    assert got == sorted(brute(DOCS, ITEMS), key=str)
    kept = dc.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(kept.toPandas()["doc_id"]) == [3, 4, 5]


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 40)
    docs, items = frames(spark)
    got = sorted((tuple(r) for r in dc.contamination(docs, items).collect()), key=str)
    assert got == sorted(brute(DOCS, ITEMS), key=str)


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert dc.contamination(docs.limit(0), items).count() == 0
    assert dc.contamination(docs, items.limit(0)).filter("n_hit > 0").count() == 0


def test_spans_in_the_original(spark):
    text = "Ünd, SHORT --item! x"
    scanner = dc.Scanner([("2", b"short item")])
    hits = [(a, b) for a, b, _ in scanner.scan(dc.words_of(text.encode()))]
    assert [text[a:b] for a, b in dc.character_spans(text, hits)] == ["SHORT --item"]


def test_query(spark, sf_dir):
    from snapsync.llm.queries import op7_decontamination

    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").collect() for t in ("documents", "benchmark")}
    expected = brute(
        [(r.doc_id, r.text) for r in read["documents"]], [(r.item_id, r.text) for r in read["benchmark"]]
    )
    got = {tuple(r) for r in op7_decontamination(spark, sf_dir).collect()}
    assert got == {
        (d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), c) for d, n, h, i, c in expected
    }


def test_one_scan_of_a_large_benchmark(spark):
    """20 MB of items are one automaton: one Python stage over one scan, and no exchange."""
    docs, _ = frames(spark)
    items = spark.range(4000).select(
        F.col("id").alias("item_id"),
        F.expr("concat_ws(' ', transform(sequence(1, 600), i -> concat('w', hex(xxhash64(id, i) % 100000000))))").alias("text"),
    )
    assert items.agg(F.sum(F.octet_length("text"))).first()[0] < dc.BLOCK_BYTES
    few = items.limit(3)
    for found in (dc.clean(docs, few), dc.contamination(docs, few)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
    assert len([*dc.blocks(items)]) == 1


def test_shared_sentences_are_named_once(spark):
    """300 items with one sentence, and a text that repeats it: 300 ids, not one list for each."""
    sentence = "please read the passage and give the best of four answers"
    items = [(i, f"{sentence} item{i} alone") for i in range(300)]
    docs, benchmark = frames(spark, [(1, f"{sentence}. " * 200)], items)
    (row,) = dc.spans(docs, benchmark, column="SPANS").collect()
    assert len(row.SPANS["items"]) == 300 and len(row.SPANS.ranges) == 1
    assert row.SPANS.n_words == 200 * 11 and "spans" not in row.asDict()


def test_spans_keep_other_columns(spark):
    docs, items = frames(spark)
    docs = docs.withColumns({"row": F.lit(1), "found": F.lit("f"), "__spans": F.lit(2.5), "n_words": F.lit(3)})
    kept = dc.clean(docs, items)
    assert kept.schema == docs.schema and kept.count() == 3
    found = dc.spans(docs, items)
    assert set(found.columns) == {*docs.columns} and found.filter("found = 'f' AND row = 1").count() == docs.count()


def test_every_window_has_a_chunk():
    import random

    rng = random.Random(2)
    for trial in range(200):
        own = [rng.choice("abc") for _ in range(rng.randrange(0, 26))]
        doc = [rng.choice("abc") for _ in range(rng.randrange(0, 60))] + own[rng.randrange(0, 9) :] + ["c"]
        items = [(7, " ".join(own)), (8, " ".join(own[3:15]))]
        want = brute([(1, " ".join(doc))], items)[0]
        scanner = dc.Scanner([(str(i), t.encode()) for i, t in items])
        starts, ends, numbers = scanner.found(dc.words_of(" ".join(doc).encode()))
        hit = {k for a, b in zip(starts, ends) for k in range(a, b)}
        assert (len(hit), sorted(scanner.items_of(numbers))) == (want[2], want[3])
