import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from snapsync.llm import warc

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (1, "http://www.a.org/x?y#z", "same"), (2, "https://b.com/", "same"), (9, "http://a.org/", "same"),
    (3, None, None), (4, "", ""), (5, "no scheme", "é\U0001f600\r\n\r\nWARC/1.1\r\n"), (6, "http://a.org/", "other"),
    (6, "http://a.org/", "other"), (None, "http://n.org/\r\nX: y\t%0A", "null id"), (None, "x", "same"),
    (None, "u://p", "twice"), (None, "u://q", "twice"), (7, "http://long.org/", "z" * 3_000_000), (8, "http://A.org:80/", "\0"),
]


def expected(rows):
    groups = {}
    for page, _, html in rows:
        groups.setdefault(html or "", []).append(page)
    out = []
    for page, url, html in rows:
        data = (html or "").encode()
        ids = [p for p in groups[html or ""] if p is not None]
        revisit = bool(ids) and len(groups[html or ""]) > 1 and page != max(ids)
        out.append(
            (page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
             "revisit" if revisit else "response", max(ids) if revisit else None)
        )
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def written(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    df = df.withColumns({"sha": F.lit(1), "keeper": F.lit("k"), "archive": F.lit("a")})
    archives = warc.write(warc.with_revisits(df))
    return archives, warc.write_index(warc.lines_of(spark, archives))


def test_round_trip(spark, written):
    archives, index = written
    found = warc.records(spark, archives, warc.entries(spark, index)).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=str) == expected(ROWS)
    html = {r[0]: r[2] for r in ROWS if r[0] is not None}
    for r in found:
        if r.page_id is not None:
            assert r.url == next(u for p, u, _ in ROWS if p == r.page_id)
            if r.record_type == "response":
                assert bytes(r.payload).decode() == (html[r.page_id] or "")


def test_archives_are_plain_gzip(spark, written):
    for row in spark.read.format("binaryFile").load(written[0]).collect():
        records = gzip.decompress(bytes(row.content)).split(b"\r\n\r\nWARC/1.1\r\n")
        assert records[0].startswith(b"WARC/1.1\r\n")


def test_index_is_sorted_and_searched(spark, written):
    archives, index = written
    keys = [r.key for r in warc.entries(spark, index).collect()]
    assert sorted(keys) == sorted(warc.surt(u) for _, u, _ in ROWS)
    asked = ["http://a.org/", "http://nowhere.org/", None, "https://b.com/", "http://a.org/"]
    urls = spark.createDataFrame([(u,) for u in asked], "url string")
    lines = warc.lookup(spark, index, urls)
    found = warc.records(spark, archives, lines)
    wanted = {warc.surt(u) for u in asked}
    expect = [str(p) for p, u, _ in ROWS if warc.surt(u) in wanted]
    assert sorted(str(r.page_id) for r in found.collect()) == sorted(expect)
    for url in asked[:2] + asked[3:4]:
        pages = sorted(r[0] for r in warc.read_url(spark, archives, index, url))
        assert pages == sorted(p for p, u, _ in ROWS if u == url)


def test_equal_keys_in_many_blocks(monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    lines = [("a", "x", i, 1) for i in range(3)] + [("b", "x", i, 2) for i in range(30)] + [("c", "x", 0, 3)]
    file = warc.IndexFile(warc.index_bytes(lines) + b"\n")
    assert len(file.directory) == 9 and [*file.lines()] == lines
    assert [len(file.find(k)) for k in ("", "a", "b", "bb", "c", "d")] == [0, 3, 30, 0, 1, 0]


def test_surt():
    assert warc.surt("http://www.Example.org:8/p?q") == "org,example,www:8)/p?q"
    assert warc.surt(None) == warc.surt("x") == ""


def test_small_payloads_and_empty_table(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert warc.with_revisits(df, min_bytes=10**7).filter("revisit").count() == 0
    none = df.limit(0)
    archives = warc.write(warc.with_revisits(none))
    index = warc.write_index(warc.lines_of(spark, archives))
    assert warc.records(spark, archives, warc.entries(spark, index)).count() == 0
    assert warc.lookup(spark, index, none).count() == 0


def test_query(spark, sf_dir):
    from snapsync.llm.queries import op10_warc

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    got = op10_warc(spark, sf_dir).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_records_are_those_of_the_url_alone(spark, written):
    archives, index = written
    for asked in ([None], [""], ["no scheme", "http://b.com/"], ["x", "http://a.org/", "http://a.org/"]):
        urls = spark.createDataFrame([(u,) for u in asked], "url string")
        found = warc.captures(spark, archives, index, urls).collect()
        assert sorted(str(r.page_id) for r in found) == sorted(str(p) for p, u, _ in ROWS if u in asked)
    assert [r[0] for r in warc.read_url(spark, archives, index, "no scheme")] == [5]


def test_query_goes_by_the_search(spark, sf_dir, monkeypatch):
    from snapsync.llm.queries import op10_warc

    monkeypatch.setattr(warc, "lookup", lambda spark, index, urls: warc.entries(spark, index).limit(7))
    assert op10_warc(spark, sf_dir).count() == 7


def test_lines_with_one_key_and_no_page_fill_several_files(spark):
    df = spark.range(20_000).select(
        F.lit("").alias("key"), F.lit(None).cast("long").alias("page_id"), F.lit("a").alias("archive"),
        F.col("id").alias("offset"), F.lit(1).cast("long").alias("length"),
    )
    kept = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(kept, "false")
    try:
        index = warc.write_index(df)
    finally:
        spark.conf.unset(kept)
    assert len(warc.firsts(spark, index)) > 4
    lines = warc.lookup(spark, index, spark.createDataFrame([(None,)], "url string"))
    assert sorted(r.offset for r in lines.collect()) == [*range(20_000)]


def test_ranges_of_archives_without_their_contents(spark, written, monkeypatch):
    archives, index = written
    found = warc.records(spark, archives, warc.entries(spark, index))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" not in plan
    rows = sorted(map(str, found.collect()))
    # A store that Arrow does not open; then many tasks.
    monkeypatch.setattr(warc, "_opens", lambda folder: False)
    assert sorted(map(str, warc.records(spark, archives, warc.entries(spark, index)).collect())) == rows
    monkeypatch.undo()
    monkeypatch.setattr(warc, "TASK_BYTES", 512)
    assert sorted(map(str, warc.records(spark, archives, warc.entries(spark, index)).collect())) == rows


def test_reads_of_close_ranges(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 100)
    monkeypatch.setattr(warc, "GAP_BYTES", 5)
    ranges = [(0, 10), (10, 10), (25, 10), (41, 50), (91, 40), (131, 300), (431, 1)]
    groups = [*warc.close_together(ranges)]
    assert [len(g) for g in groups] == [3, 2, 1, 1] and [r for g in groups for r in g] == ranges
    assert [*warc.close_together([])] == []


def test_stores():
    assert warc._uri("file:/a/b") == warc._uri("/a/b") == warc._uri("file:///a/b") == "file:///a/b"
    assert warc._uri("viewfs://in/x") == "viewfs://in/x"
    assert warc._opens("/tmp") and not warc._opens("viewfs://in/x")


def test_index_files_are_closed_every_so_many_blocks(spark, written, monkeypatch):
    archives, index = written
    monkeypatch.setattr(warc, "BLOCK_LINES", 1)
    monkeypatch.setattr(warc, "FILE_BLOCKS", 1)
    index = warc.write_index(warc.lines_of(spark, archives).coalesce(1))
    assert len(warc.firsts(spark, index)) == len(ROWS)
    for page, url in ((6, "http://a.org/"), (5, "no scheme")):
        assert page in [r[0] for r in warc.read_url(spark, archives, index, url)]
    urls = spark.createDataFrame([(u,) for _, u, _ in ROWS], "url string")
    found = warc.captures(spark, archives, index, urls)
    assert sorted(str(r.page_id) for r in found.collect()) == sorted(str(r[0]) for r in ROWS)
