import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapsync.llm import token_files as tf
from snapsync.storage import Storage

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(rows, library, end=2):
    out, start = [], 0
    coded = [(d, [*library.encode(t or "", add_special_tokens=False).ids, end]) for d, t in rows]
    for d, ids in sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes())):
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_words_are_encoded_as_in_their_text(library):
    coded = tf.Encoder(PATH)
    assert coded.by_words
    texts = [f"a{chr(c)} {chr(c)}b\n{chr(c)}\u0301" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += ["", " ", "Don't<|endoftext|>x <|startoftext|>", "E\u0301 \u0301x\x0b\x0cA", "İI ΑΣ ΑΣ,"]
    ids, ends = coded.encode([t.encode() for t in texts])
    for text, a, b, e in zip(texts, ends, ends[1:], library.encode_batch(texts, add_special_tokens=False)):
        assert ids[a:b].tolist() == e.ids, ascii(text)


def test_words_that_are_met_often_are_kept(library, monkeypatch):
    """What a task forgets changes no ids, and words of every batch are encoded once."""
    monkeypatch.setattr(tf, "CACHE_WORDS", 50)
    coded, learnt = tf.Encoder(PATH), []
    learn = coded._learn
    monkeypatch.setattr(coded, "_learn", lambda new: learnt.extend(new) or learn(new))
    for n in range(30):
        texts = [f"the House, of x{'y' * 30} {n}", *(f"w{n}q{i} of{i}! " * 2 for i in range(12))]
        ids, ends = coded.encode([t.encode() for t in texts])
        for a, b, e in zip(ends, ends[1:], library.encode_batch(texts, add_special_tokens=False)):
            assert ids[a:b].tolist() == e.ids
        assert len(coded.starts) == coded.words.size + 1 and coded.words.size < 80
    assert [learnt.count(w) for w in (b"the", b"house,", b"of3!")] == [1, 1, 1]
    assert learnt.count(b"w0q1") == 1 and coded.words.thin(3).sum() <= 3


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = tf.Encoder(path)
    assert not coded.by_words
    ids, _ = coded.encode([b"two  words", b"", b"two  words"])
    assert ids.tolist() == Tokenizer.from_file(path).encode("two  words").ids * 2


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash(n):
    hashes = tf.key_hashes(np.arange(n) * 7 - 5, np.zeros(n, bool), np.zeros(n, np.int64), 0)
    levels = tf.build_levels(hashes)
    perfect = tf.PerfectHash(levels)
    assert sorted(perfect.slots(hashes)) == [*range(n)]
    content = tf.shard_bytes(np.arange(n) * 7 - 5, np.zeros(n, bool), [b"\1\0" * (i % 3) for i in range(n)], 2)
    shard = tf.Shard(content + b"\n")
    absent, _, _ = shard.find(np.arange(n) * 7 - 4, np.zeros(n, bool), np.zeros(n, np.int64))
    assert not absent.any()


def test_equal_hashes_are_seen():
    assert tf.build_levels(np.array([5, 5, 6], np.uint64)) is None


def test_round_trip_with_nulls_repeats_and_extra_columns(spark, monkeypatch, library):
    rows = [(3, "to be"), (3, "to be"), (3, "or"), (None, "x"), (None, None), (-8, ""), (2**40, "long " * 40_000)]
    rows += [(i, f"text {i}") for i in range(100, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({"ids": F.lit("z"), "shard": F.lit(1), "value": F.lit(2)})
    for size in (tf.SHARD_BYTES, 20_000):
        monkeypatch.setattr(tf, "SHARD_BYTES", size)
        folder = tf.write(df, PATH, 2)
        got = sorted(map(tuple, tf.read(spark, folder).collect()), key=lambda r: r[1])
        assert got == expected(rows, library)
    assert tf.manifest(spark, folder).count() > 3
    keys = spark.createDataFrame([(3,), (100,), (399,), (5,), (-8,), (None,), (2**50,), (100,)], "doc_id long")
    found = {r.doc_id: r.ids for r in tf.lookup(spark, folder, keys).collect()}
    text = {100: "text 100", 399: "text 399", -8: ""}
    assert found.keys() == {3, *text}
    for d, t in text.items():
        assert found[d] == [*library.encode(t).ids, 2]


def test_files_begin_with_raw_ids(spark, library):
    df = spark.createDataFrame([(1, "to be"), (2, "or not")], "doc_id long, text string")
    folder = tf.write(df, PATH, 2)
    content = spark.read.format("binaryFile").load(folder).first().content
    ids = [*library.encode("to be").ids, 2, *library.encode("or not").ids, 2]
    assert np.frombuffer(bytes(content), "<u2", len(ids)).tolist() == ids
    assert any("=" in n for n in Storage(spark, folder).child_names())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    folder = tf.write(df, PATH, 2)
    assert tf.read(spark, folder).count() == 0
    assert tf.lookup(spark, folder, df).count() == 0


def test_query(spark, sf_dir, library):
    from snapsync.llm.queries import op6_token_files

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(map(tuple, op6_token_files(spark, sf_dir).collect()), key=lambda r: r[1])
    assert got == expected(rows, library)


def test_one_id_fills_several_bounded_shards(spark, monkeypatch, library):
    rows = [(None, f"null {i % 90} " * 30) for i in range(300)] + [(7, f"seven {i} " * 30) for i in range(300)]
    rows += [(8, "alike " * 40)] * 300 + [(i, "x") for i in range(9, 60)] + [(-(1 << 63), "least")]
    # Long documents next to each other.
    rows += [(i, f"run {i} " * 900) for i in range(60, 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(tf, "SHARD_BYTES", 20_000)
    folder = tf.write(df, PATH, 2)
    got = sorted(map(tuple, tf.read(spark, folder).collect()), key=lambda r: r[1])
    assert got == expected(rows, library)
    shards = tf.manifest(spark, folder).orderBy("shard").collect()
    assert all(s.docs == 1 or 2 * s.tokens + tf.DOC_BYTES * s.docs <= 20_000 for s in shards)
    tasks = {d: {s.shard // tf.PIECES for s in shards if s["first"] == s["last"] == d} for d in (None, 7, 8)}
    assert all(len(t) > 2 for t in tasks.values())
    ids, at = [r[0] for r in got], 0
    for s in shards:
        assert ids[at] == s["first"] and s.ordinal == ids[:at].count(ids[at])
        at += s.docs
    keys = spark.createDataFrame([(7,), (8,), (59,), (-(1 << 63),)], "doc_id long")
    found = {r.doc_id: r.ids for r in tf.lookup(spark, folder, keys).collect()}
    first = min(([*library.encode(t).ids, 2] for d, t in rows if d == 7), key=lambda i: np.array(i, "<u2").tobytes())
    assert found[7] == first
    assert found.keys() == {7, 8, 59, -(1 << 63)}


def test_points_of_the_driver_are_bounded(spark, monkeypatch, library):
    rows = [(i % 700, f"text {i} " * 20) for i in range(2000)] + [(None, f"null {i} " * 20) for i in range(1000)]
    rows += [(5, f"five {i} " * 20) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(tf, "SHARD_BYTES", 4_000)
    many = tf._thinned(tf._sampled(df, 100), 1 << 30)
    few = tf._thinned(tf._sampled(df, 100), 300)
    assert 200 < len(few) < 400 < len(many)
    share = few.column("doc_id").null_count / len(few)
    assert abs(share - many.column("doc_id").null_count / len(many)) < 0.05
    counts = []
    for most, hot in ((1 << 23, 1 << 14), (tf.POINTS * 10, 40)):
        monkeypatch.setattr(tf, "MOST_POINTS", most)
        monkeypatch.setattr(tf, "MOST_HOT_POINTS", hot)
        folder = tf.write(df, PATH, 2)
        got = sorted(map(tuple, tf.read(spark, folder).collect()), key=lambda r: r[1])
        assert got == expected(rows, library)
        shards = tf.manifest(spark, folder).collect()
        assert all(s.docs == 1 or 2 * s.tokens + tf.DOC_BYTES * s.docs <= 4_000 for s in shards)
        counts.append(len({s.shard // tf.PIECES for s in shards}))
    # Fewer and larger shares, of shards as large as before.
    assert counts[1] <= 11 < counts[0]
