"""WARC archives of web pages, with a two-level capture index.

Pages are written as WARC records, each a gzip member. Of records with equal payloads
the one with the largest page id is a response; the others are revisits without a
payload that refer to it. Pages are compared by SHA-1 and length; the page texts are not
shuffled as long as few payloads repeat.

The index has one line per record, sorted by key: the host in reverse order of its
labels, then the rest of the URL. A file of the index holds compressed blocks of lines
and, at its end, a sparse directory with the first key of each block. A lookup finds the
file by its first key, the block by binary search in the directory, the line by binary
search in the block; tasks then read the ranges of the archives that the lines name. URLs that
differ in the scheme, and all without one, share a key: the record's own URL decides.

Files are written through Spark's text writer, one value per file, so they land in any
store and only when their task commits; zero bytes after a gzip member are padding.
NULL html is an empty payload, a NULL URL has an empty key, a NULL page id is kept and
never the response of a group that has an id. Rows that share the largest id of a group
are all responses.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapsync.llm.common import slices, written
from snapsync.storage import Storage, workspace

ARCHIVE_BYTES = 48 << 20
BLOCK_LINES = 256
# Blocks of an index file, whatever the size of the table.
FILE_BLOCKS = 1024
# Archive bytes of a task, bytes of one read, and the gap that a read goes over.
TASK_BYTES, READ_BYTES, GAP_BYTES = 16 << 20, 4 << 20, 64 << 10
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"  # the tables have no date of capture
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TRAILER = struct.Struct("<8sQQ")  # magic, offset and length of the directory
MAGIC = b"CAPINDEX"


# Records -----------------------------------------------------------------


def _id(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _page(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, keeper: int | None, revisit: bool):
    """A WARC record of one page."""
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _id(page),
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
    }
    if url is not None:
        headers["WARC-Target-URI"] = re.sub(r"[\r\n%]", lambda m: f"%{ord(m[0]):02X}", url)
    if revisit:
        headers |= {"WARC-Refers-To": _id(keeper), "WARC-Profile": PROFILE}
    block = HTTP if revisit else HTTP + payload
    headers["Content-Length"] = str(len(block))
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return b"".join([b"WARC/1.1\r\n", head.encode(), b"\r\n", block, b"\r\n\r\n"])


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def target(headers: dict[str, str]) -> str | None:
    uri = headers.get("WARC-Target-URI")
    return None if uri is None else re.sub(r"%(0D|0A|25)", lambda m: chr(int(m[1], 16)), uri)


def member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def members(archive: memoryview, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member of an archive."""
    at, end = 0, len(archive)
    while at < end and archive[at]:
        inflate, start, out = zlib.decompressobj(31), at, []
        while not inflate.eof:
            piece = archive[at : at + step]
            if not len(piece):
                raise ValueError("an archive ends within a record")
            out.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield start, at - start, b"".join(out)


def surt(url: str | None) -> str:
    """Sort key of a URL: host labels in reverse order, then the rest."""
    after = (url or "").partition("://")[2]
    host = re.split(r"[/?#]", after, maxsplit=1)[0]
    rest = after[len(host) :]
    name, _, port = host.lower().partition(":")
    key = ",".join(reversed(name.split("."))) + (f":{port}" if port else "") + ")" + rest
    return re.sub(r"[\t\r\n]", lambda m: f"%{ord(m[0]):02X}", key) if after else ""


# Archives ----------------------------------------------------------------


def with_revisits(
    df: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
) -> DataFrame:
    """page_id, url, payload, keeper, revisit. Payloads below ``min_bytes`` never revisit."""
    pages = df.select(
        F.col(f"`{key}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"sha": F.unhex(F.sha1("payload")), "size": F.octet_length("payload")})
    # Only payloads that repeat are written and joined: this table has a known size.
    repeated = (
        pages.filter(F.col("size") >= min_bytes)
        .groupBy("sha", "size")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("sha", "size", "keeper")
    )
    joined = pages.join(written(repeated, "warc-repeated"), ["sha", "size"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return joined.select("page_id", "url", "payload", "keeper", revisit.alias("revisit"))


def write(pages: DataFrame) -> str:
    """Write what ``with_revisits`` returns as archives -> their folder."""

    def run(batches):
        task, made, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def whole():
            # The writer ends a value with a zero byte; a member mostly ends with one.
            data = b"".join(parts)
            data = data[:-1] if data.endswith(b"\0") else data
            name = f"p{task:06d}-{made:04d}"
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([data], pa.binary())], ["archive", "value"]
            )

        for batch in slices(batches, "payload"):
            columns = ("page_id", "url", "payload", "keeper", "revisit")
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                parts.append(member(record(*row)))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield whole()
                    made, parts, size = made + 1, [], 0
        if parts:
            yield whole()

    folder = workspace(pages.sparkSession, "warc")
    files = pages.mapInArrow(run, "archive string, value binary")
    files = files.withColumn("value", F.col("value").cast("string"))
    files.write.partitionBy("archive").option("lineSep", "\0").text(folder)
    return folder


def _files(spark: SparkSession, folder: str, part: str) -> DataFrame:
    """``part`` (the folder's name) and ``content`` of each file."""
    if not any("=" in name for name in Storage(spark, folder).child_names()):
        return spark.createDataFrame([], f"{part} string, content binary")
    found = spark.read.format("binaryFile").load(folder)
    return found.select(F.col(part).cast("string").alias(part), "content")


LINES = "key string, page_id long, archive string, offset long, length long"


def lines_of(spark: SparkSession, archives: str) -> DataFrame:
    """One index line per record of the archives."""

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("archive"), batch.column("content")):
                keys, ids, offsets, lengths = [], [], [], []
                for offset, length, data in members(memoryview(content.as_buffer())):
                    headers, _ = parsed(data)
                    keys.append(surt(target(headers)))
                    ids.append(_page(headers["WARC-Record-ID"]))
                    offsets.append(offset)
                    lengths.append(length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.string()),
                        pa.array(ids, pa.int64()),
                        pa.array([name.as_py()] * len(keys), pa.string()),
                        pa.array(offsets, pa.int64()),
                        pa.array(lengths, pa.int64()),
                    ],
                    ["key", "page_id", "archive", "offset", "length"],
                )

    return _files(spark, archives, "archive").mapInArrow(run, LINES)


# The index ---------------------------------------------------------------


def index_bytes(lines: list[tuple[str, str, int, int]]) -> bytes:
    """An index file from sorted (key, archive, offset, length)."""
    blocks, directory, offset = [], [], 0
    for i in range(0, len(lines), BLOCK_LINES):
        part = lines[i : i + BLOCK_LINES]
        data = zlib.compress("\n".join("\t".join(map(str, line)) for line in part).encode())
        directory.append(f"{part[0][0]}\t{offset}\t{len(data)}")
        blocks.append(data)
        offset += len(data)
    listed = zlib.compress("\n".join(directory).encode())
    return b"".join([*blocks, listed, TRAILER.pack(MAGIC, offset, len(listed))])


def directory_of(data: bytes) -> list[tuple[str, int, int]]:
    rows = (line.split("\t") for line in zlib.decompress(data).decode().split("\n"))
    return [(key, int(offset), int(length)) for key, offset, length in rows]


def block_lines(data: bytes) -> list[tuple[str, str, int, int]]:
    rows = (line.split("\t") for line in zlib.decompress(data).decode().split("\n"))
    return [(key, archive, int(offset), int(length)) for key, archive, offset, length in rows]


def search(firsts, directory, lines_at, key: str) -> list[tuple[str, str, int, int]]:
    """All lines of a key. ``lines_at(offset, length)`` has those of a block."""
    # Lines of the key may begin in the block before the first that begins with it.
    at = max(0, bisect.bisect_left(firsts, key) - 1)
    found = []
    while at < len(directory) and firsts[at] <= key:
        lines = lines_at(*directory[at][1:])
        keys = [line[0] for line in lines]
        found += lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
        at += 1
    return found


class IndexFile:
    """An index file that has been read."""

    def __init__(self, content: bytes):
        self.content = content[:-1]  # without the writer's newline
        magic, offset, length = TRAILER.unpack(self.content[-TRAILER.size :])
        if magic != MAGIC:
            raise ValueError("not an index file")
        self.directory = directory_of(self.content[offset : offset + length])
        self.firsts = [first for first, _, _ in self.directory]
        # Keys that are asked for in order meet a block many times.
        self.cached = lru_cache(2)(lambda *at: block_lines(self.block(*at)))

    def block(self, offset: int, length: int) -> bytes:
        return self.content[offset : offset + length]

    def find(self, key: str) -> list[tuple[str, str, int, int]]:
        return search(self.firsts, self.directory, self.cached, key)

    def lines(self) -> Iterator[tuple[str, str, int, int]]:
        for _, offset, length in self.directory:
            yield from block_lines(self.block(offset, length))


def write_index(lines: DataFrame) -> str:
    """Sort index lines into files of blocks -> their folder."""
    spark = lines.sparkSession
    lines = written(lines, "warc-lines")
    # Equal keys may fill several files: the place of the record tells any two lines apart.
    order = ["key", "page_id", "archive", "offset"]
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        task, made, rows, most = TaskContext.get().partitionId(), 0, [], FILE_BLOCKS * BLOCK_LINES

        def whole(lines):
            return pa.RecordBatch.from_arrays(
                [pa.array([f"i{task:06d}-{made:06d}"]), pa.array([index_bytes(lines)], pa.binary())],
                ["part", "value"],
            )

        for batch in batches:
            rows += zip(*(batch.column(c).to_pylist() for c in ("key", "archive", "offset", "length")))
            while len(rows) >= most:
                yield whole(rows[:most])
                made, rows = made + 1, rows[most:]
        if rows:
            yield whole(rows)

    folder = workspace(spark, "warc-index")
    files = ordered.mapInArrow(run, "part string, value binary")
    files.withColumn("value", F.col("value").cast("string")).write.partitionBy("part").text(folder)
    return folder


def entries(spark: SparkSession, index: str) -> DataFrame:
    """All index lines in the order of the index files: key, archive, offset, length."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = [*IndexFile(content.as_py()).lines()]
                keys, archives, offsets, lengths = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(archives), pa.array(offsets), pa.array(lengths)],
                    ["key", "archive", "offset", "length"],
                )

    return _files(spark, index, "part").select("content").mapInArrow(
        run, "key string, archive string, offset long, length long"
    )


def firsts(spark: SparkSession, index: str) -> list[tuple[str, str]]:
    """First key and name of each index file: one row per file."""

    def run(batches):
        for batch in batches:
            for part, content in zip(batch.column("part"), batch.column("content")):
                key = IndexFile(content.as_py()).directory[0][0]
                yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([part.as_py()])], ["key", "part"])

    rows = _files(spark, index, "part").mapInArrow(run, "key string, part string").collect()
    return sorted((r.key, r.part) for r in rows)


def lookup(spark: SparkSession, index: str, urls: DataFrame) -> DataFrame:
    """Index lines of the URLs of ``urls.url``: key, archive, offset, length.

    A key is sent to the index files whose range has it; each file is searched block by
    block. The first keys of the files are all that every executor gets.
    """
    listed = firsts(spark, index)
    sent = spark.sparkContext.broadcast(listed)

    def route(batches):
        names = [k for k, _ in sent.value]
        for batch in batches:
            keys, parts = [], []
            for url in batch.column("url").to_pylist():
                key = surt(url)
                low = max(0, bisect.bisect_left(names, key) - 1)
                for at in range(low, bisect.bisect_right(names, key)):
                    keys.append(key)
                    parts.append(sent.value[at][1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(parts, pa.string())], ["key", "part"]
            )

    empty = {"key": pa.string(), "archive": pa.string(), "offset": pa.int64(), "length": pa.int64()}

    def find(key, asked, file):
        rows = []
        if asked.num_rows and file.num_rows:
            own = IndexFile(file.column("content")[0].as_py())
            rows = [line for k in sorted(asked.column("key").to_pylist()) for line in own.find(k)]
        columns = [*zip(*rows)] or [[]] * 4
        return pa.table({n: pa.array(c, k) for (n, k), c in zip(empty.items(), columns)})

    routed = urls.select("url").distinct().mapInArrow(route, "key string, part string").distinct()
    files = _files(spark, index, "part")
    return (
        routed.groupBy("part")
        .cogroup(files.groupBy("part"))
        .applyInArrow(find, "key string, archive string, offset long, length long")
    )


RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long, payload binary"
)


def records(spark: SparkSession, archives: str, lines: DataFrame, payload: bool = True) -> DataFrame:
    """The records that index lines name, each read as a range of its archive.

    Lines travel to tasks of about ``TASK_BYTES`` of an archive, which read its ranges from
    the store; ranges that lie close together are one read. A store that Arrow cannot open is
    read by Spark, which brings the archives whole. The payload of a response is held against
    its digest. ``payload=False`` leaves the payload out of the result.
    """
    lines = lines.select("archive", "offset", "length")
    found = (_in_ranges if _opens(archives) else _in_archives)(spark, archives, lines, payload)
    return found if payload else found.drop("payload")


def _rows(found: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    columns = [*zip(*found)] or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for k, c in zip(kinds, columns)], names)


def _opens(folder: str) -> bool:
    """Whether Arrow has a file system for the folder's store."""
    try:
        fs.FileSystem.from_uri(_uri(folder))
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def _uri(path: str) -> str:
    # Hadoop writes local paths with one slash, or with none of the scheme.
    return re.sub(r"^(file:)?/+", "file:///", path)


def close_together(ranges: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Ranges, sorted by offset, in groups that one read takes."""
    group: list[tuple[int, int]] = []
    for offset, length in ranges:
        if group:
            end = group[-1][0] + group[-1][1]
            if offset - end > GAP_BYTES or offset + length - group[0][0] > READ_BYTES:
                yield group
                group = []
        group.append((offset, length))
    if group:
        yield group


def _in_ranges(spark: SparkSession, archives: str, lines: DataFrame, payload: bool) -> DataFrame:
    storage = Storage(spark, archives)
    if not any("=" in name for name in storage.child_names()):
        return spark.createDataFrame([], RECORDS)
    listed = spark.read.format("binaryFile").load(archives)
    paths = listed.select(F.col("archive").cast("string").alias("archive"), "path")
    # A given number of tasks is kept, though lines are few bytes beside what they name.
    n_tasks = storage.size() // TASK_BYTES + 1
    near = F.floor(F.col("offset") / TASK_BYTES)
    dealt = lines.join(paths, "archive").repartition(n_tasks, F.col("path"), near)

    def fetch(batches):
        for batch in batches:
            asked: dict[str, list[tuple[int, int]]] = {}
            for path, *place in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length"))):
                asked.setdefault(path, []).append(tuple(place))
            for path, ranges in asked.items():
                store, name = fs.FileSystem.from_uri(_uri(path))
                with store.open_input_file(name) as file:
                    for group in close_together(sorted(ranges)):
                        start = group[0][0]
                        data = memoryview(file.read_at(group[-1][0] + group[-1][1] - start, start))
                        yield _rows(
                            [
                                _row(*parsed(zlib.decompress(data[at - start : at - start + n], 31)), payload)
                                for at, n in group
                            ]
                        )

    dealt = dealt.sortWithinPartitions("path", "offset").select("path", "offset", "length")
    return dealt.mapInArrow(fetch, RECORDS)


def _in_archives(spark: SparkSession, archives: str, lines: DataFrame, payload: bool) -> DataFrame:
    def fetch(key, wanted, file):
        rows = []
        if wanted.num_rows and file.num_rows:
            content = memoryview(file.column("content")[0].as_buffer())
            for offset, length in zip(
                wanted.column("offset").to_pylist(), wanted.column("length").to_pylist()
            ):
                headers, body = parsed(zlib.decompress(content[offset : offset + length], 31))
                rows.append(_row(headers, body, payload))
        return pa.Table.from_batches([_rows(rows)])

    files = _files(spark, archives, "archive")
    return (
        lines.groupBy("archive").cogroup(files.groupBy("archive")).applyInArrow(fetch, RECORDS)
    )


def captures(
    spark: SparkSession, archives: str, index: str, urls: DataFrame, payload: bool = True
) -> DataFrame:
    """The records of the URLs of ``urls.url``, found by the index and by their own URL."""
    found = records(spark, archives, lookup(spark, index, urls), payload)
    asked = urls.select(F.col("url").alias("asked")).distinct()
    return found.join(asked, F.col("url").eqNullSafe(F.col("asked")), "left_semi")


def _row(headers: dict[str, str], body: bytes, payload: bool = True) -> tuple:
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = headers["WARC-Type"] == "revisit"
    if not revisit and digest_of(body) != digest:
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} has another digest")
    size = int(headers["X-Payload-Length"]) if revisit else len(body)
    refers = _page(headers["WARC-Refers-To"]) if revisit else None
    return (
        _page(headers["WARC-Record-ID"]), target(headers), size, digest, headers["WARC-Type"],
        refers, body if payload and not revisit else None,
    )


def read_url(spark: SparkSession, archives: str, index: str, url: str) -> list[tuple]:
    """The records of one URL, by range reads alone: trailer, directory, block, record."""
    key, found = surt(url), []
    names = Storage(spark, index).child_names()
    parts = [n for n in names if "=" in n]
    for part in parts:
        read, length = _ranges(spark, index, part)
        magic, offset, size = TRAILER.unpack(read(length - 1 - TRAILER.size, TRAILER.size))
        directory = directory_of(read(offset, size))
        if directory[0][0] > key:
            break
        names = [first for first, _, _ in directory]
        found += search(names, directory, lambda *at: block_lines(read(*at)), key)
    out = []
    for _, archive, offset, length in found:
        read, _ = _ranges(spark, archives, f"archive={archive}")
        headers, body = parsed(zlib.decompress(read(offset, length), 31))
        if target(headers) == url:
            out.append(_row(headers, body))
    return out


def _ranges(spark: SparkSession, folder: str, part: str):
    """A function that reads (offset, length) of the file of a part, and its length."""
    storage = Storage(spark, f"{folder}/{part}")
    status = storage.children()[0]
    jvm = spark._jvm
    path = status.getPath()

    def read(offset: int, length: int) -> bytes:
        stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
        try:
            stream.seek(offset)
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
        finally:
            stream.close()

    return read, status.getLen()
