"""WARC archives and a two-level capture index over them.

Archives are plain WARC 1.1 files, a response or revisit record per page, written by Spark's text sink with the record's
end as line separator. Of pages with equal payloads of at least `least` bytes the one with the largest id is a response and the
others revisit it; only digests are shuffled for that.

The index sorts captures by reversed-host URL key, cuts them into compressed blocks of BLOCK lines, and keeps a sparse
directory with the first and last key of each block. Blocks lie in parts (one per range of keys), at most PARTS of them, so
the list of parts has a bound. A lookup finds the parts of a key by binary search in that list, its blocks by
binary search in the part's directory, and its lines by binary search in the block; only blocks that are asked for are
unpacked. Records are then read by range: where they begin in their file, as many bytes as they have. Keys that
are asked for meet their part in groups of bounded size, a part that many ask for is copied.

Files are read through pyarrow's file systems (local, HDFS, S3, GCS), which read ranges.

Cases: a null payload is empty; a null URL has the key "-" and no target line; white space and control characters of a
URL are percent-encoded in the target line; a null id is written as such and comes back null, and is smaller than
any other; rows with the id of their group's response are responses too, so rows repeated as a whole are alike;
pages of one URL are captures of one key; an empty table makes an archive without records; of
further columns only the named ones are read, so they never clash.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, small, text_of

#: Lines of a block, captures of a part, most parts, keys asked of one copy of a part.
BLOCK, PART, PARTS, ASKED = 3000, 1_000_000, 1 << 16, 500_000
#: Bytes of an archive file, and of one read of neighbouring records.
FILE_BYTES, READ_BYTES = 16 << 20, 8 << 20
URN = "urn:docquill:page:"
_END = "\r\n\r\n"


def roles(pages: DataFrame, payload: str, key: str, least: int) -> DataFrame:
    """The page columns id, url and payload come with sha1 (hex), and top, the id that a page revisits or null."""
    rows = pages.withColumn("sha1", F.sha1(F.col(payload).cast("binary"))).withColumn(
        "digest", F.when(F.octet_length(payload) >= least, F.unhex(F.sha2(F.col(payload).cast("binary"), 256)))
    )
    groups = rows.where("digest is not null").groupBy("digest").agg(F.max(key).alias("top"), F.count("*").alias("n")).where("n > 1")
    groups = small(settled(groups.select("digest", "top"), "payloads"))
    again = F.when(~F.col(key).eqNullSafe(F.col("top")), F.col("top"))
    return rows.join(groups, "digest", "left").withColumn("top", again).drop("digest")


def encoded(url: Column) -> Column:
    """The URL with white space and control characters percent-encoded, as they would break a header line."""
    for c in (9, 10, 11, 12, 13, 32):
        url = F.replace(url, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    return F.regexp_replace(url, r"[\x00-\x1F\x7F]", "%00")


def records(url: str, payload: str, key: str, date: str) -> Column:
    """A WARC record without its end."""
    again = F.col("top").isNotNull()
    name = lambda c: F.concat(F.lit(f"<{URN}"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit(_END))
    block = F.when(again, http).otherwise(F.concat(http, payload))
    target = encoded(F.col(url))
    lines = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col(key))),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), name(F.col("top")))),
        F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(lines, F.lit(_END), block)


def write_archive(
    pages: DataFrame, folder: str, url: str = "url", payload: str = "html", key: str = "page_id", least: int = 1000, date: str = "1970-01-01T00:00:00Z"
) -> str:
    """A WARC record per page under the folder, in files of about FILE_BYTES."""
    rows = pages.select(F.col(key).alias("_id"), F.col(url).alias("_url"), text_of(payload).alias("_payload"))
    each = rows.agg(F.coalesce(F.avg(F.octet_length("_payload")), F.lit(0.0))).first()[0] + 500
    lines = roles(rows, "_payload", "_id", least).select(records("_url", "_payload", "_id", date).alias("value"))
    lines.write.option("lineSep", _END).option("maxRecordsPerFile", max(1, int(FILE_BYTES / each))).text(folder)
    return folder


def url_key(url: str | None) -> str:
    """The URL with its host reversed: com,example,www)/path?query."""
    if not url:
        return "-"
    scheme, found, rest = url.partition("://")
    rest = rest if found else scheme
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host, path = rest[:cut].rpartition("@")[2].lower(), rest[cut:].partition("#")[0]
    name, _, port = host.partition(":")
    return f"{','.join(reversed(name.split('.')))}{f':{port}' if port not in ('', '80', '443') else ''}){path if path.startswith('/') else '/' + path}"


def parse(raw: bytes, at: int) -> tuple[dict[str, str], int, int]:
    """Headers of the record that begins at a place, and its block's first byte and end."""
    if raw[at : at + 5] != b"WARC/":
        raise ValueError(f"no record at byte {at}")
    head = raw.index(b"\r\n\r\n", at)
    lines = raw[at:head].decode("utf-8", "replace").split("\r\n")[1:]
    headers = {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
    return headers, head + 4, head + 4 + int(headers["content-length"])


_LINE = "key string, date string, type string, id string, file string, offset long, length long"


def scan_archive(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record: key, date, type, id, file, offset, length (without the record's end)."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, raw in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                raw, at, out = raw.as_buffer().to_pybytes(), 0, []
                while at < len(raw):
                    headers, _, end = parse(raw, at)
                    out.append((url_key(headers.get("warc-target-uri")), headers.get("warc-date"), headers["warc-type"], headers["warc-record-id"], file, at, end - at))
                    at = end + len(_END)
                kinds = (*(pa.string(),) * 5, pa.int64(), pa.int64())
                columns = zip(*out, strict=True) if out else ((),) * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=_names(_LINE))

    return files.mapInArrow(run, _LINE)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


_BLOCKS = "part int, first string, last string, lines int, packed binary"


def build_index(captures: DataFrame) -> DataFrame:
    """The index's blocks, written; rows (part, first, last, lines, packed), keys in order from part to part."""
    captures = settled(captures, "captures")
    parts = min(PARTS, max(1, -(-captures.count() // PART)))
    ordered = captures.repartitionByRange(parts, "key", "date", "file", "offset").sortWithinPartitions("key", "date", "file", "offset")
    ordered = ordered.select(F.spark_partition_id().alias("part"), *captures.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[tuple] = []
        for batch in batches:
            left += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            whole = len(left) // BLOCK * BLOCK
            for a in range(0, whole, BLOCK):
                yield _block(left[a : a + BLOCK])
            left = left[whole:]
        if left:
            yield _block(left)

    return settled(ordered.mapInArrow(run, _BLOCKS), "index")


def _block(lines: list[tuple]) -> pa.RecordBatch:
    text = "\n".join("\t".join(str(x) for x in line[1:]) for line in lines)
    values = (lines[0][0], lines[0][1], lines[-1][1], len(lines), zlib.compress(text.encode()))
    kinds = (pa.int32(), pa.string(), pa.string(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=_names(_BLOCKS))


def _search(keys: list[str], blocks: list[tuple[str, str, bytes]]) -> Iterator[list[str]]:
    """The lines of each key, from blocks in order; keys in order, so a block is unpacked once."""
    firsts, lasts = [b[0] for b in blocks], [b[1] for b in blocks]
    held, lines, names = -1, [], []
    for key in sorted(keys):
        for i in range(bisect_left(lasts, key), bisect_right(firsts, key)):
            if i != held:
                held, lines = i, [x.split("\t") for x in zlib.decompress(blocks[i][2]).decode().split("\n")]
                names = [x[0] for x in lines]
            yield from lines[bisect_left(names, key) : bisect_right(names, key)]


def _find(asked: pa.Table, blocks: pa.Table) -> pa.Table:
    rows = sorted(zip(*(blocks.column(c).to_pylist() for c in ("first", "last", "packed")), strict=True), key=lambda b: b[:2])
    found = list(_search(asked.column("key").to_pylist(), rows)) if rows else []
    columns = list(zip(*found, strict=True)) if found else [()] * 7
    kinds = (*(pa.string(),) * 5, pa.int64(), pa.int64())
    return pa.table({n: pa.array([int(x) for x in c] if t == pa.int64() else c, t) for n, c, t in zip(_names(_LINE), columns, kinds, strict=True)})


def look_up(index: DataFrame, keys: DataFrame) -> DataFrame:
    """All captures of the keys (a column key); each once, however often its key is asked for."""
    # At most PARTS rows.
    top = index.groupBy("part").agg(F.min("first").alias("first"), F.max("last").alias("last")).orderBy("first", "last").collect()
    parts, firsts, lasts = [r.part for r in top], [r["first"] for r in top], [r["last"] for r in top]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("key").to_pylist()
            pairs = [(k, parts[i]) for k in asked for i in range(bisect_left(lasts, k), bisect_right(firsts, k))]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in pairs], pa.string()), pa.array([p for _, p in pairs], pa.int32())], names=["key", "part"])

    asked = settled(keys.select("key").where("key is not null").distinct().mapInArrow(run, "key string, part int"), "asked")
    copies = asked.groupBy(F.col("part").alias("p")).agg(F.ceil(F.count("*") / ASKED).cast("int").alias("copies"))
    copies = small(settled(copies, "copies"))
    asked = asked.join(copies, F.col("part") == F.col("p")).select("key", "part", F.pmod(F.xxhash64("key"), F.col("copies")).cast("int").alias("copy"))
    blocks = index.join(copies, F.col("part") == F.col("p")).select(
        F.col("part").alias("own"), "first", "last", "packed", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("turn")
    )
    return asked.groupBy("part", "copy").cogroup(blocks.groupBy("own", "turn")).applyInArrow(_find, _LINE)


def _file(uri: str) -> pa.NativeFile:
    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:/"):
        uri = "file:///" + uri[5:].lstrip("/")
    system, path = fs.FileSystem.from_uri(quote(uri, safe=":/%"))
    return system.open_input_file(path)


_RECORD = "key string, id string, type string, refers_to string, payload_bytes long, payload_digest string"


def read_records(captures: DataFrame, payload: bool = False) -> DataFrame:
    """The records of captures, by range reads: key, id, type, refers_to, payload_bytes, payload_digest; with payload also that.

    The digest of a response is that of the bytes read; it must be the one that its header has.
    """
    places = captures.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "key"))).alias("places"))
    schema = _RECORD + ", payload binary" * payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, places in zip(batch.column("file").to_pylist(), batch.column("places"), strict=True):
                with _file(file) as archive:
                    for run_ in _neighbours(places.as_py()):
                        yield _read(archive, run_, payload)

    return places.mapInArrow(run, schema)


def _neighbours(places: list[dict]) -> Iterator[list[dict]]:
    """Places in runs that lie close enough together for one read."""
    run: list[dict] = []
    for p in places:
        if run and (p["offset"] > run[-1]["offset"] + run[-1]["length"] + 4096 or p["offset"] + p["length"] - run[0]["offset"] > READ_BYTES):
            yield run
            run = []
        run.append(p)
    if run:
        yield run


def _read(archive: pa.NativeFile, places: list[dict], payload: bool) -> pa.RecordBatch:
    begin = places[0]["offset"]
    raw = archive.read_at(places[-1]["offset"] + places[-1]["length"] - begin, begin)
    out = []
    for p in places:
        headers, start, end = parse(raw, p["offset"] - begin)
        body = raw.index(b"\r\n\r\n", start) + 4
        http = dict(x.split(b": ", 1) for x in raw[start : body - 4].split(b"\r\n")[1:])
        digest, size = headers["warc-payload-digest"].removeprefix("sha1:"), int(http[b"Content-Length"])
        if headers["warc-type"] == "response" and (hashlib.sha1(raw[body:end]).hexdigest() != digest or end - body != size):
            raise ValueError(f"{headers['warc-record-id']} isn't what its header says")
        out.append((p["key"], headers["warc-record-id"], headers["warc-type"], headers.get("warc-refers-to"), size, digest, raw[body:end]))
    kinds = (*(pa.string(),) * 4, pa.int64(), pa.string(), pa.binary())
    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns[: 6 + payload], names=_names(_RECORD + ", payload binary" * payload))


def keys_of(urls: DataFrame, url: str = "url") -> DataFrame:
    """A column key of the URLs' keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(map(url_key, batch.column("url").to_pylist()), pa.string())], names=["key"])

    return urls.select(encoded(F.col(url)).alias("url")).mapInArrow(run, "key string")


def page_of(name: str) -> Column:
    """The page id in a record id; null where the page had none."""
    return F.regexp_extract(name, f"^<{URN}(-?[0-9]+)>$", 1).try_cast("long")
