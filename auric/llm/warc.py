"""Dictionary-compressed WARC writer and reader.

Every archive is a sequence of Zstandard frames: first a skippable frame (magic
0x184D2A5D) that holds a dictionary built from the archive's own records, then one
frame for each WARC record, compressed by itself with that dictionary. A record
can be read with the dictionary and its own bytes alone.

Records with equal payloads (of ``min_bytes`` bytes or more) are stored once: the
one with the largest page id is a response, the others are revisits that name it.
Which one that is comes from one aggregate over payload digests (combined before
the shuffle, so a payload may belong to any share of the pages); only groups of two
or more are joined back, and a hot group's join can be split.

Each task writes archives of about ``archive_bytes`` of records to the shared
folder, under a name of its own, and returns a manifest row for each. Only files
in the manifest are read, so what a lost or repeated task leaves behind does no harm.

Defined results: a null payload is empty; of equal payloads without any page id
all are responses, as are repeated rows that share the largest page id (they refer
to none); a null page id is written as an absent header and read back as null; a
null url is written as ``urn:page:<id>``; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.llm.tables import materialize, table
from auric.session import scratch_path

MAGIC = 0x184D2A5D
ARCHIVE_BYTES = 32 << 20
DICT_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20
LEVEL = 3
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 16


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'urn:page:{page_id}')}>"


def _header(lines: list[tuple[str, object]]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in lines if v is not None)


def record(page_id, url: str | None, payload: bytes, refers_to, date: str = DATE) -> bytes:
    """One WARC record: a response, or a revisit if ``refers_to`` is given."""
    revisit = refers_to is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + f"Content-Length: {len(payload)}\r\n\r\n".encode())
    block = http if revisit else http + payload
    uri = f"urn:page:{page_id}" if url is None else "".join(
        c if c.isprintable() and c != " " else "".join(f"%{x:02X}" for x in c.encode())
        for c in url)
    head = _header([
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date), ("WARC-Target-URI", uri), ("X-Page-ID", page_id),
        ("WARC-Payload-Digest", f"sha1:{digest32(payload)}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to) if revisit else None),
        ("X-Refers-To-Page-ID", refers_to),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def warcinfo(name: str, date: str = DATE) -> bytes:
    block = b"software: auric\r\nformat: WARC File Format 1.1\r\n"
    head = _header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name)),
                    ("WARC-Date", date), ("WARC-Filename", name),
                    ("Content-Type", "application/warc-fields"), ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int = DICT_BYTES, sample_bytes: int = SAMPLE_BYTES):
    """A dictionary from records spread over the archive, at most ``sample_bytes`` of
    them; raw content where there are too few to train on."""
    import zstandard as z
    total = sum(map(len, records))
    step = max(1, -(-total // sample_bytes))
    sample = [r[:sample_bytes] for r in records[::step]]
    try:
        return z.train_dictionary(min(size, max(1024, sum(map(len, sample)) // 8)), sample,
                                  k=512, d=8)
    except z.ZstdError:
        return z.ZstdCompressionDict(b"".join(sample)[-size:] or b"WARC/1.1\r\n",
                                     dict_type=z.DICT_TYPE_RAWCONTENT)


def _open(path: str):
    """(file system, path on it) of a folder named as Spark names it."""
    from pyarrow import fs
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_archive(folder: str, records: list[bytes], level: int = LEVEL) -> tuple[str, int, int]:
    """(path, records, bytes) of a new archive."""
    import zstandard as z
    name = f"{uuid.uuid4().hex}.warc.zst"
    trained = dictionary(records)
    packer = z.ZstdCompressor(level=level, dict_data=trained)
    files, base = _open(folder)
    files.create_dir(base, recursive=True)
    raw = trained.as_bytes()
    size = 8 + len(raw)
    with files.open_output_stream(f"{base}/{name}", compression=None) as out:
        out.write(struct.pack("<II", MAGIC, len(raw)) + raw)
        for r in [warcinfo(name), *records]:
            frame = packer.compress(r)
            out.write(frame)
            size += len(frame)
    return f"{folder}/{name}", len(records), size


def read_archive(path: str):
    """Yield each record's bytes, frame by frame."""
    import zstandard as z
    files, name = _open(path)
    with files.open_input_stream(name, compression=None) as f:
        magic, size = struct.unpack("<II", f.read(8))
        if magic != MAGIC:
            raise ValueError(f"{path}: no dictionary frame")
        raw = f.read(size)
        trained = raw[:4] == struct.pack("<I", 0xEC30A437)
        known = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_FULLDICT if trained
                                      else z.DICT_TYPE_RAWCONTENT)
        unpacker = z.ZstdDecompressor(dict_data=known)
        rest = b""
        while rest := rest or f.read(READ_BYTES):
            frame, parts = unpacker.decompressobj(), []
            while True:
                parts.append(frame.decompress(rest))
                if frame.eof:
                    rest = frame.unused_data
                    break
                rest = f.read(READ_BYTES)
                if not rest:
                    raise ValueError(f"{path}: cut short")
            yield b"".join(parts)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (the version left out) and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.decode().split(": ", 1) for line in head.split(b"\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])]


def plan(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """(_id, url, html, refers_to): the page that holds the payload, for revisits."""
    own = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    keyed = own.withColumn("sha", F.unhex(F.sha1("html")))
    groups = (keyed.where(F.octet_length("html") >= min_bytes).groupBy("sha")
              .agg(F.max("_id").alias("keeper"), F.count(F.lit(1)).alias("many"))
              .where("many > 1").select("sha", "keeper"))
    return (keyed.join(groups, "sha", "left")
            .select("_id", "url", "html",
                    F.when(~F.col("_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
                    .alias("refers_to")))


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", min_bytes: int = 0,
               archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives; the manifest (path, records, bytes) as a finished table."""

    def run(batches):
        held, size = [], 0
        done = []
        for b in batches:
            for i, url, html, to in zip(*(b.column(k) for k in range(4))):
                held.append(record(i.as_py(), url.as_py(), html.as_buffer().to_pybytes(),
                                   to.as_py()))
                size += len(held[-1])
                if size >= archive_bytes:
                    done.append(write_archive(folder, held))
                    held, size = [], 0
        if held:
            done.append(write_archive(folder, held))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*done) if done else ((), (), ()),
                                            (pa.string(), pa.int64(), pa.int64()))],
            ["path", "records", "bytes"])

    return materialize(plan(pages, id_col, url_col, html_col, min_bytes)
                       .mapInArrow(run, "path string, records bigint, bytes bigint"), "manifest")


def read_warc(manifest: DataFrame, id_col: str = "page_id", id_type: str = "bigint",
              payload: bool = True) -> DataFrame:
    """One row per response or revisit: id, url, payload_bytes, payload_digest,
    record_type, refers_to and, if asked for, the payload (null for revisits)."""
    schema = (f"`{id_col}` string, url string, payload_bytes bigint, payload_digest string, "
              "record_type string, refers_to string" + ", payload binary" * payload)

    def rows(path):
        for raw in read_archive(path):
            head, block = parse(raw)
            if head["WARC-Type"] == "warcinfo":
                continue
            http, _, body = block.partition(b"\r\n\r\n")
            size = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
            digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
            stored = head["WARC-Type"] == "response"
            if stored and (len(body), digest32(body)) != (size, digest):
                raise ValueError(f"{path}: payload of {head['WARC-Record-ID']} is damaged")
            yield (head.get("X-Page-ID"), head["WARC-Target-URI"], size, digest,
                   head["WARC-Type"], head.get("X-Refers-To-Page-ID"),
                   *([body if stored else None] if payload else []))

    def run(batches):
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(),
                 *([pa.binary()] if payload else [])]
        names = [id_col, "url", "payload_bytes", "payload_digest", "record_type", "refers_to",
                 *(["payload"] if payload else [])]

        def batch(held):
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*held), types)], names)

        for b in batches:
            for path in b.column(0).to_pylist():
                held = []
                for r in rows(path):
                    held.append(r)
                    if len(held) == 256:
                        yield batch(held)
                        held = []
                if held:
                    yield batch(held)

    files = manifest.count()
    out = (manifest.select("path").repartition(max(1, files), "path").mapInArrow(run, schema))
    return (out.withColumn(id_col, F.col(id_col).cast(id_type))
            .withColumn("refers_to", F.col("refers_to").cast(id_type)))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_warc(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_warc(manifest, payload=False).drop("url")


QUERIES = {"op3_warc": op3_warc}
ORACLE = {"op3_warc": """
    WITH p AS (
        SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS sha
        FROM pages
    ), g AS (
        SELECT sha, max(page_id) AS keeper FROM p GROUP BY sha
    ), n AS (
        SELECT p.page_id, octet_length(p.body) AS payload_bytes, g.keeper, unhex(p.sha) AS raw
        FROM p JOIN g USING (sha)
    ), bits AS (
        SELECT page_id, payload_bytes, keeper, CAST(raw AS BIT)::VARCHAR AS b FROM n
    )
    SELECT page_id, payload_bytes,
           list_aggregate(list_transform(range(32), lambda i:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      1 + CAST(list_sum(list_transform(range(5), lambda j:
                          CAST(substr(b, CAST(5 * i + j + 1 AS INTEGER), 1) AS INTEGER)
                          * CAST(2 ** (4 - j) AS INTEGER))) AS INTEGER), 1)),
               'string_agg', '') AS payload_digest,
           CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> keeper THEN keeper END AS refers_to
    FROM bits
"""}
