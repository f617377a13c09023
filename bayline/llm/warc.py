"""WARC archives compressed with Zstandard, written and read back.

An archive starts with a skippable frame that holds its dictionary; every
record is one frame. The writer stores each distinct payload once: of records
with equal payloads the one with the largest id is a ``response``, the others
are ``revisit`` records that refer to it (payloads under ``min_revisit`` bytes
are always stored). The reader loads the dictionary, finds each frame's end
from its block headers, decodes one frame at a time and checks headers,
lengths and digests.

Archives go to the given folder through pyarrow's file systems, so any store
that they reach can be named by URI. A task writes under a hidden name and moves
the finished file to one that no other run of the task shares. The list that
:func:`write_archives` returns names the archives that count: what a lost task
left behind is no part of it, and :func:`read_listed` reads no other file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.llm.staging import staged
from bayline.plans.runtime import scratch_path

# Fixed values of the formats: the skippable frame of a dictionary, a
# Zstandard frame, a trained dictionary.
DICT_FRAME, DATA_FRAME, TRAINED = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
VERSION = b"WARC/1.1"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
ARCHIVE_BYTES = 32 << 20
DICT_BYTES, SAMPLE_BYTES = 16 << 10, 1 << 20


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- records

def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One WARC record; a revisit, without its payload, if ``refers_to`` is given."""
    head = HTTP % len(payload)
    block = head if refers_to is not None else head + payload
    lines = [VERSION, b"WARC-Type: " + (b"revisit" if refers_to is not None else b"response")]
    if page_id is not None:
        lines.append(b"WARC-Record-ID: <urn:page:%d>" % page_id)
    if url:
        lines.append(b"WARC-Target-URI: " + url.encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A"))
    if refers_to is not None:
        lines.append(b"WARC-Refers-To: <urn:page:%d>" % refers_to)
        lines.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += [b"WARC-Payload-Digest: sha1:" + payload_digest(payload).encode(),
              b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one record; ``error`` says what is wrong with it, if anything."""
    out = dict.fromkeys(("page_id", "url", "record_type", "refers_to", "payload", "payload_bytes",
                         "payload_digest", "error"))
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        return out | {"error": "no WARC header"}
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
    number = lambda v: int(v[10:-1]) if v and v.startswith(b"<urn:page:") and v.endswith(b">") else None
    try:
        out |= {"page_id": number(fields.get(b"warc-record-id")), "refers_to": number(fields.get(b"warc-refers-to")),
                "record_type": fields[b"warc-type"].decode()}
        length = int(fields[b"content-length"])
        digest = fields[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
    except (KeyError, ValueError) as e:
        return out | {"error": f"bad header: {e}"}
    if b"warc-target-uri" in fields:
        out["url"] = fields[b"warc-target-uri"].decode("utf-8", "replace")
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        return out | {"error": f"content length {length} does not fit"}
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    size = next((int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    if not gap or size is None:
        return out | {"error": "no HTTP header"}
    out |= {"payload_bytes": size, "payload_digest": digest}
    if out["record_type"] == "response":
        if len(payload) != size:
            return out | {"error": f"payload of {len(payload)} bytes, {size} stated"}
        if payload_digest(payload) != digest:
            return out | {"error": "payload digest does not fit"}
        out["payload"] = payload
    elif out["record_type"] != "revisit" or payload or out["refers_to"] is None:
        return out | {"error": "neither a response nor a revisit"}
    return out


# ---- archives

def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on an archive's first records, or their text if too few."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, level=3)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICT_BYTES:].ljust(8, b"\0"),
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: Iterator[bytes]) -> Iterator[bytes]:
    """An archive's bytes, frame by frame, dictionary first."""
    first, size = [], 0
    for r in records:
        first.append(r)
        size += len(r)
        if size >= SAMPLE_BYTES:
            break
    zdict = _dictionary([r[:32 << 10] for r in first])
    raw = zdict.as_bytes()
    yield struct.pack("<II", DICT_FRAME, len(raw)) + raw
    c = zstandard.ZstdCompressor(level=3, dict_data=zdict, write_checksum=True, write_content_size=True)
    for r in first:
        yield c.compress(r)
    for r in records:
        yield c.compress(r)


def _frame_end(data: memoryview, at: int) -> int:
    """Where the frame at ``at`` ends, from its header and block headers."""
    if len(data) - at < 8 or struct.unpack_from("<I", data, at)[0] != DATA_FRAME:
        raise ValueError(f"no frame at {at}")
    info = zstandard.get_frame_parameters(data[at:at + 18])
    pos, last = at + zstandard.frame_header_size(data[at:at + 18]), False
    while not last:
        head = int.from_bytes(data[pos:pos + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        pos += 3 + (1 if kind == 1 else size)
        if pos > len(data):
            raise ValueError(f"the frame at {at} is cut off")
    return pos + 4 * bool(info.has_checksum)


def read_archive(content: bytes) -> Iterator[dict]:
    """Records of one archive. What can't be decoded gives a last row with
    ``error`` set, as the next frame's place is then unknown."""
    data, at, zdict = memoryview(content), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data, 0)[0] == DICT_FRAME:
        size = struct.unpack_from("<I", data, 4)[0]
        raw, at = bytes(data[8:8 + size]), 8 + size
        if raw[:4] == struct.pack("<I", DATA_FRAME):  # the dictionary may be compressed itself
            raw = zstandard.ZstdDecompressor().decompress(raw)
        kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == struct.pack("<I", TRAINED) else zstandard.DICT_TYPE_RAWCONTENT
        zdict = zstandard.ZstdCompressionDict(raw, dict_type=kind)
    d = zstandard.ZstdDecompressor(dict_data=zdict) if zdict else zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            end = _frame_end(data, at)
            row = parse_record(d.decompress(data[at:end]))
        except (ValueError, zstandard.ZstdError) as e:
            yield parse_record(b"") | {"offset": at, "error": str(e)}
            return
        yield row | {"offset": at}
        at = end


# ---- Spark jobs

def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI, of one with Hadoop's names of S3 too."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def _write_udf(out_dir: str):
    def run(batches):
        fs, root = _file_system(out_dir)
        fs.create_dir(root, recursive=True)
        part, number, pending = TaskContext.get().partitionId(), 0, None

        def rows():
            for batch in batches:
                cols = [batch.column(i) for i in range(4)]
                for i in range(batch.num_rows):
                    page_id, url, html, refers_to = (c[i].as_py() for c in cols)
                    yield record(page_id, url, (html or "").encode("utf-8", "replace"), refers_to)

        source = rows()

        def some():
            """Records up to an archive's size."""
            nonlocal pending
            size = 0
            while size < ARCHIVE_BYTES:
                r, pending = pending if pending is not None else next(source, None), None
                if r is None:
                    return
                size += len(r)
                yield r

        while (pending := next(source, None)) is not None:
            name = f"part-{part:05d}-{number:05d}-{uuid.uuid4().hex}.warc.zst"
            temp, final = f"{root}/.{name}", f"{root}/{name}"
            n = 0
            with fs.open_output_stream(temp, compression=None) as f:
                for frame in archive(some()):
                    f.write(frame)
                    n += 1
            fs.move(temp, final)
            yield pa.RecordBatch.from_pydict({"archive": [name], "n_records": [n - 1]},
                                             schema=pa.schema([("archive", pa.string()), ("n_records", pa.int64())]))
            number += 1
    return run


def write_archives(pages: DataFrame, out_dir: str, min_revisit: int = 0) -> DataFrame:
    """Writes a record for each row of ``pages`` (``page_id``, ``url``,
    ``html``) below ``out_dir`` and returns the list of archives: ``archive``
    (file name), ``n_records``.

    A null ``html`` is an empty payload. Of rows with equal payloads of at
    least ``min_revisit`` bytes all with the largest ``page_id`` are responses
    (more than one only if a row repeats), the others revisits; rows without a
    ``page_id`` are always responses. An empty table writes no archive."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    shared = (rows.where(F.octet_length("html") >= min_revisit).groupBy("digest")
              .agg(F.max("page_id").alias("top"), F.min("page_id").alias("low"))
              .where("low < top").select("digest", "top"))
    marked = rows.join(shared, "digest", "left").select(
        "page_id", "url", "html", F.when(F.col("page_id") < F.col("top"), F.col("top")).alias("refers_to"))
    return staged(marked.mapInArrow(_write_udf(out_dir), "archive string, n_records long"), "warc-list")


RECORD_TYPE = ("page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, "
               "payload_digest string, error string, offset long")


def _read_udf(with_payload: bool, folder: str | None = None):
    """Records of archives given by content or, below ``folder``, by name."""
    names = [x.split()[0] for x in RECORD_TYPE.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[x.split()[1]]) for n, x in zip(names, RECORD_TYPE.split(", "))])

    def run(batches):
        fs, root = _file_system(folder) if folder else (None, None)

        def content(given) -> bytes:
            if fs is None:
                return given
            with fs.open_input_stream(f"{root}/{given}", compression=None) as f:
                return f.read()

        for batch in batches:
            for given in batch.column(0):
                out, size = [], 0
                for r in read_archive(content(given.as_py())):
                    size += len(r["payload"] or b"")
                    out.append(r if with_payload else r | {"payload": None})
                    if size > 4 << 20 or len(out) >= 1000:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of every ``*.warc.zst`` below ``path``; ``error`` is null for a
    valid record. A folder without archives gives an empty result. For a folder
    that :func:`write_archives` filled see :func:`read_listed`."""
    files = (spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
             .option("pathGlobFilter", "*.warc.zst").load(path))
    return files.select("content").mapInArrow(_read_udf(with_payload), RECORD_TYPE)


def read_listed(archives: DataFrame, folder: str, n_archives: int, with_payload: bool = True) -> DataFrame:
    """Records of the archives that the list ``archives`` names below
    ``folder``, and of no other file there; about four archives a task."""
    return (archives.select("archive").repartition(max(1, -(-n_archives // 4)), "archive")
            .mapInArrow(_read_udf(with_payload, folder), RECORD_TYPE))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and reads them back:
    per record ``page_id``, ``payload_bytes``, ``payload_digest`` (both of the
    full payload), ``record_type``, ``refers_to``. A record that can't be read
    stops the query."""
    spark = pages.sparkSession
    out_dir = scratch_path(spark, "warc")
    archives = write_archives(pages, out_dir)
    n = archives.count()
    if not n:
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, "
                                         "record_type string, refers_to long")
    rows = read_listed(archives, out_dir, n, with_payload=False)
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("bad WARC record: "), "error"))
                     .cast("string")).otherwise(F.col("record_type"))
    return rows.select("page_id", "payload_bytes", "payload_digest", checked.alias("record_type"), "refers_to")


ROUND_TRIP_SQL = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
t as (select h, max(page_id) as top from p group by h)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((cast('0x' || substr(h, cast(i // 4 * 5 + 1 as bigint), 5) as integer) >> cast(15 - 5 * (i % 4) as integer)) & 31) + 1, 1)), '')
    as payload_digest,
  case when page_id < top then 'revisit' else 'response' end as record_type,
  case when page_id < top then top end as refers_to
from p join t using (h)"""
