"""WARC archives in Zstandard: one frame per record, a dictionary up front.

An archive starts with a skippable frame that holds a Zstandard dictionary;
each following frame is one whole WARC/1.1 record compressed with it. The
reader loads the dictionary from the leading skippable frame, decodes frame by
frame, and validates version line, headers, lengths, the record's end, and the
payload digest; a bad record is reported in ``error`` and reading goes on with
the next frame.

Equal payloads are stored once: of a group of equal payloads of at least
``min_bytes`` bytes the record with the largest id is the response, and the
others are revisit records that refer to it.

Archives lie in a shared folder, in any file system that Arrow can write
(file, hdfs, s3, gs); a task writes an archive under a temporary name and
renames it, so a repeated task replaces its own files. Archives are read as
Spark's ``binaryFile`` source. Each holds at most ``ARCHIVE_BYTES`` of payload
(one record at least), which bounds memory on both sides.

Defined cases: a null payload is empty; a null url has no target header and
reads back as null. Rows repeated under one page_id are records of their own,
and those with the largest page_id of their payload are all responses; a null
page_id counts as smaller than any other. An empty table writes no archives.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.llm.common import NULL_ID, scratch, stored, text_bytes

SKIPPABLE_MAGIC = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
DICT_MAGIC = 0xEC30A437
ARCHIVE_BYTES = 16 << 20
#: Of an archive's first payload bytes, as many train its dictionary, which has at most so many bytes.
SAMPLE_BYTES, DICT_BYTES = 1 << 20, 16 << 10
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    """A URN that stands for the page."""
    return "<urn:uuid:null>" if page_id is None else f"<urn:uuid:{uuid.UUID(int=page_id % (1 << 64))}>"


def page_of(urn: str) -> int | None:
    text = urn.removeprefix("<urn:uuid:").removesuffix(">")
    if text == "null":
        return None
    n = uuid.UUID(text).int
    return n - (1 << 64) if n >= 1 << 63 else n


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
                 digest: str | None = None) -> bytes:
    """One WARC/1.1 response or revisit record; a revisit keeps the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
               ("WARC-Date", EPOCH)]
    if url is not None:
        headers.append(("WARC-Target-URI", _escaped(url)))
    headers.append(("WARC-Payload-Digest", "sha1:" + (digest or digest32(payload))))
    if revisit:
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers_to))]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _escaped(url: str) -> str:
    """A header value has one line: percent-encode controls (and the percent sign, so that it reads back)."""
    return "".join(f"%{ord(c):02X}" if c in "%\r\n" or ord(c) < 33 or ord(c) == 127 else c for c in url)


def _plain(url: str) -> str:
    from urllib.parse import unquote
    return unquote(url)


def parse_record(data: bytes) -> dict:
    """Fields of one record; raises ValueError where it breaks a rule."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/1.") or end < 0:
        raise ValueError("no WARC header")
    lines = data[:end].decode("utf-8").split("\r\n")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in headers:
            raise ValueError(f"bad header line {line[:60]!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"no {name} header")
    if not headers["content-length"].isdigit():
        raise ValueError("bad content-length")
    length, start = int(headers["content-length"]), end + 4
    if len(data) != start + length + 4 or data[start + length:] != b"\r\n\r\n":
        raise ValueError(f"length {len(data) - start - 4} is not content-length {length}")
    block = data[start:start + length]
    split = block.find(b"\r\n\r\n")
    if split < 0:
        raise ValueError("no HTTP header")
    sizes = [h.split(b":", 1)[1].strip() for h in block[:split].split(b"\r\n") if h.lower().startswith(b"content-length:")]
    if len(sizes) != 1 or not sizes[0].isdigit():
        raise ValueError("bad HTTP content-length")
    payload, size = block[split + 4:], int(sizes[0])
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response":
        if len(payload) != size:
            raise ValueError("payload length differs from the HTTP header")
        if digest != digest32(payload):
            raise ValueError("payload digest differs")
    elif kind == "revisit":
        if payload or "warc-refers-to" not in headers or headers.get("warc-profile") != REVISIT:
            raise ValueError("bad revisit")
    else:
        raise ValueError(f"unexpected type {kind}")
    return {"page_id": page_of(headers["warc-record-id"]),
            "url": _plain(headers["warc-target-uri"]) if "warc-target-uri" in headers else None,
            "record_type": kind, "payload_bytes": size, "payload_digest": digest,
            "refers_to": page_of(headers["warc-refers-to"]) if kind == "revisit" else None,
            "payload": payload if kind == "response" else None}


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the records' common strings; none (b"") if there are too few to train one."""
    import zstandard
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def build_archive(records: list[bytes]) -> bytes:
    import zstandard
    samples, size = [], 0
    for r in records:
        if size < SAMPLE_BYTES:
            samples.append(r[:SAMPLE_BYTES - size])
            size += len(samples[-1])
    dictionary = train_dictionary(samples)
    made = [struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)), dictionary]
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compressor = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True, write_content_size=True)
    made += [compressor.compress(r) for r in records]
    return b"".join(made)


def read_archive(data: bytes) -> Iterator[tuple[int, dict | None, str | None]]:
    """(frame offset, fields or None, error or None) of each record of an archive."""
    import zstandard
    view, at, shared = memoryview(data), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == SKIPPABLE_MAGIC:
        size = struct.unpack_from("<I", view, 4)[0]
        body = bytes(view[8:8 + size])
        if len(body) != size:
            yield 0, None, "the dictionary frame is cut off"
            return
        if body[:4] == struct.pack("<I", ZSTD_MAGIC):  # the dictionary may itself be compressed
            body = zstandard.ZstdDecompressor().decompress(body)
        if body:
            if body[:4] != struct.pack("<I", DICT_MAGIC):
                yield 0, None, "the leading frame holds no dictionary"
                return
            shared = zstandard.ZstdCompressionDict(body)
        at = 8 + size
    decompressor = zstandard.ZstdDecompressor(dict_data=shared)
    while at < len(view):
        start, step = at, 1 << 15
        frame, made = decompressor.decompressobj(), []
        try:
            while not frame.eof and at < len(view):
                part = view[at:at + step]
                made.append(frame.decompress(part))
                at += len(part)
                step = min(2 * step, 1 << 20)
            at -= len(frame.unused_data)
            if not frame.eof:
                raise ValueError("the frame is cut off")
        except (zstandard.ZstdError, ValueError) as e:
            yield start, None, str(e)  # without its end the next frame's start is unknown
            return
        try:
            yield start, parse_record(b"".join(made)), None
        except (ValueError, UnicodeDecodeError) as e:
            yield start, None, str(e)


def plan(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, digest, response_id, is_response for each row. Digests are counted in each
    task before they move, and the join's right side is a stored table, so Spark may split a payload
    that very many pages share."""
    html = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NULL_ID)).alias("page_id"),
                        F.col("url").cast("string").alias("url"), html.alias("html")).withColumn("sha1", F.sha1("html"))
    last = stored(rows.where(F.octet_length("html") >= min_bytes).groupBy("sha1")
                  .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1").drop("n"), "payloads")
    joined = rows.join(last, "sha1", "left")
    return joined.select("page_id", "url", "html", "sha1", F.when(
        F.col("response_id") > F.col("page_id"), F.col("response_id")).alias("refers_to"))


MANIFEST = "path string, records long, bytes long"


def write(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write each row of ``pages`` (page_id, url, html) as a record into archives under ``folder`` (a URI).

    Returns the stored manifest (path, records, bytes); only archives named in it count.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext
        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        held, size, made = [], 0, []

        def flush() -> None:
            nonlocal held, size
            data = build_archive(held)
            # named by attempt: one that ran before or beside the recorded one changes none of its archives
            name = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(made):05d}.warc.zst"
            partial = f"{name}.partial"
            with store.open_output_stream(partial) as out:
                out.write(data)
            store.move(partial, name)
            made.append((f"{folder}/{name.rsplit('/', 1)[1]}", len(held), len(data)))
            held, size = [], 0

        for batch in batches:
            ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            raw, offsets = text_bytes(batch.column(2))
            digests, refers = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for k, page_id in enumerate(ids):
                page_id = None if page_id == NULL_ID else page_id
                payload = raw[offsets[k]:offsets[k + 1]].tobytes()
                held.append(build_record(page_id, urls[k], payload, refers[k], refers[k] is not None,
                                         base64.b32encode(bytes.fromhex(digests[k])).decode()))
                size += len(payload)
                if size >= archive_bytes:
                    flush()
        if held:
            flush()
        if made:
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[0] for m in made]), pa.array([m[1] for m in made], pa.int64()),
                 pa.array([m[2] for m in made], pa.int64())], ["path", "records", "bytes"])

    return stored(plan(pages, min_bytes).mapInArrow(run, MANIFEST), "manifest")


RECORDS = ("path string, frame_offset long, page_id long, url string, record_type string, payload_bytes long, "
           "payload_digest string, refers_to long, payload binary, error string")


def read(spark: SparkSession, paths: list[str] | str, payloads: bool = True, manifest: DataFrame | None = None) -> DataFrame:
    """One row per record of the archives at ``paths`` (files or folders), with its payload if it holds one.

    With a ``manifest``, archives that it does not name (a lost task attempt
    left them) are passed over, and one that it names but is not there is an error.
    """
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("frame_offset", pa.int64()), ("page_id", pa.int64()),
                            ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
                            ("error", pa.string())])
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                path, rows, size = path.as_py(), [], 0
                for offset, fields, error in read_archive(content.as_py()):
                    row = {"path": path, "frame_offset": offset, "error": error, **dict.fromkeys(names), **(fields or {})}
                    size += len(row["payload"] or b"")
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(paths)
    name = F.substring_index("path", "/", -1)
    if manifest is not None:  # names alone meet here; contents stay where they are read
        there, known = files.select(name.alias("name")), manifest.select(name.alias("name"))
        missing = known.join(there, "name", "left_anti").first()
        if missing:
            raise FileNotFoundError(f"archive {missing['name']} of the manifest is not there")
        surplus = there.join(known, "name", "left_anti").agg(F.collect_list("name")).first()[0]  # of lost attempts
        files = files.where(~name.isin(surplus)) if surplus else files
    return files.select("path", "content").mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the scratch folder and read them back; raises if a record is bad."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    manifest = write(pages, folder, min_bytes)
    wrote = manifest.agg(F.sum("records").alias("n")).first()["n"]
    if not wrote:
        return spark.createDataFrame([], RECORDS)
    records = read(spark, folder, payloads=False, manifest=manifest)
    return records.withColumn("record_type", F.when(F.col("error").isNull(), F.col("record_type")).otherwise(
        F.raise_error(F.concat_ws(": ", "path", "error")).cast("string")))
