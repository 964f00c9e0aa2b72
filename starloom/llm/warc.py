"""A deterministic sharded WARC writer, and a reader.

Records are dealt into shards by ranges of the page id, which a hash-picked share of the ids
and their payloads' sizes decide, so the same pages always give the same shards. A shard is one or
more files; a file is rolled as soon as it holds ``roll_bytes`` of compressed records. Every record is
a gzip member of its own, with headers, lengths and digests made anew from the payload.

Tasks write under temporary names, which no other attempt uses, and report name, size and digest of each
file. The report is written as a table; a second job renames the files, skipping those that are
there already; the manifest, written last, is what readers go by. So a lost task or a
second attempt leaves at most stray temporary files.

Of records with equal payloads of at least ``REVISIT_LEAST`` bytes, those with the smallest page id are
responses and the others revisits, which name it and hold no payload.

Null html is an empty payload. A null page id sorts first and is never the smallest while there
is another; its record has no page id. A null url becomes urn:page:ID. Line ends in urls are
percent-encoded. Repeated rows give a record each, told apart by a running number; all rows that repeat
the smallest id are responses. An empty table gives an empty manifest. Other columns are not
read. A payload must fit into memory.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import BROADCAST_BYTES, id_ranges, range_of, whole
from starloom.sources.warehouse import new_folder, settle

# The format's version line, date and types of these archives.
VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
REVISIT_LEAST = 100
SHARD_BYTES = 16 << 20
ROLL_BYTES = 8 << 20
_LEVEL = 4
_MANIFEST = "file string, temporary string, records long, bytes long, sha256 string"


def prepared(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (text), payload_bytes, payload_digest."""
    body = pages.select("page_id", "url", whole("html").alias("payload"))
    return body.select(
        "page_id", "url", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("payload_digest"),
    )


def repeated_payloads(records: DataFrame) -> DataFrame:
    """Digests of payloads that more than one page id or row has, with the smallest page id."""
    long_enough = records.where(F.col("payload_bytes") >= REVISIT_LEAST)
    counted = long_enough.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    return counted.where("n > 1 and first_id is not null").select("payload_digest", "first_id")


def _block(headers: list[tuple[str, str]], body: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(body)))])
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member without time or name, so that equal records give equal bytes."""
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _record_id(page_id: int | None, digest: str, url: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url} {number}')}>"


def _uri(url: str | None, page_id: int | None) -> str:
    text = f"urn:page:{page_id}" if url is None else url
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in text)


def record(page_id, url, payload: bytes, digest: str, first_id, number: int) -> bytes:
    """One record, uncompressed. ``first_id`` is the page id of the equal response of a revisit, else null."""
    uri = _uri(url, page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = first_id is not None
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest, uri, number)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-ID", str(first_id))]
    body = http if revisit else http + payload
    headers.append(("WARC-Block-Digest", f"sha256:{hashlib.sha256(body).hexdigest()}"))
    return _block(headers, body)


class _Files:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.system, self.folder = fs.FileSystem.from_uri(folder)
        self.shard, self.roll_bytes, self.number, self.out = shard, roll_bytes, 0, None

    def add(self, member: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.name = f"part-{self.shard:08d}-{self.number:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out = self.system.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
            self.records, self.size, self.digest, self.number = 0, 0, hashlib.sha256(), self.number + 1
        self.out.write(member)
        self.digest.update(member)
        self.records, self.size = self.records + 1, self.size + len(member)
        if self.size >= self.roll_bytes:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            self.out = None
            yield (self.name, self.temporary, self.records, self.size, self.digest.hexdigest())


def _reports(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    names = ["file", "temporary", "records", "bytes", "sha256"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _full_uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def write(pages: DataFrame, folder: str | None = None, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> str:
    """Write the archive and its manifest to a new folder, and give the folder back."""
    spark = pages.sparkSession
    folder = _full_uri(folder or new_folder(spark, "warc"))
    records = prepared(pages)
    # What the ids, sizes and digests decide is read once and kept; the payloads are not part of it.
    narrow = settle(records.select("page_id", "payload_bytes", "payload_digest"), "warc_index")
    firsts = settle(repeated_payloads(narrow), "warc_repeats")
    sizes = narrow.select(F.col("page_id").cast("long").alias("id"), (F.col("payload_bytes") + 400).alias("weight"))
    edges = id_ranges(sizes, shard_bytes)
    placed = records.withColumn("shard", range_of("page_id", edges) + 1)
    keys = firsts.withColumnsRenamed({"payload_digest": "d"})
    if firsts.count() * 100 <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    joined = placed.join(keys, F.col("payload_digest") == F.col("d"), "left")
    revisits = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    rows = joined.select(
        "shard", "page_id", "url", "payload_digest", revisits.alias("first_id"), "payload"
    )
    dealt = rows.repartitionById(len(edges) + 2, "shard")
    ordered = dealt.sortWithinPartitions("shard", "page_id", "payload_digest", "url")

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(f"{path}/_temporary", recursive=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, last, number = None, None, 0
        for batch in batches:
            done: list[tuple] = []
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                at, page_id, url, digest, first_id, payload = (c[i].as_py() for c in columns)
                if files is None or files.shard != at:
                    if files is not None:
                        done += files.close()
                    files = _Files(folder, at, roll_bytes)
                number = number + 1 if last == (page_id, digest, url) else 0
                last = (page_id, digest, url)
                done += files.add(_member(record(page_id, url, payload.encode(), digest, first_id, number)))
            if done:
                yield _reports(done)
        if files is not None and (done := list(files.close())):
            yield _reports(done)

    reported = settle(ordered.mapInArrow(work, _MANIFEST), "warc_report")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if system.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
                    system.move(f"{path}/{temporary}", f"{path}/{name}")
            yield batch

    reported.mapInArrow(commit, _MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def _records(data: Iterator[bytes], where: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and body of each gzip member of a stream."""
    unpacker, held = zlib.decompressobj(31), []
    for chunk in data:
        while chunk:
            held.append(unpacker.decompress(chunk))
            chunk = unpacker.unused_data
            if unpacker.eof:
                raw = b"".join(held)
                head, _, rest = raw.partition(b"\r\n\r\n")
                lines = head.decode().split("\r\n")
                headers = dict(line.split(": ", 1) for line in lines[1:])
                body = rest[: int(headers["Content-Length"])]
                if lines[0].encode() != VERSION or rest[len(body) :] != b"\r\n\r\n":
                    raise ValueError(f"{where}: a record is malformed")
                yield headers, body
                unpacker, held = zlib.decompressobj(31), []
    if any(held):
        raise ValueError(f"{where}: the last record is cut off")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All records of an archive: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    Digests and lengths are checked against what is there. A revisit's payload is null.
    """
    folder = _full_uri(folder)
    listed = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").select("file", "sha256", "records")
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())

    def parsed(headers: dict[str, str], body: bytes, where: str) -> tuple:
        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
        payload = None
        if hashlib.sha256(body).hexdigest() != headers["WARC-Block-Digest"].removeprefix("sha256:"):
            raise ValueError(f"{where}: a block differs from its digest")
        if headers["WARC-Type"] == "response":
            payload = body.partition(b"\r\n\r\n")[2]
            if hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(headers["X-Payload-Length"]):
                raise ValueError(f"{where}: a payload differs from its digest")
        number = lambda name: int(headers[name]) if name in headers else None
        return (
            number("X-Page-ID"), headers["WARC-Target-URI"], headers["WARC-Type"], number("X-Refers-To-Page-ID"),
            number("X-Payload-Length"), digest, payload,
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        names = [f.split()[0] for f in schema.split(", ")]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
        for batch in batches:
            for name, sha256, count in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                digest, seen, rows, size = hashlib.sha256(), 0, [], 0
                with system.open_input_stream(f"{path}/{name}", compression=None) as stream:

                    def chunks(stream=stream, digest=digest) -> Iterator[bytes]:
                        while chunk := stream.read(1 << 20):
                            digest.update(chunk)
                            yield chunk

                    for headers, body in _records(chunks(), name):
                        rows.append(parsed(headers, body, name))
                        seen, size = seen + 1, size + len(body)
                        if size >= 4 << 20:
                            yield pack(rows)
                            rows, size = [], 0
                if rows:
                    yield pack(rows)
                if seen != count or digest.hexdigest() != sha256:
                    raise ValueError(f"{name} differs from the manifest")

    # One task a file, or as many files a task as there are tasks.
    files = listed.repartition(max(1, min(listed.count(), 1 << 16)), "file")
    return files.mapInArrow(work, schema)
