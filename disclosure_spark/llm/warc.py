"""Web archives: written as one gzip stream a file, normalised to a member a record, read by index.

A task writes the records of its pages to a file that is one gzip stream. The
normaliser inflates each such file once from start to end, rewrites every record as a
gzip member of its own, and writes a sidecar with each record's offset and length.
Reading goes by the sidecars, so that ranges of records are tasks of their own.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosure_spark.workspace import arrow_uri, run_path

from .shared import arrow_batch, saved

REVISIT_BYTES = 100  # payloads of at least so many bytes are stored once
LEVEL = 3  # of compression
CHUNK = 1 << 20  # bytes inflated at a time
MEMBERS = 64  # records a reading task takes from a file in one go
DATE = "2024-01-01T00:00:00Z"


def _open(path: str):
    """The file system of a URI in the shared folder, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class _Out:
    """A file that gets its name only when it is complete, so that a lost task leaves none."""

    def __init__(self, path: str, attempt: int):
        self.files, self.path = _open(path)
        self.files.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.part = f"{self.path}.{attempt}.part"

    def __enter__(self):
        self.stream = self.files.open_output_stream(self.part, compression=None)
        return self.stream

    def __exit__(self, kind, *_):
        self.stream.close()
        if kind is None:
            self.files.move(self.part, self.path)
        else:
            self.files.delete_file(self.part)


def _attempt() -> int:
    from pyspark import TaskContext

    return TaskContext.get().taskAttemptId()


def record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None) -> bytes:
    """A record with an HTTP response; a revisit has the headers alone."""
    base32 = base64.b32encode(digest).decode().rstrip("=")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A").replace(" ", "%20")
    name = "null" if page_id is None else page_id
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Target-URI: {clean}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{base32}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _head(data: bytes | memoryview, end: int) -> dict[str, str]:
    lines = bytes(data[:end]).decode().split("\r\n")
    return {"": lines[0]} | {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Head and bytes of each record of an inflated stream; holds one record at a time."""
    buffer = bytearray()
    looked = 0
    need = -1
    head: dict[str, str] = {}
    for chunk in chunks:
        buffer += chunk
        while True:
            if need < 0:
                end = buffer.find(b"\r\n\r\n", max(0, looked - 3))
                if end < 0:
                    looked = len(buffer)
                    break
                head = _head(buffer, end)
                need = end + 4 + int(head["content-length"]) + 4
            if len(buffer) < need:
                break
            yield head, bytes(buffer[:need])
            del buffer[:need]
            need, looked = -1, 0
    if buffer:
        raise ValueError("the archive ends inside a record")


def _inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members."""
    member = zlib.decompressobj(31)
    while data := stream.read(CHUNK):
        while data:
            yield member.decompress(data)
            data = member.unused_data
            if member.eof and data:
                member = zlib.decompressobj(31)
    if not member.eof:
        raise ValueError("the archive is cut off")


def write(pages: DataFrame, root: str) -> DataFrame:
    """Write a record for each page to ``root``; returns the files, a row each.

    Needs page_id, url, html and refers_to. ``mono-<n>.warc.gz`` has the records of task n.
    """

    def task(batches):
        from pyspark import TaskContext

        path = f"{root}/mono-{TaskContext.get().partitionId():06d}.warc.gz"
        many = 0
        with _Out(path, _attempt()) as out:
            pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            for batch in batches:
                for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    payload = (html or "").encode()
                    out.write(pack.compress(record(page_id, url, payload, hashlib.sha256(payload).digest(), refers_to)))
                    many += 1
            out.write(pack.flush())
        yield arrow_batch("file string, records long", [[path], [many]])

    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(task, "file string, records long")


INDEX = "file string, offset long, length long, id string, type string, digest string"


def normalise(files: DataFrame) -> DataFrame:
    """Rewrite each file as ``rec-<n>.warc.gz``, a member a record, with ``rec-<n>.index.json`` beside it.

    Returns the index, a row per record.
    """

    def task(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                folder, _, base = path.rpartition("/")
                target = f"{folder}/{base.replace('mono-', 'rec-')}"
                index: dict[str, list] = {k.split()[0]: [] for k in INDEX.split(", ")}
                offset = 0
                source, inner = _open(path)
                with source.open_input_stream(inner, compression=None) as stream, _Out(target, _attempt()) as out:
                    for head, data in records(_inflated(stream)):
                        pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = pack.compress(data) + pack.flush()
                        out.write(member)
                        row = (target, offset, len(member), head["warc-record-id"], head["warc-type"], head["warc-payload-digest"])
                        for k, v in zip(index, row, strict=True):
                            index[k].append(v)
                        offset += len(member)
                with _Out(target.replace(".warc.gz", ".index.json"), _attempt()) as out:
                    for row in zip(*index.values(), strict=True):
                        out.write(json.dumps(dict(zip(index, row, strict=True))).encode() + b"\n")
                yield arrow_batch(INDEX, index)

    return files.select("file").mapInArrow(task, INDEX)


READ = "page_id long, url string, record_type string, refers_to long, declared_digest string, declared_bytes long, payload binary"


def _page(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "null" else int(name)


def read(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records named by an index. A member is read by its offset; neighbours in one go.

    A revisit has no payload (null). ``payloads=False`` gives payload_digest and payload_bytes,
    computed from what was read, in place of payloads.
    """
    schema = READ if payloads else READ.replace("payload binary", "payload_digest string, payload_bytes long")
    names = [x.split()[0] for x in schema.split(", ")]

    def task(batches):
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for path in dict.fromkeys(r[0] for r in rows):
                files, inner = _open(path)
                with files.open_input_file(inner) as stream:
                    own = [r for r in rows if r[0] == path]
                    for at in range(0, len(own), MEMBERS):
                        out: dict[str, list] = {k: [] for k in names}
                        for _, offset, length in own[at : at + MEMBERS]:
                            data = zlib.decompress(stream.read_at(length, offset), 31)
                            end = data.index(b"\r\n\r\n")
                            head = _head(data, end)
                            block = data[end + 4 : end + 4 + int(head["content-length"])]
                            http = block.index(b"\r\n\r\n")
                            refers = head.get("warc-refers-to")
                            payload = None if refers else block[http + 4 :]
                            digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha256:") + "====").hex()
                            row = [_page(head["warc-record-id"]), head["warc-target-uri"], head["warc-type"]]
                            row += [_page(refers) if refers else None, digest, int(_head(block, http)["content-length"])]
                            if payloads:
                                row.append(payload)
                            else:
                                row += [None, None] if refers else [hashlib.sha256(payload).hexdigest(), len(payload)]
                            for k, v in zip(names, row, strict=True):
                                out[k].append(v)
                        yield arrow_batch(schema, out)

    return index.select("file", "offset", "length").mapInArrow(task, schema)


def with_references(pages: DataFrame) -> DataFrame:
    """Adds refers_to: of pages with an equal payload of ``REVISIT_BYTES`` or more, the least page_id; null for that one.

    A null page_id is never referred to. Digests are grouped before anything is joined, and the pages
    themselves are joined only with the pages that revisit, by page_id.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    digests = pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.length(payload).alias("bytes"))
    large = saved(digests.filter(F.col("bytes") >= REVISIT_BYTES).filter("page_id is not null"), "warc_digests")
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).filter("refers_to < last")
    revisits = large.join(firsts, "digest").filter("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()
    joined = pages.withColumn("_digest", F.sha2(payload, 256)).join(
        revisits.withColumnRenamed("digest", "_digest"), ["page_id", "_digest"], "left"
    )
    return joined.drop("_digest")


def archive(spark: SparkSession, pages: DataFrame, root: str | None = None) -> DataFrame:
    """Write the pages as archives below ``root`` (a new shared folder), normalise them; returns the index table."""
    root = arrow_uri(spark, root or run_path(spark, "warc"))
    source = pages.select("page_id", "url", "html")
    files = saved(write(with_references(source), root), "warc_files")
    many = max(1, files.count())
    return saved(normalise(files.repartition(many)), "warc_index")


def roundtrip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back: one row per page.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to. A null html is an
    empty payload. Pages that share a page_id are records of their own; of equal payloads those
    with the least page_id are all responses. Pages without page_id are responses. An empty
    table gives an empty result. A revisit's digest and size are those its record
    declares; a response's are computed from the payload read, and must agree.
    """
    index = archive(spark, pages)
    # A number of its own, as the index is small and would end up in one task.
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = read(index.repartition(many, "file", F.floor(F.col("offset") / (1 << 20))), payloads=False)
    agrees = F.col("record_type").eqNullSafe("revisit") | (
        F.col("payload_digest").eqNullSafe(F.col("declared_digest")) & F.col("payload_bytes").eqNullSafe(F.col("declared_bytes"))
    )
    checked = F.when(agrees, F.col("declared_bytes")).otherwise(F.raise_error(F.lit("a payload differs from its record")))
    return back.select(
        "page_id",
        checked.cast("long").alias("payload_bytes"),
        F.col("declared_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
