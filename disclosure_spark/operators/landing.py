"""Fetching planned blobs into the landing zone, one task per share of the files."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame

from ..workspace import arrow_uri

# Fixed value: bytes held in memory per running download.
CHUNK_BYTES = 1 << 20

REPORT_SCHEMA = "path string, status string, bytes bigint, error string"


def fetch(
    pending: DataFrame,
    root: str,
    report: str,
    *,
    tasks: int | None = None,
    headers: Mapping[str, str] | None = None,
    timeout: float = 600.0,
    replace: bool = False,
) -> DataFrame:
    """Copy each ``downloadUrl`` of ``pending`` to its ``path`` below ``root``.

    ``root`` is a folder that all executors reach, as a path or URI that Spark knows. A file that is
    there is kept; with ``replace`` only if it has the size that the source tells, so
    that a partial or outdated one is fetched. The files are spread evenly
    over ``tasks`` tasks. A download is streamed in chunks to a name of its own
    and then renamed, so a lost task leaves no half-written file under a final
    name, and its second attempt finds what the first one finished. A file that
    fails is reported and does not stop the others.

    The outcome per file is written to ``report`` and read back from there:
    looking at it again fetches nothing again.
    """
    spark = pending.sparkSession
    headers = dict(headers or {})
    chunk_bytes = CHUNK_BYTES
    place = arrow_uri(spark, root)

    def run(batches: Iterator) -> Iterator:
        import urllib.request
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(place)
        text = pa.string()
        report_schema = pa.schema(
            [("path", text), ("status", text), ("bytes", pa.int64()), ("error", text)]
        )

        def copy(url: str, path: str) -> int:
            if ".." in path.split("/"):
                raise ValueError("the path leaves the landing zone")
            target = f"{base}/{path}"
            found = store.get_file_info(target)
            here = found.type == fs.FileType.File
            if here and not replace:
                return found.size
            folder = target.rpartition("/")[0]
            store.create_dir(folder, recursive=True)
            partial = f"{folder}/_{uuid.uuid4().hex}.part"
            request = urllib.request.Request(url, headers=headers)
            size = 0
            with urllib.request.urlopen(request, timeout=timeout) as source:
                if here and source.headers.get("Content-Length") == str(found.size):
                    return found.size
                try:
                    with store.open_output_stream(partial) as sink:
                        while chunk := source.read(chunk_bytes):
                            sink.write(chunk)
                            size += len(chunk)
                    expected = source.headers.get("Content-Length")
                    if expected is not None and size != int(expected):
                        raise OSError(f"{size} of {expected} bytes came")
                except BaseException:
                    store.delete_file(partial)
                    raise
            if here:
                store.delete_file(target)
            store.move(partial, target)
            return size

        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                outcome = {"path": row["path"], "status": "downloaded", "bytes": None, "error": None}
                try:
                    outcome["bytes"] = copy(row["downloadUrl"], row["path"])
                except Exception as e:
                    outcome |= {"status": "failed", "error": f"{type(e).__name__}: {e}"}
                rows.append(outcome)
            yield pa.RecordBatch.from_pylist(rows, schema=report_schema)

    tasks = tasks or spark.sparkContext.defaultParallelism
    files = pending.select("path", "downloadUrl").repartition(tasks)
    files.mapInArrow(run, REPORT_SCHEMA).write.mode("overwrite").parquet(report)
    return spark.read.schema(REPORT_SCHEMA).parquet(report)
