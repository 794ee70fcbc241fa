"""Tables in the shared folder, and hashing of byte strings with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosure_spark.workspace import run_path

_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(df: DataFrame, name: str, partition_by: str | None = None, max_rows: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage.

    ``max_rows`` of a file, for rows that are large: Parquet's writer holds a hundred rows before it looks at their size, and
    its reader takes thousands at a time, but neither goes beyond a file.
    """
    spark = df.sparkSession
    path = run_path(spark, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    (writer.option("maxRecordsPerFile", max_rows) if max_rows else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``saved`` wrote and nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def single(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is in ``keys``, one of each: that whose columns are least as JSON.

    ``keys`` has each key once, with ``many``, its rows in ``docs``, and columns that are added to the result.
    Rows without an equal one are only joined; the others are reduced before they shuffle.
    """
    alone = docs.join(keys.filter("many = 1").drop("many"), key)
    several = keys.filter("many > 1").drop("many")
    if several.isEmpty():
        return alone
    row = F.struct(*docs.columns)
    equal = docs.join(several.select(key), key, "left_semi").withColumn("_row", row)
    chosen = equal.groupBy(key).agg(F.min_by("_row", F.to_json("_row")).alias("_row")).join(several, key)
    return alone.unionByName(chosen.select(*[key if c == key else F.col("_row").getField(c).alias(c) if c in docs.columns else c for c in alone.columns]))


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished jobs."""
    spark.sparkContext._jvm.System.gc()


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(),
    "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
}


def arrow_batch(ddl: str, columns: list | dict) -> pa.RecordBatch:
    """A batch of the columns of a schema such as ``"a long, b string"``."""
    fields = [x.split() for x in ddl.split(", ")]
    values = columns.values() if isinstance(columns, dict) else columns
    arrays = [v if isinstance(v, pa.Array) else pa.array(v, _ARROW[t]) for (_, t), v in zip(fields, values, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema([(n, _ARROW[t]) for n, t in fields]))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(30)
    return x


def pair_hash(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """A hash of the pairs (a, b), in that order."""
    return mix(a * np.uint64(_ODD[salt % len(_ODD)]) + b)


def window_hashes(data: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """For each size (ascending, 8 or more), the hash of every window of so many bytes.

    Windows of 8 bytes are their own value; longer ones combine two windows
    of half the size, or two that overlap.
    """
    have, size = data.astype(np.uint64), 1
    out = []
    for step in (1, 2, 4):
        have = have[:-step] | (have[step:] << np.uint64(8 * step))
    size = 8
    for wanted in sizes:
        while size < wanted:
            step = min(size, wanted - size)
            have = pair_hash(have[:-step], have[step:], step)
            size += step
        out.append(have)
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# White space that separates words: space, tab, line feed, vertical tab, form feed, return.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x5851F42D4C957F2D | 1


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of the texts, and where each text's words begin (and the last end)."""
    data = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    space = _SPACE[data]
    inside = np.concatenate(([False], ~space, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    power = np.full(len(data) + 1, _BASE, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    # Sum of byte times power, shifted back to the word's begin by the inverse power.
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)))
    inverse = np.full(len(data) + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    words = mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    bounds = np.searchsorted(begin, np.concatenate(([0], np.cumsum(sizes))))
    return words, bounds


def shingle_sets(texts: list[bytes], n: int = 5) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its runs of ``n`` words.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    words, bounds = word_hashes(texts)
    runs = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        runs = pair_hash(runs, words[i : i + len(runs)], i)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        else:
            short = np.full(min(1, b - a), b - a, np.uint64)
            for i in range(a, b):
                short = pair_hash(short, words[i : i + 1], 4)
            out.append(short)
    return out
