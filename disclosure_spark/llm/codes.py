"""Vector codes by product quantisation, with codebooks fitted by ball k-means.

Vectors are cut into parts; each part position has a codebook. An entry and the parts
assigned to it are a ball, whose radius is the distance of its farthest part. With
D(i, j) the distance of entries i and j and d(x, i) that of part and entry:

- entry j is a neighbour of ball i only if D(i, j) <= 2 radius(i);
- a ball that did not move and has no neighbour that moved is stable: all its parts stay;
- a part with d(x, i) less than half the distance of the nearest neighbour is in the
  stable core: it stays;
- else the part lies in the ring between half the distances of the m-th and the next
  neighbour, and only the first m neighbours are compared exactly.

All of it is decided on squared distances of integers (D <= 2 d is D^2 <= 4 d^2), so nothing depends
on rounding. The assignment and distance of every part are kept in a table that each
round rewrites; only sums per entry, as many as the codebooks have numbers, reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, saved

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
SAFE = 1 << 22  # up to this size of components squared distances are exact in doubles
RING = 512  # parts of neighbouring rings that are compared at once
FEW = 200_000  # labels up to which their totals are broadcast


def integers(table: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """vec_id, label and integer components x of the rows that take part."""
    x = F.col(vector_column)
    bad = lambda c: c.isNull() | F.isnan(c) | c.isin(float("inf"), float("-inf"))
    whole = lambda c: F.floor(c.cast("double") * SCALE)
    fits = lambda c: F.abs(c.cast("double") * SCALE) < float(2**62)
    refused = F.raise_error(F.concat(F.lit("a component is too large for a long, vector "), F.coalesce(F.col(id_column).cast("string"), F.lit("null"))))
    return table.filter(x.isNotNull() & ~F.exists(x, bad)).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).alias("label"),
        F.when(F.forall(x, fits), F.transform(x, whole)).otherwise(refused.cast("array<long>")).alias("x"),
    )


def _distances(x: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Squared distances of rows and entries, exact: doubles below 2^53 or Python integers."""
    return (x * x).sum(1)[:, None] - 2 * (x @ books.T) + (books * books).sum(1)[None, :]


def _nearest(gaps: np.ndarray) -> np.ndarray:
    return np.argmin(gaps, axis=1)  # of equal ones the first


def assign(x: np.ndarray, book: np.ndarray, old: np.ndarray | None, gap: np.ndarray | None, moved: np.ndarray, work: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each part's nearest entry and its squared distance.

    ``old``, ``gap``: the entry and distance of the round before (None at first), ``moved``: which entries
    have changed since. ``work``, if given, adds up the exact distances that were computed.
    """
    n = len(x)
    if old is None:
        gaps = _distances(x, book)
        code = _nearest(gaps)
        if work is not None:
            work[0] += gaps.size
        return code, gaps[np.arange(n), code]
    code, best = old.copy(), gap.copy()
    between = _distances(book, book)
    order = np.argsort(old, kind="stable")
    starts = np.flatnonzero(np.diff(old[order], prepend=-1))
    for rows in np.split(order, starts[1:]) if n else []:
        i = old[rows[0]]
        if moved[i]:
            best[rows] = ((x[rows] - book[i]) ** 2).sum(1)
            if work is not None:
                work[0] += len(rows)
        near = np.flatnonzero(between[i] <= 4 * best[rows].max())
        near = near[near != i]
        if not len(near) or not (moved[i] or moved[near].any()):
            continue  # a ball alone, or stable with all its neighbours
        near = near[np.argsort(between[i][near], kind="stable")]
        ring = np.searchsorted(between[i][near], 4 * best[rows], side="right")
        outer = np.flatnonzero(ring)  # the others are in the stable core
        outer = outer[np.argsort(ring[outer], kind="stable")]
        for a in range(0, len(outer), RING):
            some = outer[a : a + RING]
            # Candidates in the order of their numbers, so that ties go to the lower one.
            among = np.sort(np.append(near[: ring[some[-1]]], i))
            gaps = _distances(x[rows[some]], book[among])
            if work is not None:
                work[0] += gaps.size
            first = _nearest(gaps)
            code[rows[some]] = among[first]
            best[rows[some]] = gaps[np.arange(len(some)), first]
    return code, best


def _kind(wide: bool) -> type:
    return object if wide else np.float64


def _round(rows: DataFrame, books: np.ndarray, moved: np.ndarray, wide: bool, first: bool) -> DataFrame:
    """``rows`` with new codes and gaps. ``books``: part, entry, position."""
    parts, _, width = books.shape
    schema = "vec_id long, label string, has_label boolean, x array<long>, code array<int>, gap array<long>"

    def task(batches):
        for batch in batches:
            n = batch.num_rows
            x = np.zeros((n, parts * width), np.int64)
            lists = batch.column(3)
            sizes = np.diff(lists.offsets.to_numpy())
            inside = np.arange(x.shape[1])[None, :] < sizes[:, None]  # shorter vectors end in zeros
            x[inside] = lists.flatten().to_numpy()
            x = x.astype(_kind(wide))
            code, gap = np.zeros((n, parts), np.int32), np.zeros((n, parts), np.int64)
            for p in range(parts):
                own = x[:, p * width : (p + 1) * width]
                old, past = (None, None) if first else (c.flatten().to_numpy().reshape(n, parts)[:, p] for c in batch.columns[4:6])
                found, best = assign(own, books[p].astype(_kind(wide)), old, None if first else past.astype(_kind(wide)), moved[p])
                if wide and n and max(best) >= 1 << 63:
                    raise OverflowError("a squared distance is too large for a long")
                code[:, p], gap[:, p] = found, best.astype(np.int64)
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * parts)
            lists = [pa.ListArray.from_arrays(ends, pa.array(v.ravel())) for v in (code, gap)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *lists], names=["vec_id", "label", "has_label", "x", "code", "gap"])

    return rows.mapInArrow(task, schema)


def _moved_books(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry replaced by the floor of its parts' mean; an unused one stays."""
    parts, _, width = books.shape
    # The sums are decimals, which no count of longs overflows.
    at = lambda i: F.coalesce(F.get("x", F.col("part") * width + i), F.lit(0)).cast("decimal(20,0)")
    sums = (
        rows.select("x", F.posexplode("code").alias("part", "entry"))
        .groupBy("part", "entry")
        .agg(F.count("*").alias("n"), *[F.sum(at(i)).alias(f"s{i}") for i in range(width)])
    )
    new = books.copy()
    for part, entry, n, *total in sums.collect():  # at most parts times entries
        new[part, entry] = [int(s) // n for s in total]
    return new


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(
    table: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The code of every vector: vec_id, code, error, label_error, codebooks_sha256.

    Vectors that are null or hold null or non-finite components are dropped. The codebooks start as the parts of
    the least vec_ids (of a repeated id the lesser vector first, a null id last), fewer if there are not
    so many rows. Vectors shorter than the longest, or than a multiple of ``parts``, count as filled up with
    zeros; empty vectors are all zeros. Rows that repeat are coded each. label_error adds up over
    equal labels, nulls together. An empty table, or one without a usable vector, gives an empty
    result. Components are exact up to 2^62 / 1024; larger ones and distances too large for a long
    raise an error. ``entries`` may be 256 at most, as a code has two digits a part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two digits has 1 to 256 entries")
    own = integers(table, id_column, vector_column, label_column)
    rows = saved(own.select("vec_id", F.col("label").cast("string").alias("label"), F.col("label").isNotNull().alias("has_label"), "x"), "codes_rows")
    size = F.max(F.size("x")).alias("longest")
    most = F.max(F.coalesce(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x"))), F.lit(0))).alias("most")
    seen = rows.agg(size, most).first()
    width = max(1, -(-(seen["longest"] or 0) // parts))
    wide = (seen["most"] or 0) > min(SAFE, int((2**51 / width) ** 0.5))
    start = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()
    columns = "vec_id", "code", "error", "label_error", "codebooks_sha256"
    if not start:
        empty = rows.select("vec_id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in columns[2:4]], F.lit("").alias(columns[4]))
        return empty.filter("false")
    books = np.zeros((parts, len(start), width), object if wide else np.int64)
    for e, row in enumerate(start):
        flat = list(row["x"]) + [0] * (parts * width - len(row["x"]))
        books[:, e] = np.array(flat, books.dtype).reshape(parts, width)
    moved = np.ones(books.shape[:2], bool)
    for turn in range(rounds + 1):
        last = turn == rounds
        coded = saved(_round(rows, books, moved, wide, turn == 0), "codes_round")
        discard(rows)
        rows = coded
        if not last:
            new = _moved_books(rows, books)
            moved, books = (new != books).any(2), new
    hexed = lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")
    done = rows.select(
        "vec_id",
        "label",
        "has_label",
        F.array_join(F.transform("code", hexed), "").alias("code"),
        F.aggregate("gap", F.lit(0).cast("long"), lambda s, g: s + g).alias("error"),
    )
    totals = saved(done.groupBy("has_label", F.coalesce("label", F.lit("")).alias("own")).agg(F.sum("error").alias("label_error")), "codes_totals")
    totals = totals.withColumnRenamed("has_label", "has")
    if totals.count() <= FEW:
        totals = F.broadcast(totals)
    joined = done.join(totals, (F.col("has_label") == F.col("has")) & (F.coalesce("label", F.lit("")) == F.col("own")))
    return joined.withColumn(columns[4], F.lit(books_digest(books))).select(*columns)
