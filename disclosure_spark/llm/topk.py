"""Exact top-k by inner product, by aggregation of sorted lists without random access.

Candidates are dealt to blocks. In a block each dimension is a list of the candidates in the order of what they
add to a query's score, sorted once for all queries: from the greatest component for a query's positive ones, from the least
for its negative ones. The lists are read in step. What has been read gives a candidate a lower
bound, what may still come an upper one: below a component that has been read, nothing greater is left in its
list. So for a depth of reading both bounds of all candidates and queries are products of the queries with the
components cut off at that depth. Reading stops when few candidates can still reach the k-th best lower bound,
and these are then resolved exactly.

All queries first meet one block, a random one as blocks are dealt by hash. The k-th best score found
there is a floor that every other block shares: a block whose greatest possible score is below it is not read, and in the
others reading stops earlier.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import arrow_batch, discard, saved

K = 10
EVERY = 100  # ids divisible by it are queries
SCALE = 1024
BLOCK = 8192  # candidates of a block
QUERIES = 2048  # queries of a block
DEPTHS = (0.25, 0.5, 0.7)  # of the lists, where bounds are compared
SETTLED = 0.08  # share of candidates left at which reading stops
SLICE = 128  # queries whose bounds are held at a time

PACKED = "block long, ids binary, sizes binary, copies binary, data binary, cuts binary"
FOUND = "q long, pos int, query_id long, times long, vec_id long, copies long, score long"


def vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and integer components; without vectors that are null, empty of id, or hold a null or non-finite component."""
    x = F.col(vector_column)
    bad = lambda c: c.isNull() | F.isnan(c) | c.isin(float("inf"), float("-inf"))
    fits = lambda c: F.abs(c.cast("double") * SCALE) < float(2**62)
    refused = F.raise_error(F.concat(F.lit("a component is too large for a long, vector "), F.col(id_column).cast("string")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE))
    return table.filter(x.isNotNull() & F.col(id_column).isNotNull() & ~F.exists(x, bad)).select(
        F.col(id_column).cast("long").alias("id"), F.when(F.forall(x, fits), whole).otherwise(refused.cast("array<long>")).alias("x")
    )


@dataclass
class Block:
    """Rows of a block: ids, lengths, how often each row is there, components; the cuts of each depth."""

    ids: np.ndarray
    sizes: np.ndarray
    copies: np.ndarray
    data: np.ndarray
    cuts: np.ndarray

    @staticmethod
    def of(ids: bytes, sizes: bytes, copies: bytes, data: bytes, cuts: bytes) -> Block:
        n = len(ids) // 8
        dims = len(data) // (8 * n)
        read = lambda b: np.frombuffer(b, np.int64)
        return Block(read(ids), read(sizes), read(copies), read(data).reshape(n, dims), read(cuts).reshape(len(DEPTHS) + 1, 2, dims))

    def widened(self, width: int) -> Block:
        more = width - self.data.shape[1]
        return Block(self.ids, self.sizes, self.copies, np.pad(self.data, ((0, 0), (0, more))), np.pad(self.cuts, ((0, 0), (0, 0), (0, more))))


def cuts_of(data: np.ndarray) -> np.ndarray:
    """For no depth and each of DEPTHS: the greatest and the least component that has not been read, by dimension."""
    lists, n = np.sort(data, axis=0), len(data)
    at = [0, *(min(int(d * n), n - 1) for d in DEPTHS)]
    return np.array([[lists[n - 1 - t], lists[t]] for t in at])


def packed(rows: DataFrame, size: int, many: int) -> DataFrame:
    """Rows (id, x, copies) in blocks of about ``size``, dealt by a hash of id and x: one row a block."""
    n = max(1, min(many, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "x"), F.lit(many)))
    dealt = dealt.repartitionById(n, F.pmod("block", F.lit(n)).cast("int")).sortWithinPartitions("block", "id").select("block", "id", "x", "copies")

    def close(block: int, ids: list, parts: list, copies: list) -> pa.RecordBatch:
        sizes = np.array([len(p) for p in parts], np.int64)
        data = np.zeros((len(parts), sizes.max()), np.int64)
        data[np.arange(data.shape[1])[None, :] < sizes[:, None]] = np.concatenate(parts)
        arrays = [np.array(ids, np.int64), sizes, np.array(copies, np.int64), data, cuts_of(data)]
        return arrow_batch(PACKED, [[block], *([a.tobytes()] for a in arrays)])

    def task(batches):
        at, held = None, ([], [], [])
        for batch in batches:
            blocks, ids, lists, copies = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            edges = np.flatnonzero(np.diff(blocks, prepend=blocks[0] - 1)) if len(blocks) else []
            for a, b in zip(edges, [*edges[1:], len(blocks)], strict=True):
                if held[0] and blocks[a] != at:
                    yield close(at, *held)
                    held = ([], [], [])
                at = int(blocks[a])
                for kept, new in zip(held, (ids, lists, copies), strict=True):
                    kept.extend(new[a:b])
        if held[0]:
            yield close(at, *held)

    return dealt.mapInArrow(task, PACKED)


def candidates(block: Block, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int, read: list) -> np.ndarray:
    """Which rows of the block may be among the ``k`` best of each query; all that are, are.

    ``own`` marks rows that are no candidates of a query. ``floor``: scores that are known to be reached. ``read``: for no depth and
    each of DEPTHS the matrices of ``_read``. All values are whole numbers that doubles hold exactly.
    """
    n = len(block.ids)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    left = ~own
    if n <= k:
        return left
    most = up @ block.cuts[0, 0] + down @ block.cuts[0, 1]
    left[most < floor] = False  # the block has nothing for these
    active, floor = np.flatnonzero(most >= floor), floor.copy()
    for high, low, known_high, known_low in read:
        if not len(active):
            break
        upper = up[active] @ high.T + down[active] @ low.T
        lower = up[active] @ known_high.T + down[active] @ known_low.T
        lower[own[active]] = -np.inf
        floor[active] = np.maximum(floor[active], np.partition(lower, n - k, axis=1)[:, n - k])
        may = (upper >= floor[active][:, None]) & ~own[active]
        left[active] = may
        active = active[may.sum(1) > max(4 * k, SETTLED * n)]
    return left


def _read(block: Block) -> Iterator[tuple[np.ndarray, ...]]:
    """For each depth what is known of the components: at most, at least; for lists from the greatest and from the least."""
    x = block.data.astype(np.float64)
    (most, least), *cuts = block.cuts
    for high, low in cuts:
        yield np.maximum(x, high), np.minimum(x, low), np.where(x >= high, x, least), np.where(x <= low, x, most)


def _exact(a: np.ndarray, b: np.ndarray, small: bool) -> np.ndarray:
    """Inner products of rows, as longs or Python integers."""
    if small:
        return np.einsum("ij,ij->i", a, b)
    return (a.astype(object) * b.astype(object)).sum(1)


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each query, ties to the smaller id."""
    if scores.dtype == object:
        order = np.array(sorted(range(len(query)), key=lambda i: (query[i], -scores[i], ids[i])), np.int64)
    else:
        order = np.lexsort((ids, -scores, query))
    own = query[order]
    first = np.searchsorted(own, own, side="left")
    return order[np.arange(len(order)) - first < k]


def search(block: Block, queries: Block, floors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Place of the query, place of the row, copies that count and score: at most ``k`` rows a query."""
    width = max(block.data.shape[1], queries.data.shape[1])
    block, queries = block.widened(width), queries.widened(width)
    size = lambda m: max(int(m.max(initial=0)), -int(m.min(initial=0)))
    # Doubles hold small scores exactly; else all rows are resolved, in Python's integers.
    small = size(block.data) * size(queries.data) * max(width, 1) < 2**53
    read = list(_read(block)) if small else []
    for a in range(0, len(queries.ids), SLICE if small else 8):
        b = min(a + (SLICE if small else 8), len(queries.ids))
        q = queries.data[a:b]
        i, j = np.nonzero(queries.ids[a:b, None] == block.ids[None, :])
        same = (queries.sizes[a:b][i] == block.sizes[j]) & (q[i] == block.data[j]).all(1)
        i, j = i[same], j[same]
        # The query itself is no candidate, but its copies are.
        own = np.zeros((b - a, len(block.ids)), bool)
        own[i, j] = block.copies[j] == 1
        left = candidates(block, q.astype(np.float64), own, floors[a:b], k, read) if small else ~own
        at, row = np.nonzero(left)
        scores = np.concatenate([_exact(block.data[row[s : s + 65536]], q[at[s : s + 65536]], small) for s in range(0, max(len(row), 1), 65536)])
        best = _best(at, block.ids[row], scores, k)
        at, row, scores = at[best], row[best], scores[best]
        copies = block.copies[row] - (own_pairs(at, row, i, j, len(block.ids)))
        yield a + at, row, copies, scores


def own_pairs(at: np.ndarray, row: np.ndarray, i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """1 where (at, row) is one of the pairs (i, j), else 0."""
    return np.isin(at * n + row, i * n + j).astype(np.int64)


def _met(cells: DataFrame, many: int, k: int) -> DataFrame:
    """What the cells find. A cell has a row of candidates and one of queries; ``many`` cells."""
    n = max(1, min(many, 4 * int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = cells.repartitionById(n, F.pmod("cell", F.lit(n)).cast("int")).sortWithinPartitions("cell", "asks")

    def task(batches):
        held, at = None, None
        for batch in batches:
            names = batch.schema.names
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = dict(zip(names, values, strict=True))
                own = Block.of(*(row[c] for c in ("ids", "sizes", "copies", "data", "cuts")))
                if not row["asks"]:
                    held, at = own, row["cell"]
                    continue
                if at != row["cell"]:
                    continue  # there are no candidates in this block
                floors = np.full(len(own.ids), -np.inf)
                for f in row["floors"] or []:
                    floors[f["pos"]] = f["floor"]
                for pos, place, copies, scores in search(held, own, floors, k):
                    if len(scores) and max(map(abs, (scores.max(), scores.min()))) >= 1 << 63:
                        raise OverflowError("a score among the best is too large for a long")
                    n_ = len(pos)
                    yield arrow_batch(FOUND, [np.full(n_, row["q"]), pos.astype(np.int32), own.ids[pos], own.copies[pos], held.ids[place], copies, scores.astype(np.int64)])

    return dealt.mapInArrow(task, FOUND)


def top_k(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = K, every: int = EVERY, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """The ``k`` best candidates of each query: query_id, rank, vec_id, score.

    Candidates are all rows but the query row itself; ties go to the smaller id. Vectors that
    are null or hold null or non-finite components take no part, shorter ones count as
    filled up with zeros. Rows that repeat an id are candidates each, also of one another, and a query
    per row, each with ranks of its own; equal rows are merged, searched once and their result repeated. An empty table
    gives an empty result. Scores are compared exactly whatever their size. A component of 2^62 / 1024 or
    more, and a score that is reported but too large for a long, raise an error.
    """
    rows = vectors(table, id_column, vector_column)
    total, asking = rows.agg(F.count("*"), F.count_if(F.pmod("id", F.lit(every)) == 0)).first()
    b_many, q_many = max(1, -(-total // block)), max(1, -(-asking // queries))
    merged = rows.groupBy("id", "x").agg(F.count("*").alias("copies"))
    stored = saved(packed(merged, block, b_many), "topk_blocks")
    asked = saved(packed(merged.filter(F.pmod("id", F.lit(every)) == 0), queries, q_many), "topk_queries")

    def cells(asked: DataFrame, first: int, last: int) -> DataFrame:
        """Every block of queries with the blocks of candidates from ``first`` to ``last``."""
        number = (F.col("q") * (last - first + 1) + F.col("b") - first).alias("cell")
        floors = "array<struct<pos: int, floor: bigint>>"
        names = ["ids", "sizes", "copies", "data", "cuts"]
        span = lambda a, b: F.explode(F.sequence(F.lit(a).cast("long"), F.lit(b).cast("long")))
        left = stored.filter(F.col("block").between(first, last)).withColumnRenamed("block", "b").withColumn("q", span(0, q_many - 1))
        right = asked.withColumnRenamed("block", "q").withColumn("b", span(first, last))
        left = left.select(number, "q", F.lit(False).alias("asks"), *names, F.lit(None).cast(floors).alias("floors"))
        return left.unionByName(right.select(number, "q", F.lit(True).alias("asks"), *names, F.col("floors").cast(floors)))

    none = F.lit(None).cast("array<struct<pos: int, floor: bigint>>")
    found = saved(_met(cells(asked.withColumn("floors", none), 0, 0), q_many, k), "topk_found")
    if b_many > 1:
        reached = found.groupBy("q", "pos").agg(F.min("score").alias("floor"), F.count("*").alias("n")).filter(F.col("n") >= k)
        floors = reached.groupBy("q").agg(F.collect_list(F.struct("pos", "floor")).alias("floors"))
        again = asked.join(floors.withColumnRenamed("q", "block"), "block", "left")
        found = found.unionByName(_met(cells(again, 1, b_many - 1), q_many * (b_many - 1), k))
    found = saved(found, "topk_found")
    for old in (stored, asked):
        discard(old)
    best = Window.partitionBy("q", "pos").orderBy(F.desc("score"), "vec_id")
    # Of equal rows no more than k can be among the best.
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k)))))
    ranked = each.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    repeated = ranked.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return repeated.select("query_id", "rank", "vec_id", "score")
