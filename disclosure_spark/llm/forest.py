"""Similarity join of texts by the Jaccard similarity of their runs of five words.

MinHash banding: each of 16 bands (called trees here) hashes so many minima into one key, and documents
that share a key are candidates. How many is computed once from threshold, bands and recall (4 for 0.8, 16 and
0.9995), not from the data: it is not an LSH forest, which would sort signatures and shorten prefixes by what it
meets. The threshold is fixed, so no shorter prefix is needed for the recall. All candidates are verified on
their whole shingle sets.

Documents with the same shingles are one class, which is joined once for all its copies. A pair is
verified in the first tree that has it. The documents under a prefix are dealt into blocks, and a task
compares two blocks, so that no group is in one task as a whole; it returns what it counted and a
spanning forest of its links, not the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import arrow_batch, discard, drop_shuffles, fresh, pair_hash, saved, shingle_sets, signed, single

THRESHOLD = 0.8
WORDS = 5
TREES = 16
LONGEST = 8  # values of a tree's signature
RECALL = 0.9995  # of pairs at the threshold
BLOCK = 256  # documents of a block under one prefix
CHUNK = 1 << 21  # bytes of text shingled at a time

PRINTS = "doc_id long, print long, class long, n long, keys array<long>"


def depth(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> int:
    """The longest prefix under which a pair at the threshold meets in some tree with the recall."""
    for d in range(LONGEST, 0, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    return 1


def _groups(texts: list[bytes]):
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def signatures(sets: list[np.ndarray], trees: int, length: int) -> np.ndarray:
    """For each (not empty) set the hash of each tree's prefix of so many minima."""
    flat = np.concatenate(sets)
    begin = np.cumsum([0, *map(len, sets[:-1])])
    out = np.zeros((len(sets), trees), np.uint64)
    seeds = pair_hash(np.arange(trees * length, dtype=np.uint64), np.full(trees * length, 99, np.uint64))
    for t in range(trees):
        prefix = np.full(len(sets), t, np.uint64)
        for s in seeds[t * length : (t + 1) * length]:
            prefix = pair_hash(prefix, np.minimum.reduceat((flat ^ s) * (s | np.uint64(1)), begin))
        out[:, t] = prefix
    return out


def prints(docs: DataFrame, trees: int, length: int) -> DataFrame:
    """Each document's class (a hash of its shingle set) and prefixes; no prefixes without words."""

    def task(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
            for a, b in _groups(texts):
                sets = shingle_sets(texts[a:b], WORDS)
                full = [i for i, s in enumerate(sets) if len(s)]
                keys = np.zeros((0, trees), np.uint64)
                classes, many = np.zeros(b - a, np.uint64), np.array([len(s) for s in sets], np.uint64)
                if full:
                    own = [sets[i] for i in full]
                    keys = signatures(own, trees, length)
                    begin = np.cumsum([0, *map(len, own[:-1])])
                    flat = np.concatenate(own)
                    sums = np.add.reduceat(pair_hash(flat, flat), begin)
                    classes[full] = pair_hash(sums, many[full])
                bounds = np.concatenate(([0], np.cumsum(np.where(many > 0, trees, 0))))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(signed(keys.ravel())))
                ids = (batch.column(i).slice(a, b - a) for i in (0, 1))
                yield arrow_batch(PRINTS, [*ids, pa.array(signed(classes)), pa.array(many.view(np.int64)), lists])

    return docs.selectExpr("doc_id", "print", "text").mapInArrow(task, PRINTS)


def _cells(members: DataFrame, block: int) -> DataFrame:
    """Members of each prefix (key, class, size of the group) dealt to the pairs of its blocks."""
    many = F.ceil(F.col("size") / block).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        members.withColumn("blocks", many)
        .withColumn("own", F.pmod(F.xxhash64("class", "key"), F.col("blocks")).cast("int"))
        .withColumn("other", other)
        .withColumn("one", F.least("own", "other"))
        .withColumn("two", F.greatest("own", "other"))
        .drop("size", "blocks", "other")
    )


def _by_cell(batches, weight: int):
    """Rows of whole cells, which come sorted by (key, one, two), several cells at a time."""
    held: list = []
    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size > weight and row[:3] != held[-1][:3]:
                yield held
                held, size = [], 0
            held.append(row)
            size += 1 + (len(row[-1]) if isinstance(row[-1], bytes) else 0) // 8
    if held:
        yield held


def _pairs(rows: list):
    """Cell by cell the rows and which pairs of them (places) meet in this cell first.

    Rows: key, one, two, own, tree, class, keys. In a cell of two blocks only pairs across count.
    """
    at = 0
    while at < len(rows):
        end = at + 1
        while end < len(rows) and rows[end][:3] == rows[at][:3]:
            end += 1
        cell, seen = [], set()
        for row in rows[at:end]:
            if row[5] not in seen:
                seen.add(row[5])
                cell.append(row)
        at = end
        if len(cell) < 2:
            continue
        keys = np.array([r[6] for r in cell])
        own = np.array([r[3] for r in cell])
        tree = cell[0][4]
        if cell[0][1] == cell[0][2]:
            left = right = np.arange(len(cell))
        else:
            left, right = np.flatnonzero(own == cell[0][1]), np.flatnonzero(own == cell[0][2])
        fits = np.ones((len(left), len(right)), bool)
        for t in range(tree):
            fits &= keys[left, t][:, None] != keys[right, t][None, :]
        i, j = np.nonzero(fits)
        i, j = left[i], right[j]
        if cell[0][1] == cell[0][2]:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield cell, i, j


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the common part of the sets of each pair."""
    used = np.unique(np.concatenate([i, j]))
    if len(i) <= 4 * len(used):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)])
    flat = np.concatenate([sets[a] for a in used])
    row = np.repeat(np.arange(len(used)), [len(sets[a]) for a in used])
    _, column, many = np.unique(flat, return_inverse=True, return_counts=True)
    shared = many > 1  # a shingle of one document is in no common part
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(used), len(used)), np.float32)
    step = 4096
    for first in range(0, int(shared.sum()), step):
        a, b = np.searchsorted(column, [first, first + step])
        part = np.zeros((len(used), step), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        common += part @ part.T
    where = np.zeros(used.max() + 1, np.int64)
    where[used] = np.arange(len(used))
    return common[where[i], where[j]].astype(np.int64)


MEMBERS = "key long, one int, two int, own int, tree int, class long, keys array<long>"
LINKS = "class long, links long, parent long"


def links(classes: DataFrame, texts: DataFrame, threshold: float, block: int) -> DataFrame:
    """For each class with links in a cell: how many documents it links to there, and a class of its tree there; a written table.

    ``classes``: class, rep (doc_id and print of one document), copies, keys. ``texts``: rep, text.
    """
    spark = classes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = classes.select("class", F.posexplode("keys").alias("tree", "key"))
    groups = entries.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = _cells(entries.join(groups, "key"), block).join(classes.select("class", "keys"), "class")
    names = [x.split()[0] for x in MEMBERS.split(", ")]
    spread = lambda df: df.repartition(n, "key", "one", "two").sortWithinPartitions("key", "one", "two", "class")

    def meet(batches):
        for rows in _by_cell(batches, 4096):
            out = [cell[k][:6] for cell, i, j in _pairs(rows) for k in np.unique(np.concatenate([i, j]))]
            if out:
                yield arrow_batch(MET, list(zip(*out, strict=True)))

    MET = MEMBERS.rpartition(", ")[0]
    met = saved(spread(members.select(names)).mapInArrow(meet, MET), "forest_met")
    drop_shuffles(spark)
    places = F.collect_list(F.struct("key", "one", "two", "own", "tree")).alias("places")
    wanted = met.groupBy("class").agg(places).join(classes.select("class", "rep", "copies", "keys"), "class")

    def with_sets(batches):
        for batch in batches:
            texts_ = [t.encode() for t in batch.column(1).to_pylist()]
            for a, b in _groups(texts_):
                packed = pa.array([s.tobytes() for s in shingle_sets(texts_[a:b], WORDS)], pa.binary())
                yield arrow_batch("class long, set binary", [batch.column(0).slice(a, b - a), packed])

    # Sets are made once per class; copies of one row give one more, which a task drops.
    sets = wanted.select("class", "rep").join(texts, "rep").select("class", "text").mapInArrow(with_sets, "class long, set binary")
    full = wanted.select("class", "copies", "keys", F.explode("places").alias("p")).select("p.*", "class", "keys", "copies")
    full = full.join(sets, "class").select(*names, "copies", "set")

    def verify(batches):
        for rows in _by_cell(batches, 1 << 20):
            for cell, i, j in _pairs(rows):
                sets_ = [np.frombuffer(r[8], np.uint64) for r in cell]
                sizes = np.array([len(s) for s in sets_])
                # A pair of too different sizes cannot reach the threshold.
                fits = np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j]) - 1e-9
                i, j = i[fits], j[fits]
                if not len(i):
                    continue
                common = _overlaps(sets_, i, j)
                alike = common >= threshold * (sizes[i] + sizes[j] - common) - 1e-9
                i, j = i[alike], j[alike]
                copies = np.array([r[7] for r in cell])
                count = np.bincount(i, copies[j], len(cell)) + np.bincount(j, copies[i], len(cell))
                root = list(range(len(cell)))

                def top(x: int, root: list = root) -> int:
                    while root[x] != x:
                        root[x] = root[root[x]]
                        x = root[x]
                    return x

                for x, y in zip(i.tolist(), j.tolist(), strict=True):
                    x, y = top(x), top(y)
                    root[max(x, y)] = min(x, y)
                has = np.flatnonzero(count)
                if len(has):
                    ids = [r[5] for r in cell]
                    yield arrow_batch(LINKS, [[ids[k] for k in has], count[has].astype(np.int64), [ids[top(int(k))] for k in has]])

    found = saved(spread(full).mapInArrow(verify, LINKS), "forest_links")
    discard(met)
    return found


def groups(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """doc_id, print (hash of the text), class_id, n_links and keeps of every row.

    ``keeps`` marks the rows of one (doc_id, print) in each group, the least. See ``join``.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("print", F.xxhash64("text"))
    rows = saved(prints(keyed, trees, depth(threshold, trees, recall)), "forest_prints")
    rep = F.struct("doc_id", "print").alias("rep")
    classes = rows.filter("n > 0").groupBy("class").agg(
        F.min(rep).alias("rep"), F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.max("keys").alias("keys")
    )
    classes = saved(classes, "forest_classes")
    found = links(classes, keyed.select(rep, "text"), threshold, block)
    drop_shuffles(docs.sparkSession)
    labels = saved(components(found, "forest_components"), "forest_labels")
    linked = found.groupBy("class").agg(F.sum("links").alias("links"))
    of_class = classes.drop("keys").join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    first = of_class.groupBy("label").agg(F.min("least").alias("class_id"), F.min("rep").alias("kept"))
    n_links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links")
    of_class = of_class.join(first, "label").join(linked, "class", "left").select("class", "class_id", "kept", n_links)
    result = saved(of_class, "forest_result")
    for old in (classes, found, labels):
        discard(old)
    joined = rows.select("doc_id", "print", F.when(F.col("n") > 0, F.col("class")).alias("class")).join(result, "class", "left")
    alone = F.col("class").isNull()
    return joined.select(
        "doc_id",
        "print",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | F.col("kept").eqNullSafe(rep)).alias("keeps"),
    )


def join(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Groups of near duplicates: doc_id, class_id, n_links.

    n_links counts the other documents (rows) of a similarity of ``threshold`` or more, copies included;
    class_id is the least doc_id of all that are connected by such links. Texts of fewer than
    five words have one shingle, all their words. Texts without words (also null) link to nothing and
    are each their own class. Rows that repeat link to each other. An empty table gives an empty result.
    """
    return groups(docs, threshold, trees, recall, block).select("doc_id", "class_id", "n_links")


def survivors(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, that of the least doc_id.

    Of rows equal in doc_id and text the one whose columns are least, as JSON, stays, in every run the
    same. Documents in no group stay, also those without words.
    """
    key = fresh(docs, "_rep")
    kept = groups(docs).filter("keeps").groupBy(F.struct("doc_id", "print").alias(key)).agg(F.count("*").alias("many"))
    kept = saved(kept, "forest_kept")
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"))
    return single(docs.withColumn(key, own), kept, key).select(docs.columns)
