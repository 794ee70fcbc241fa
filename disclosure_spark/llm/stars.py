"""Near-duplicate documents: one-permutation hashing, banded buckets, star-shaped candidates.

A document's set of shingles is hashed once. The first bits of a hash name its bin, the least
hash of a bin is its value, and an empty bin takes the value of a bin that is not, found by an order of its own
(optimal densification). Runs of bins make the keys of buckets.

Documents with equal sets are one class. In each bucket the class that meets most others over all
its buckets is the hub, and only it is compared with the rest: as many candidates as members. What the
stars connect needs no more. Members that are not connected with their hub may still be linked to another one,
so they are compared with all others of the bucket that they are not connected with, block by block, on whole sets. So no link
between classes that share a bucket is lost, whatever the size of the bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .forest import _groups, _overlaps
from .shared import arrow_batch, discard, pair_hash, saved, shingle_sets, signed

WORDS = 4
PERCENT = 80  # similarity of a link
BINS = 128
ROWS = 4  # bins of a band: of pairs at the threshold 1 in 2e7 shares none of the 32 buckets
BLOCK = 256  # members of a bucket or star in one cell

PRINTS = "doc_id long, print long, c1 long, c2 long, n long, keys array<long>"
CLASS = ["c1", "c2", "n"]


def lowered(text: str | None) -> bytes:
    """UTF-8 with A to Z in lower case, nothing else changed."""
    return (text or "").encode().lower()


def probes(bins: int) -> np.ndarray:
    """For every bin the order in which it looks for a bin that is not empty: all bins, by hash."""
    i = np.arange(bins, dtype=np.uint64)
    return np.argsort(pair_hash(np.repeat(i, bins), np.tile(i, bins), 1).reshape(bins, bins), axis=1, kind="stable")


def signatures(sets: list[np.ndarray], bins: int, order: np.ndarray) -> np.ndarray:
    """The value of every bin, of sets that are sorted and not empty. ``bins`` is a power of two."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bin_ = (flat >> np.uint64(65 - bins.bit_length())).astype(np.int64) if bins > 1 else np.zeros(len(flat), np.int64)
    place = owner * bins + bin_
    first = np.flatnonzero(np.diff(place, prepend=-1))
    out, filled = np.zeros((len(sets), bins), np.uint64), np.zeros((len(sets), bins), bool)
    out.ravel()[place[first]] = flat[first]
    filled.ravel()[place[first]] = True
    row, column = np.nonzero(~filled)
    for turn in range(bins):
        if not len(row):
            break
        lender = order[column, turn]
        found = filled[row, lender]
        out[row[found], column[found]] = out[row[found], lender[found]]
        row, column = row[~found], column[~found]
    return out


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """The bucket of every band of ``rows`` bins."""
    bands = values.shape[1] // rows
    keys = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], len(values), 0)
    for r in range(rows):
        keys = pair_hash(keys, values[:, r : bands * rows : rows], r)
    return keys


def prints(docs: DataFrame, words: int, bins: int, rows: int) -> DataFrame:
    """Of each row its set's identity (two sums of hashes, and the size) and its buckets; none without words."""
    order = probes(bins)

    def task(batches):
        for batch in batches:
            texts = [lowered(t) for t in batch.column(2).to_pylist()]
            for a, b in _groups(texts):
                sets = shingle_sets(texts[a:b], words)
                full = [i for i, s in enumerate(sets) if len(s)]
                many = np.array([len(s) for s in sets], np.uint64)
                c1, c2 = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
                keys = np.zeros((0, bins // rows), np.uint64)
                if full:
                    own = [sets[i] for i in full]
                    flat, begin = np.concatenate(own), np.cumsum([0, *map(len, own[:-1])])
                    c1[full] = np.add.reduceat(pair_hash(flat, flat), begin)
                    c2[full] = np.add.reduceat(pair_hash(flat, ~flat, 3), begin)
                    keys = band_keys(signatures(own, bins, order), rows)
                bounds = np.concatenate(([0], np.cumsum(np.where(many > 0, bins // rows, 0))))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(signed(np.ascontiguousarray(keys).ravel())))
                ids = (batch.column(i).slice(a, b - a) for i in (0, 1))
                yield arrow_batch(PRINTS, [*ids, pa.array(signed(c1)), pa.array(signed(c2)), pa.array(many.view(np.int64)), lists])

    return docs.mapInArrow(task, PRINTS)


def shingled(texts: DataFrame, words: int) -> DataFrame:
    """class, set (its sorted hashes) from class, text. Of equal rows a task keeps one; one more elsewhere does no harm."""

    def task(batches):
        seen = set()
        for batch in batches:
            rows = {c: i for i, c in enumerate(batch.column(0).to_pylist()) if c not in seen}
            seen.update(rows)
            own = [lowered(batch.column(1)[i].as_py()) for i in rows.values()]
            ids = list(rows)
            for a, b in _groups(own):
                packed = pa.array([s.tobytes() for s in shingle_sets(own[a:b], words)], pa.binary())
                yield arrow_batch("class long, set binary", [ids[a:b], packed])

    return texts.select("class", "text").mapInArrow(task, "class long, set binary")


def _may(n: Column, m: Column, percent: int) -> Column:
    """Whether sets of these sizes can be as similar as that."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _alike(common: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (n + m - common)


def stars(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The hub of each bucket (key, hub, hub_n), and the candidates (hub, class) of all stars, each once."""
    reach = saved(members.groupBy("class").agg(F.sum("size").alias("reach")), "stars_reach")
    ranked = members.join(reach, "class")
    best = F.max(F.struct("reach", "class", "n")).alias("best")
    hubs = saved(ranked.groupBy("key").agg(best).select("key", F.col("best.class").alias("hub"), F.col("best.n").alias("hub_n")), "stars_hubs")
    near = (F.col("class") != F.col("hub")) & _may(F.col("n"), F.col("hub_n"), percent)
    edges = saved(members.join(hubs, "key").filter(near).select("hub", "class").distinct(), "stars_edges")
    discard(reach)
    return hubs, edges


def _sorted_cells(rows: DataFrame, cell: list[str], then: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *cell).sortWithinPartitions(*cell, then)


def star_links(edges: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """class, parent: the candidates of stars that are links. A hub meets its members in blocks."""
    sizes = saved(edges.groupBy("hub").agg(F.ceil(F.count("*") / block).alias("blocks")), "stars_sizes")
    dealt = saved(edges.join(sizes, "hub").select("hub", F.pmod(F.xxhash64("class"), F.col("blocks")).alias("cell"), "class"), "stars_cells")
    hub_rows = dealt.select("hub", "cell").distinct().withColumn("class", F.col("hub"))
    both = dealt.withColumn("member", F.lit(True)).unionByName(hub_rows.withColumn("member", F.lit(False)))
    full = both.join(sets, "class").select("hub", "cell", "member", "class", "set")

    def verify(batches):
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True)
            found = []
            for at, member, class_, packed in rows:
                this = np.frombuffer(packed, np.uint64)
                if not member:  # it comes first in its cell
                    hub, own = at, this
                    continue
                assert hub == at
                place = np.minimum(np.searchsorted(own, this), len(own) - 1)
                common = int((own[place] == this).sum())
                if _alike(common, len(own), len(this), percent):
                    found.append((class_, hub))
            if found:
                yield arrow_batch("class long, parent long", list(zip(*found, strict=True)))

    return _sorted_cells(full, ["hub", "cell"], "member").mapInArrow(verify, "class long, parent long")


ROW = "key long, a long, b long, outer boolean, class long, n long, label long, out boolean, band int, keys array<long>"


def _cells(batches, width: int):
    """Whole cells (first three columns equal) of rows that come sorted by them."""
    held: list = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[:3] != held[-1][:3]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _open_pairs(cell: list, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a cell that are not connected and meet in this band first."""
    outer = np.array([r[3] for r in cell])
    left, right = np.flatnonzero(outer), np.flatnonzero(~outer)
    if not len(left) or not len(right):
        return left[:0], right[:0]
    class_, n, label, out = (np.array([r[k] for r in cell]) for k in (4, 5, 6, 7))
    keys, band = np.array([r[9] for r in cell]), cell[0][8]
    i, j = left[:, None], right[None, :]
    fits = (label[i] != label[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
    fits &= ~out[j] | (class_[i] < class_[j])  # two that are both outside come in both orders
    for t in range(band):
        fits &= keys[i, t] != keys[j, t]
    x, y = np.nonzero(fits)
    return left[x], right[y]


def open_links(members: DataFrame, hubs: DataFrame, labels: DataFrame, classes: DataFrame, with_sets, percent: int, block: int) -> DataFrame:
    """class, parent: links that the stars have not connected.

    In every bucket those that are not connected with its hub are compared with all others.
    """
    of_hub = hubs.join(labels.withColumnRenamed("class", "hub"), "hub", "left").select("key", "hub", F.coalesce("label", "hub").alias("hub_label"))
    of_hub = saved(of_hub, "stars_hub_labels")
    named = members.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    named = named.join(of_hub, "key").filter("class <> hub")  # the hub has been compared with all
    named = saved(named.select("key", "band", "class", "n", "label", (F.col("label") != F.col("hub_label")).alias("out")), "stars_named")
    sizes = named.groupBy("key").agg(F.count_if("out").alias("outside"), F.count("*").alias("all"))
    sizes = sizes.filter("outside > 0 AND all > 1").select(
        "key", F.ceil(F.col("outside") / block).alias("out_blocks"), F.ceil(F.col("all") / block).alias("all_blocks")
    )
    dealt = named.join(saved(sizes, "stars_open"), "key")
    own = lambda many: F.pmod(F.xxhash64("class", "key"), F.col(many))
    every = lambda many: F.explode(F.sequence(F.lit(0).cast("long"), F.col(many) - 1))
    rows = ["key", "a", "b", "outer", "class", "n", "label", "out", "band"]
    left = dealt.filter("out").withColumn("a", own("out_blocks")).withColumn("b", every("all_blocks")).withColumn("outer", F.lit(True))
    right = dealt.withColumn("b", own("all_blocks")).withColumn("a", every("out_blocks")).withColumn("outer", F.lit(False))
    placed = left.select(rows).unionByName(right.select(rows)).join(classes.select("class", "keys"), "class").select(*rows, "keys")

    def meet(batches):
        for cell in _cells(batches, 3):
            i, j = _open_pairs(cell, percent)
            if len(i):
                yield arrow_batch(MET, list(zip(*[cell[k][:9] for k in np.unique(np.concatenate([i, j]))], strict=True)))

    MET = ROW.rpartition(", ")[0]
    met = saved(_sorted_cells(placed, ["key", "a", "b"], "class").mapInArrow(meet, MET), "stars_met")
    sets = with_sets(met.select("class").distinct(), "stars_open_sets")
    full = met.join(classes.select("class", "keys"), "class").join(sets, "class").select(*rows, "keys", "set")

    def verify(batches):
        for cell in _cells(batches, 3):
            i, j = _open_pairs(cell, percent)
            if not len(i):
                continue
            own_sets = [np.frombuffer(r[10], np.uint64) for r in cell]
            sizes_ = np.array([len(s) for s in own_sets])
            alike = _alike(_overlaps(own_sets, i, j), sizes_[i], sizes_[j], percent)
            if alike.any():
                ids = np.array([r[4] for r in cell])
                yield arrow_batch("class long, parent long", [ids[i[alike]], ids[j[alike]]])

    return _sorted_cells(full, ["key", "a", "b"], "class").mapInArrow(verify, "class long, parent long")


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, words: int = WORDS, bins: int = BINS, rows: int = ROWS, block: int = BLOCK
) -> DataFrame:
    """Components of near duplicates: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 times the common shingles are ``percent`` times all of theirs or more, decided
    on whole sets (of 64-bit hashes). component_id is the least doc_id that is reachable over links. A text of fewer
    than ``words`` words has one shingle, all of them. Texts without words, also null or empty
    ones, have no shingle and are linked with nothing. Rows that repeat, or share a doc_id, are documents
    each; kept is whether doc_id is component_id, so rows that share the least id are all kept. A null doc_id
    is less than none; a component of only such rows has a null component_id. An empty table gives an empty result. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("print", F.xxhash64("text"))
    printed = saved(prints(texts.select("doc_id", "print", "text"), words, bins, rows), "stars_prints")
    first = F.min(F.struct("doc_id", "print")).alias("rep")
    classes = printed.filter("n > 0").groupBy(*CLASS).agg(first, F.min("doc_id").alias("least"), F.max("keys").alias("keys"))
    # Numbered and stored, so the numbers stay.
    classes = saved(classes.withColumn("class", F.monotonically_increasing_id()), "stars_classes")
    entries = classes.select("class", "n", F.posexplode("keys").alias("band", "key"))
    shared = saved(entries.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "stars_buckets")
    members = saved(entries.join(shared, "key"), "stars_members")
    discard(shared)
    hubs, edges = stars(members, percent)

    def with_sets(wanted: DataFrame, name: str) -> DataFrame:
        """The sets of these classes, made from the text of one document each."""
        own = wanted.join(classes, "class").select("class", "rep")
        return saved(shingled(own.join(texts.select(F.struct("doc_id", "print").alias("rep"), "text"), "rep"), words), name)

    sets = with_sets(edges.select("class").unionByName(edges.select(F.col("hub").alias("class"))).distinct(), "stars_sets")
    found = saved(star_links(edges, sets, percent, block), "stars_links")
    for old in (edges, sets):
        discard(old)
    labels = saved(components(found, "stars_components"), "stars_labels")
    more = saved(open_links(members, hubs, labels, classes, with_sets, percent, block), "stars_more")
    discard(members)
    discard(hubs)
    if not more.isEmpty():
        labels = saved(components(found.unionByName(more), "stars_components"), "stars_labels")
    own = classes.select(*CLASS, "least", "class").join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    of_label = saved(own.groupBy("label").agg(F.min("least").alias("component_id")), "stars_least")
    of_class = saved(own.join(of_label, "label").select(*CLASS, "component_id"), "stars_result")
    joined = printed.select("doc_id", *CLASS).join(of_class.withColumn("in_class", F.lit(True)), CLASS, "left")
    component = F.when(F.col("in_class"), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
