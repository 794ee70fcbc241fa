"""Removal of repeated passages with a logarithmic family of suffix arrays.

A suffix array over every byte of a corpus would be many times its size. The arrays
here hold the suffixes at anchors: the least hash of 32 bytes in each window of 200 bytes
names the window's anchor, so equal windows have equal anchors at equal places, whatever
surrounds them. Suffixes are kept sorted by (anchor, context), where the context is
all that the windows of the anchor cover. An equal context means that all these windows
repeat; an equal anchor with another context means that some of them may.

New documents come in batches. A batch gets its own array, which is scanned against the levels
there are (a join of two sorted tables by anchor), and levels of equal size merge, so
that n batches are in about log2(n) tables. In the end the windows of those contexts that met
their anchor elsewhere are sorted themselves, which decides each byte exactly.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_batch, discard, drop_shuffles, pair_hash, saved, signed, sliding_min, window_hashes

LENGTH = 200  # bytes of a passage
GRAM = 32  # bytes that an anchor is chosen by
BATCHES = 2  # the query adds the documents in so many batches
CHUNK = 1 << 21  # bytes hashed at a time
HOT = 256  # contexts of one anchor that a task compares; more are dealt by their windows
_STEPS = LENGTH - GRAM + 1

# A document is told by a 64-bit hash of its id and text.
SUFFIXES = "anchor long, context long, doc long, start long, windows int"


def _pieces(texts: list[bytes], most: int = CHUNK):
    """Groups of (text, from, to) of about ``most`` bytes; of a longer text, parts that overlap by a window."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for a in range(0, max(len(text) - LENGTH + 1, 0), most):
            b = min(a + most + LENGTH - 1, len(text))
            if group and size + b - a > most:
                yield group
                group, size = [], 0
            group.append((i, a, b))
            size += b - a
    if group:
        yield group


def _hashed(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows inside the parts: place in the parts' concatenation, anchor, hash, and whether the
    anchor is at the window's begin; and where the parts begin."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    grams, windows = window_hashes(data, [GRAM, LENGTH])
    anchors = sliding_min(grams, _STEPS)
    sizes = np.array([len(p) for p in parts])
    begin = np.cumsum(sizes) - sizes
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.add.at(inside, begin + sizes - LENGTH + 1, -1)
    place = np.flatnonzero(np.cumsum(inside)[: len(windows)] > 0)
    anchors = anchors[place]
    return place, anchors, windows[place], grams[place] == anchors, begin


def _runs(place: np.ndarray, anchors: np.ndarray, at_begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the neighbouring windows that have the same anchor at the same place.

    Where the first bytes of a window are its anchor, the next window has another one, which may be equal.
    """
    new = np.append(True, (anchors[1:] != anchors[:-1]) | (place[1:] != place[:-1] + 1) | at_begin[:-1])
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(place)) - 1


def suffixes(docs: DataFrame) -> DataFrame:
    """The anchored suffixes of documents given as doc, text."""

    def task(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            for group in _pieces(texts):
                place, anchors, windows, at_begin, begin = _hashed([texts[i][a:b] for i, a, b in group])
                first, last = _runs(place, anchors, at_begin)
                part = np.searchsorted(begin, place[first], "right") - 1
                own = np.array([i for i, _, _ in group])[part]
                start = place[first] - begin[part] + np.array([a for _, a, _ in group])[part]
                many = last - first + 1
                context = pair_hash(pair_hash(windows[first], windows[last]), many.astype(np.uint64), 1)
                columns = [signed(anchors[first]), signed(context), ids[own], start, many.astype(np.int32)]
                yield arrow_batch(SUFFIXES, [pa.array(c) for c in columns])

    return docs.select("doc", "text").mapInArrow(task, SUFFIXES)


class SuffixFamily:
    """Levels of sorted suffix tables, in the shared folder."""

    def __init__(self, spark):
        self.spark = spark
        self.levels: list[tuple[int, DataFrame]] = []  # how many batches each holds, largest first
        self.met: DataFrame | None = None  # anchors with more than one context

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        """One row per (anchor, context) with how many suffixes have it, in that order."""
        merged = rows.groupBy("anchor", "context").agg(F.sum("many").alias("many"))
        return saved(merged.sortWithinPartitions("anchor", "context"), "suffix_array")

    def add(self, batch: DataFrame) -> None:
        """Scan the suffixes of a batch against all levels, then add them as the newest level."""
        array = self._merged(batch.select("anchor", "context", F.lit(1).cast("long").alias("many")))
        drop_shuffles(self.spark)
        tagged = array.select("anchor", "context", F.lit(True).alias("new"))
        for _, level in self.levels:
            tagged = tagged.unionByName(level.select("anchor", "context", F.lit(False).alias("new")))
        matches = tagged.groupBy("anchor").agg(F.min("context").alias("a"), F.max("context").alias("b"), F.max("new").alias("new"))
        matches = saved(matches.filter("a <> b AND new").select("anchor"), "suffix_matches")
        self.met = matches if self.met is None else self.met.unionByName(matches)
        drop_shuffles(self.spark)
        size = 1
        while self.levels and self.levels[-1][0] == size:
            _, level = self.levels.pop()
            both = array, level
            array = self._merged(array.unionByName(level))
            for old in both:
                discard(old)
            size *= 2
        self.levels.append((size, array))
        drop_shuffles(self.spark)

    def contexts(self) -> DataFrame:
        """All levels as one."""
        rows = [level for _, level in self.levels]
        return self._merged(reduce(DataFrame.unionByName, rows)) if len(rows) > 1 else rows[0]


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys (rows of a structured array) stand more than once."""
    order = np.argsort(keys)
    found = keys[order]
    same = found[1:] == found[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


SPANS = "doc long, start long, windows int"


def _spans(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and length of the runs of consecutive numbers."""
    new = np.append(True, windows[1:] != windows[:-1] + 1) if len(windows) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return windows[first], np.diff(np.append(first, len(windows)))


def _compared(rows: DataFrame) -> DataFrame:
    """Windows that repeat among contexts of one anchor, as spans. Contexts that are known to repeat only lend their windows."""

    def spans(rows: list) -> pa.RecordBatch:
        place, _, windows, _, begin = _hashed([r[4] for r in rows])
        part = np.searchsorted(begin, place, "right") - 1
        anchor = np.array([r[0] for r in rows])[part]
        # The dense suffix array of these contexts, sorted by the windows' hashes.
        twice = _repeated(np.rec.fromarrays([windows, anchor]))
        single = np.array([r[1] == 1 for r in rows])[part]
        first, many = _spans(place[twice & single])
        at = np.searchsorted(begin, first, "right") - 1
        start = np.array([r[3] for r in rows])[at] + first - begin[at]
        docs = np.array([r[2] for r in rows])[at]
        return arrow_batch(SPANS, [pa.array(c) for c in (docs, start, many.astype(np.int32))])

    def task(batches):
        held: list = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Rows come by anchor; whole anchors are compared, several at a time.
                if size > CHUNK // 4 and row[0] != held[-1][0]:
                    yield spans(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield spans(held)

    columns = ["anchor", "many", "doc", "start", "bytes"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(*columns).repartition(n, "anchor").sortWithinPartitions("anchor").mapInArrow(task, SPANS)


PACKED = "kind int, bucket int, data binary"
_SEEN, _MARK = 0, 1  # kinds: a window to be compared, a window that repeats
_SEEN_TYPE = np.dtype([("key", "<u8"), ("doc", "<i8"), ("start", "<i8"), ("state", "<i8")])
_MARK_TYPE = np.dtype([("doc", "<i8"), ("start", "<i8")])
_SINGLE, _LENT = 0, 1  # states: the window is to be marked if it repeats; it only lends


def _dealt(rows: DataFrame) -> DataFrame:
    """The same for anchors of very many contexts: windows are dealt to buckets by their hash.

    Windows travel packed, many to a row. A task sends a window that it has several times only
    once, and marks its own ones at once, so that no bucket gets a window more often than there are tasks.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 8 * n

    def packed(kind: int, values: np.ndarray, by: str) -> pa.RecordBatch:
        bucket = (values[by].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        values, bucket = values[order], bucket[order]
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, int)
        data = [x.tobytes() for x in np.split(values, first[1:])] if len(first) else []
        return arrow_batch(PACKED, [[kind] * len(first), bucket[first].tolist(), data])

    def settled(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows that repeat among these and are to be marked; one of each key for others to meet."""
        seen = seen[np.argsort(seen["key"], kind="stable")]
        new = np.append(True, seen["key"][1:] != seen["key"][:-1])
        group = np.cumsum(new) - 1
        many = np.bincount(group)
        twice = (many > 1)[group]
        marks = seen[twice & (seen["state"] == _SINGLE)]
        one = seen[new].copy()
        one["state"][many > 1] = _LENT
        return marks[["doc", "start"]].astype(_MARK_TYPE), one

    def windows(held: list) -> tuple[np.ndarray, np.ndarray]:
        place, _, hashes, _, begin = _hashed([r[4] for r in held])
        part = np.searchsorted(begin, place, "right") - 1
        seen = np.zeros(len(place), _SEEN_TYPE)
        seen["key"] = pair_hash(hashes, np.array([r[0] for r in held]).view(np.uint64)[part])
        seen["doc"] = np.array([r[2] for r in held])[part]
        seen["start"] = np.array([r[3] for r in held])[part] + place - begin[part]
        seen["state"] = np.where(np.array([r[1] for r in held])[part] == 1, _SINGLE, _LENT)
        return settled(seen)

    def deal(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[4])
                if size > CHUNK:
                    marks, one = windows(held)
                    yield packed(_MARK, marks, "doc")
                    yield packed(_SEEN, one, "key")
                    held, size = [], 0
        if held:
            marks, one = windows(held)
            yield packed(_MARK, marks, "doc")
            yield packed(_SEEN, one, "key")

    def by_bucket(batches, kind: np.dtype):
        last, held = None, []
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != last and held:
                    yield np.concatenate(held)
                    held = []
                last = bucket
                held.append(np.frombuffer(data, kind))
        if held:
            yield np.concatenate(held)

    def compare(batches):
        for seen in by_bucket(batches, _SEEN_TYPE):
            yield packed(_MARK, settled(seen)[0], "doc")

    def gather(batches):
        for marks in by_bucket(batches, _MARK_TYPE):
            marks = np.sort(marks)
            new = np.append(True, (marks["doc"][1:] != marks["doc"][:-1]) | (marks["start"][1:] > marks["start"][:-1] + 1))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(marks)) - 1
            begin = marks["start"][first]
            many = (marks["start"][last] - begin + 1).astype(np.int32)
            yield arrow_batch(SPANS, [pa.array(c) for c in (marks["doc"][first], begin, many)])

    dealt = saved(rows.select("anchor", "many", "doc", "start", "bytes").mapInArrow(deal, PACKED), "suffix_windows")
    spread = lambda df: df.select("bucket", "data").repartition(n, "bucket").sortWithinPartitions("bucket")
    compared = spread(dealt.filter(F.col("kind") == _SEEN)).mapInArrow(compare, PACKED)
    marks = dealt.filter(F.col("kind") == _MARK).unionByName(compared)
    return spread(marks).mapInArrow(gather, SPANS)


CUTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove(docs: DataFrame, batches: int = BATCHES, keep: bool = True) -> DataFrame:
    """Remove each byte that lies in a string of 200 bytes which starts anywhere else as well.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``keep``, the bytes that are left.
    Strings are those of the UTF-8 texts as they came in; a null text is empty and loses
    nothing, as does any text of fewer than 200 bytes. Rows that are equal repeat each other.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("doc", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))
    part = F.pmod(F.xxhash64("doc", F.lit("batch")), F.lit(batches)).cast("int")
    table = saved(suffixes(keyed).withColumn("batch", part), "suffixes", partition_by="batch")
    family = SuffixFamily(spark)
    for i in range(batches):
        family.add(table.filter(F.col("batch") == i).drop("batch"))
    contexts = family.contexts()

    # Contexts that stand more than once, and those that met their anchor in another context.
    groups = contexts.join(family.met.distinct(), "anchor", "left_semi").groupBy("anchor").agg(F.count("*").alias("group"))
    chosen = contexts.join(groups, "anchor", "left").filter("many > 1 OR group IS NOT NULL")
    found = table.drop("batch").join(saved(chosen, "suffix_chosen"), ["anchor", "context"])
    found = saved(found, "suffix_found")
    for old in (table, contexts):
        discard(old)
    drop_shuffles(spark)

    # Of the second kind one suffix each is compared, window by window, with its bytes.
    place = F.struct("doc", "start", "windows")
    met = found.filter("group IS NOT NULL")
    lent = met.filter("many > 1").groupBy("anchor", "context", "many", "group").agg(F.min(place).alias("place"))
    open_ = met.filter("many = 1").withColumn("place", place).select(lent.columns).unionByName(lent)
    entry = F.struct("anchor", "many", "place.start", "place.windows", "group")
    wanted = open_.groupBy(F.col("place.doc").alias("doc")).agg(F.collect_list(entry).alias("contexts"))
    cut = F.transform(
        "contexts",
        lambda c: F.struct(
            c["anchor"].alias("anchor"),
            c["many"].alias("many"),
            c["start"].alias("start"),
            c["group"].alias("group"),
            F.substring(F.col("raw"), (c["start"] + 1).cast("int"), c["windows"] + LENGTH - 1).alias("bytes"),
        ),
    )
    own = keyed.select("doc", "text").join(wanted, "doc")
    own = own.withColumn("raw", F.col("text").cast("binary")).select("doc", F.explode(cut).alias("c")).select("doc", "c.*")
    # Rows of equal id and text give the same suffix several times over; those all stand more than once.
    own = saved(own.withColumn("hot", F.col("group") > HOT), "suffix_bytes", partition_by="hot")
    drop_shuffles(spark)
    single = _compared(own.filter("not hot")).unionByName(_dealt(own.filter("hot")))

    # All windows that repeat: every one of a context that stands more than once, and those found one by one.
    spans = found.filter("many > 1").select("doc", "start", "windows").unionByName(single)
    packed = (F.shiftleft("start", 32) + F.col("windows")).alias("span")
    marks = saved(spans.select("doc", packed).groupBy("doc").agg(F.collect_set("span").alias("spans")), "suffix_spans")
    drop_shuffles(spark)

    def task(batches):
        for batch in batches:
            out: list[list] = [[] for _ in CUTS.split(", ")]
            lists = batch.column(2)
            for i, text in enumerate(batch.column(1).to_pylist()):
                data, spans = text.encode(), lists[i].values
                kept, removed, many = data, 0, 0
                if spans is not None:
                    numbers = spans.to_numpy(zero_copy_only=False)
                    start, windows = numbers >> 32, numbers & 0xFFFFFFFF
                    covered = np.zeros(len(data) + 1, np.int32)
                    np.add.at(covered, start, 1)
                    np.add.at(covered, start + windows + LENGTH - 1, -1)
                    gone = np.cumsum(covered[:-1]) > 0
                    removed = int(gone.sum())
                    many = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                row = (batch.column(0)[i].as_py(), len(data), removed, many, hashlib.sha256(kept).hexdigest(), kept if keep else None)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield arrow_batch(CUTS, out)

    done = keyed.join(marks, "doc", "left").select("doc_id", "text", "spans").mapInArrow(task, CUTS)
    return done if keep else done.drop("kept")
