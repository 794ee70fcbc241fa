"""One-permutation MinHash fingerprints, in DataFrame functions only.

Every shingle of five words is hashed once. The hash names a bin and a value, and
a bin keeps its least value. An empty bin borrows from a bin that is not empty, found
by probing in an order of its own (optimal densification). The low eight bits
of each bin are stored, and likeness is corrected for bits that agree by chance.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .shared import discard, saved

BINS = 256
BITS = 8
PROBES = 8  # before an empty bin looks at all bins that are not empty
WORDS = 5
RANGES = 8  # of keys to a shuffle partition, so that a hash deals them evenly
SAMPLE = 20  # keys for each range that the driver sorts
MOST_SAMPLED = 1_000_000  # of them in all; beyond, ranges are less even
SPACE = r"[\x20\x09-\x0D]+"
_VALUE = 56  # bits below the bin's number
_NO_VALUE = (1 << _VALUE) - 1
_PER_LONG = 64 // BITS
_HALF = BINS // 2


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the packed bins as array<bigint>, empty for a text without words (or null).

    A text of fewer than five words has one shingle, all of its words. What is
    read inside a lambda is a column made in a step before, computed once per row.
    """
    w, n, g, h, v, b, d = (f"_{out}_{x}" for x in "wnghvbd")
    none = F.slice(F.array(F.lit(0).cast("bigint")), 1, 0)
    # An entry for each bin, greater than any hash in it, so that every bin has a first.
    last = F.array(*[F.lit(((i - _HALF) << _VALUE) | _NO_VALUE) for i in range(BINS)])
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")
    bin_of = lambda x: F.shiftright(x, _VALUE)
    missing = lambda x: x.bitwiseAND(F.lit(_NO_VALUE)) == _NO_VALUE

    def joined(x: str, y: str, apart: int) -> Column:
        """Hashes of the entries of ``x`` with those of ``y`` so many places on; the last ones lack a partner."""
        later = F.slice(F.col(y), F.lit(apart + 1), F.size(y))
        return F.zip_with(x, later, lambda p, q: F.xxhash64(p, q))

    def borrowed(i: Column) -> Column:
        def probe(k: int) -> Column:
            return F.get(F.col(v), F.xxhash64(i, F.lit(k)).bitwiseAND(F.lit(BINS - 1)).cast("int"))

        nearest = F.transform(F.col(b), lambda x: F.struct(F.xxhash64(i, bin_of(x)).alias("o"), x.alias("x")))
        return F.coalesce(*[probe(k) for k in range(PROBES)], F.array_min(nearest)["x"])

    def packed(k: Column) -> Column:
        """One long of the low bits of the bins from ``k`` on."""
        bits = F.get(F.col(d), k)
        for j in range(1, _PER_LONG):
            bits = bits.bitwiseOR(F.shiftleft(F.get(F.col(d), k + j), BITS * j))
        return bits

    low = lambda x: x.bitwiseAND(F.lit((1 << BITS) - 1))
    starts = F.sequence(F.lit(0), F.lit(BINS - 1), F.lit(_PER_LONG))
    runs = F.slice(joined(h, g, WORDS - 1), F.lit(1), F.greatest(F.col(n) - WORDS + 1, F.lit(0)))
    return (
        df.withColumn(w, words)
        .withColumn(n, F.size(w))
        # Hashes of words, of two words, of four, and of five: every entry is hashed with few others.
        .withColumn(g, F.transform(w, lambda x: F.xxhash64(x)))
        .withColumn(h, joined(g, g, 1))
        .withColumn(h, joined(h, h, 2))
        .withColumn(
            h,
            F.when(F.col(n) == 0, none).when(F.col(n) < WORDS, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(runs),
        )
        .drop(w, g)
        .withColumn(h, F.sort_array(F.concat(h, last)))
        # The first of every bin, null in a bin without a shingle.
        .withColumn(v, F.filter(h, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col(h), i - 1)))))
        .drop(h)
        .withColumn(v, F.transform(v, lambda x: F.when(~missing(x), x)))
        .withColumn(b, F.array_compact(v))
        .withColumn(
            d,
            F.when(F.col(n) == 0, none)
            .when(F.size(b) == BINS, F.transform(v, low))
            .otherwise(F.transform(v, lambda x, i: low(F.coalesce(x, borrowed(i))))),
        )
        .drop(v, b)
        .withColumn(out, F.when(F.col(n) == 0, none).otherwise(F.transform(starts, packed)))
        .drop(n, d)
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1. Two texts without words are alike, one is not like another."""

    def equal(x: Column, y: Column) -> Column:
        """Bytes in which two longs agree: no bit of the exclusive or is set."""
        z = x.bitwiseXOR(y)
        for shift in (4, 2, 1):
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
        return _PER_LONG - F.bit_count(z.bitwiseAND(F.lit(0x0101010101010101)))

    agree = F.aggregate(F.zip_with(a, b, equal), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    corrected = (agree / float(BINS) - chance) / (1 - chance)
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), corrected)))
    )


def as_text(packed: Column) -> Column:
    """Two hexadecimal digits a bin."""
    return F.lower(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def boundaries(keys: DataFrame, ranges: int, sample: int = SAMPLE) -> list[tuple[int, int]]:
    """The least key of each of at most so many ranges of about as many keys (k1, k2); the first is the least of all.

    ``keys`` has no key twice. A sample by hash, about ``sample`` keys for each range and ``MOST_SAMPLED`` in
    all, is sorted by the driver. It decides how even the ranges are, not what is found.
    """
    seen = keys.agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2")).alias("least")).first()
    if not seen["n"]:
        return []
    share = min(1.0, min(ranges * sample, MOST_SAMPLED) / seen["n"])
    chosen = F.pmod(F.xxhash64("k2", "k1"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)) + 1)
    own = sorted(tuple(r) for r in keys.filter(chosen).select("k1", "k2").collect())
    cuts = {own[i * len(own) // ranges] for i in range(1, ranges)} if own else set()
    return sorted(cuts | {tuple(seen["least"])})


def with_range(rows: DataFrame, cuts: list[tuple[int, int]]) -> DataFrame:
    """Adds the number of the row's range: that of the last boundary not above (k1, k2).

    Boundaries are looked up in two steps, a list of every so many of them and then the list in between,
    which is broadcast: all of them together are 16 bytes a range.
    """
    if not cuts:
        return rows.withColumn("range", F.lit(0))
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    pairs = "array<struct<k1: bigint, k2: bigint>>"
    heads = F.from_json(F.lit(json.dumps([{"k1": g[0][0], "k2": g[0][1]} for g in groups])), pairs)
    listed = [{"_group": i, "_cuts": [{"k1": a, "k2": b} for a, b in g]} for i, g in enumerate(groups)]
    inner = _local(rows, listed, f"_group: int, _cuts: {pairs}")
    below = lambda own: F.size(F.filter(own, lambda b: b <= F.struct("k1", "k2"))) - 1
    grouped = rows.withColumn("_group", below(heads)).join(F.broadcast(inner), "_group")
    return grouped.withColumn("range", F.col("_group") * step + below(F.col("_cuts"))).drop("_group", "_cuts")


def _local(like: DataFrame, rows: list[dict], fields: str) -> DataFrame:
    """A few rows of the driver as a DataFrame, made in the JVM."""
    listed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{fields}>>")
    return like.sparkSession.range(1).select(F.inline(listed))


def neighbours(docs: DataFrame, ranges: int | None = None) -> tuple[DataFrame, WindowSpec]:
    """Every distinct document once (k1, k2, doc_id, text, copies, inner, ghost, range) and the order of its range.

    Documents are dealt to ranges of their keys and shuffled once, by range. The first of each range is also the last
    of the range before, as a ghost (that of the first range in the last one), so inside a range
    each one's next is a window away. A document of several equal rows is two: ``inner`` stands for the copies
    that are followed by another copy.
    """
    spark = docs.sparkSession
    ranges = ranges or RANGES * max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = docs.withColumn("k1", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("k2", F.xxhash64(F.col("doc_id").isNull(), "text"))
    keys = saved(keyed.groupBy("k1", "k2").agg(F.count("*").alias("copies")), "print_keys")
    cuts = boundaries(keys, ranges)
    repeated = saved(keys.filter("copies > 1"), "print_repeated")
    discard(keys)
    one = keyed.withColumn("copies", F.lit(1).cast("long"))
    if not repeated.isEmpty():
        # Copies are merged before anything is shuffled; all others are as they are.
        several = keyed.join(repeated.select("k1", "k2"), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.max("doc_id").alias("doc_id"), F.max("text").alias("text"))
        several = several.join(repeated, ["k1", "k2"])
        one = one.join(repeated.select("k1", "k2"), ["k1", "k2"], "left_anti").unionByName(several)
    ghosts = [{"k1": a, "k2": b, "before": (i - 1) % len(cuts)} for i, (a, b) in enumerate(cuts)]
    ghosts = _local(docs, ghosts, "k1: bigint, k2: bigint, before: int")
    # One row a range: its size is bounded by the number of ranges.
    placed = with_range(one, cuts).join(F.broadcast(ghosts), ["k1", "k2"], "left")
    spots = F.array(F.struct(F.lit(False).alias("ghost"), F.col("range")))
    also = F.array(F.struct(F.lit(True).alias("ghost"), F.col("before").alias("range")))
    spots = F.when(F.col("before").isNull(), spots).otherwise(F.concat(spots, also))
    dealt = placed.withColumn("spot", F.explode(spots)).select("k1", "k2", "doc_id", "text", "copies", "spot.*").repartition("range")
    order = Window.partitionBy("range").orderBy("ghost", "k1", "k2")
    followed = dealt.withColumn("following", F.lead("text").over(order))
    kinds = F.when((F.col("copies") > 1) & ~F.col("ghost"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))
    split = followed.withColumn("inner", F.explode(kinds)).withColumn("last", ~F.col("inner"))
    split = split.withColumn("following", F.when(F.col("inner"), F.col("text")).otherwise(F.col("following")))
    return split, Window.partitionBy("range").orderBy("ghost", "k1", "k2", "last")


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. A null text is empty. Rows stand in the order of doc_id
    (null first), then of the text's digest; equal rows are one after another.
    A single document follows itself. An empty table gives an empty result.
    The texts are shuffled once, into ``ranges`` ranges (by default so many to each shuffle partition).
    """
    rows, order = neighbours(docs, ranges)
    rows = rows.withColumn("n_chars", F.char_length("text")).withColumn("lent", F.floor(F.col("n_chars") / 4).cast("int"))
    head = F.substring("following", F.lit(1), F.col("lent"))
    # A ghost only lends its own fingerprint.
    edited = F.when(~F.col("ghost"), F.concat(F.substring("text", F.lit(1), F.col("n_chars") - F.col("lent")), head))
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    both = with_fingerprint(with_fingerprint(rows, "text", "own"), "edited", "other")
    kept = ["range", "ghost", "k1", "k2", "last", "doc_id", "inner", "copies", "n_chars", "edited_sha256", "own", "other"]
    done = both.select(kept).withColumn("next_own", F.lead("own").over(order)).filter(~F.col("ghost"))
    times = F.when(F.col("inner"), F.col("copies") - 1).otherwise(F.lit(1))
    return (
        done.withColumn("near_edited", likeness(F.col("own"), F.col("other")))
        .withColumn("near_next", likeness(F.col("own"), F.col("next_own")))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), times)))
        .select(
            "doc_id",
            F.col("n_chars").cast("long").alias("n_chars"),
            "edited_sha256",
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("other")).alias("edited_fingerprint"),
            "near_edited",
            "near_next",
        )
    )
