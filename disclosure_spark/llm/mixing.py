"""Mixing sources to target weights, by Sainte-Laguë apportionment of equal blocks.

All of it is DataFrame functions. Sources get integer quotas of blocks, sources
deal them on to shards in proportion to the shards' sizes, and in each shard a
seeded selection takes so many blocks of the documents in seeded order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import fresh, saved, single

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE_NUM, SHARE_DEN = 3, 2  # the mix takes 3/2 of all words
MOST = 2  # times that a document may be taken
BLOCK = 16  # words in a block
SHARD_WORDS = 16_384
MOST_SHARDS = 4096  # of a source; its shards are larger beyond that
SEED = "mix-1"


def _seeded(*parts: Column) -> Column:
    """A number below 2**60 from a digest, the same in every engine and run."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _div(a: Column, b: Column) -> Column:
    """Integer division."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def _salt(seed: str) -> Column:
    return _seeded(F.lit(seed), F.col("doc_id"), F.col("text"))


def sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Words of each document, and the number that orders it."""
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _salt(seed).alias("salt"),
    )


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: its place, size and target.

    ``SHARE`` of all words is shared by weight; a target stops at ``MOST``
    times the source's size, and what is over goes to the others by weight.
    In the order of 2 size / weight, the sources before the first that its share
    does not fill are those that stop.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    fill = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(fill), F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.col("place") - 1, F.lit(len(WEIGHTS))) + 1)
    left = F.col("all_size") * SHARE_NUM / SHARE_DEN - before("most")
    return (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(place))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * MOST)
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("all_size", F.sum("source_size").over(whole))
        .withColumn("left", left)
        .withColumn("left_weight", F.sum("weight").over(whole) - before("weight"))
        .withColumn("stops", F.col("left") * F.col("weight") / F.col("left_weight") > F.col("most"))
        .withColumn("first", F.min(F.when(~F.col("stops"), F.struct("ratio", "place", "left", "left_weight"))).over(whole))
        .withColumn("filled", F.struct("ratio", "place") < F.struct("first.ratio", "first.place"))
        .withColumn(
            "target",
            F.when(F.col("filled"), F.col("most").cast("double")).otherwise(
                F.col("first.left") * F.col("weight") / F.col("first.left_weight")
            ),
        )
        .select("source", "place", "source_size", "target")
    )


def apportion(rows: DataFrame, group: list[str], weight: str, seats: Column, order: list[str], name: str) -> DataFrame:
    """Deal the seats of each group out by the highest quotients weight / (2 seats + 1).

    All quotients of at least half of the divisor weight / seats make up the
    rounded share; from there, the seats that are short are those with the next
    quotients, and the seats too many those with the lowest.
    """
    whole = Window.partitionBy(*group)
    rows = (
        rows.withColumn("_seats", seats)
        .withColumn("_all", F.sum(F.col(weight).cast("double")).over(whole))
        .withColumn(
            "_own",
            F.when(F.col("_all") > 0, F.floor(F.col(weight) * F.col("_seats") / F.col("_all") + 0.5)).otherwise(0).cast("long"),
        )
        .withColumn("_short", F.col("_seats") - F.sum("_own").over(whole))
    )
    change = F.abs("_short").cast("int")
    # The seats whose turn may come: beyond the own ones, or the last of them.
    seat = F.when(F.col("_short") > 0, F.col("_own") + F.col("_step") - 1).otherwise(F.col("_own") - F.col("_step"))
    ranked = Window.partitionBy(*group).orderBy(
        F.when(F.col("_short") > 0, -F.col("_quotient")).otherwise(F.col("_quotient")), *order
    )
    changed = (
        rows.filter((F.col("_short") != 0) & (F.col(weight) > 0))
        .withColumn("_step", F.explode(F.sequence(F.lit(1), change)))
        .withColumn("_seat", seat)
        .filter("_seat >= 0")
        .withColumn("_quotient", F.col(weight) / (2 * F.col("_seat") + 1))
        .withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= F.abs("_short"))
        .groupBy(*group, *order)
        .agg(F.sum(F.signum("_short")).cast("long").alias("_change"))
    )
    return (
        rows.join(changed, [*group, *order], "left")
        .withColumn(name, F.col("_own") + F.coalesce("_change", F.lit(0)))
        .drop("_seats", "_all", "_own", "_short", "_change")
    )


def with_shares(docs: DataFrame, seed: str = SEED, block: int = BLOCK, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Words that the mix takes of each document, and the document's ``salt``. See ``mix``.

    Documents of a shard stand in seeded order and are cut into blocks of
    ``block`` words, a last part joining the block before. Of ``n`` blocks, ``q`` are
    chosen at even distance from a seeded start; where ``q`` is more than
    ``n``, some or all come twice.
    """
    sized = saved(sizes(docs, seed), "mix_sizes")
    shared = saved(targets(sized).withColumn("one", F.lit(1)), "mix_targets")
    seats = F.round(F.sum("target").over(Window.partitionBy("one")) / block).cast("long")
    sources = apportion(shared, ["one"], "target", seats, ["place"], "quota").drop("one")
    shards = F.greatest(F.lit(1), F.least(F.lit(MOST_SHARDS), F.ceil(F.col("source_size") / shard_words)))
    sources = saved(sources.withColumn("shards", shards.cast("long")), "mix_quotas")
    same = sized["source"].eqNullSafe(sources["source"])
    placed = sized.join(sources, same).select(
        "doc_id", "size", "salt", "source_size", "target", "place", "quota", F.pmod("salt", "shards").alias("shard")
    )
    cells = placed.groupBy("place", "shard").agg(F.sum("size").alias("words"), F.max("quota").alias("quota"))
    cells = (
        apportion(cells, ["place"], "words", F.col("quota"), ["shard"], "chosen")
        .withColumn("blocks", F.greatest(F.lit(1), F.floor(F.col("words") / block)).cast("long"))
        .withColumn("chosen", F.least("chosen", MOST * F.col("blocks")))
        .withColumn("start", F.pmod(_seeded(F.lit(seed), F.col("place"), F.col("shard")), F.col("blocks")))
        .select("place", "shard", "blocks", "chosen", "start")
    )
    cells = saved(cells, "mix_cells")
    line = Window.partitionBy("place", "shard").orderBy("salt", "doc_id", "size")
    ended = placed.withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    ended = ended.join(cells, ["place", "shard"])
    def chosen(i: Column) -> Column:
        """Blocks chosen before block ``i``."""
        return _div(i * F.col("chosen") + F.col("start"), F.col("blocks"))

    def up_to(word: Column) -> Column:
        """Words taken before a word of the shard."""
        i = F.least(_div(word, F.lit(block)), F.col("blocks") - 1)
        return block * chosen(i) + (word - i * block) * (chosen(i + 1) - chosen(i))

    taken = up_to(F.col("end")) - up_to(F.col("end") - F.col("size"))
    return ended.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "salt")


def mix(docs: DataFrame, seed: str = SEED, block: int = BLOCK, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Words that the mix takes of each document: doc_id, size, source_size, target, taken.

    A source has a shard for every ``SHARD_WORDS`` of its words, ``MOST_SHARDS`` at most: beyond 67 million words its shards
    grow, each of which is ordered by one task, which spills; at 100 times that a shard has 1.6 million words.

    A null text has no words, a null source comes last, documents without words
    give none. Rows that are equal are taken like any others; their shares are
    the same in each run as a bag. An empty table gives an empty result.
    """
    return with_shares(docs, seed, block, shard_words).drop("salt")


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` as the mix has them: each row none, one or two times.

    A document comes as often as its share of words says; a fraction is rounded by the
    document's salt. Documents without words stay as they are. Of rows equal in doc_id and text the one whose columns
    are least, as JSON, comes for all of them.
    """
    part = F.col("taken") / F.col("size") + F.pmod("salt", F.lit(1 << 20)) / float(1 << 20)
    times = F.when(F.col("size") == 0, 1).otherwise(F.floor(part)).cast("int")
    # Rows of equal id and text are one here, with the times of all of them.
    key, many = fresh(docs, "_key"), fresh(docs, "_times")
    shares = with_shares(docs, seed).select(F.struct("doc_id", "salt").alias(key), times.alias("times"))
    shares = shares.groupBy(key).agg(F.sum("times").cast("int").alias(many), F.count("*").alias("many")).filter(F.col(many) > 0)
    own = F.struct(F.col("doc_id"), _salt(seed).alias("salt"))
    once = single(docs.withColumn(key, own), saved(shares, "mix_shares"), key)
    return once.withColumn(key, F.explode(F.sequence(F.lit(1), F.col(many)))).select(docs.columns)
