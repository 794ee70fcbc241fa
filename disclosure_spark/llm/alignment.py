"""Alignment of two tokenizers over the same bytes, by interval coalescing.

Each token of A (byte-level BPE) and of B (sentencepiece) is an interval of bytes. All of them
are sorted by start; where a start reaches the running maximum of the ends before it, both
sequences end, and a group breaks. Every A token of a group is linked to every B token of it.

Documents are tokenized once, in blocks of neighbouring ones. A block's row keeps what each of
its documents links, as numbers into the block's list of id pairs, and in how many of its
documents each pair is. So a pair, however frequent, is one row a block where blocks are counted
and where the counts of the corpus go back to them.
"""

from __future__ import annotations

import hashlib
import json
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import saved

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed value: how the vocabulary of A splits a text before merging.
A_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK = 1 << 20  # characters of text in a block; a longer text is a block of its own
PART = 1 << 17  # characters of a block that are aligned at a time
LONG = 100_000  # characters from which a text goes to the slower encoder, which has no limit to white space
LINKS = 1 << 21  # links expanded at a time
BIG = 1024  # links of a group from which its ids are counted instead
BLOCKS_PER_FILE = 16  # a block's row has a megabyte or more, and a file's rows may be in memory at once

DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
BLOCKS = f"block long, docs array<struct<{DOC}, idx array<int>, mult array<long>>>, pairs array<long>, df array<long>"


def load(a_file: str = A_FILE, b_file: str = B_FILE) -> tuple[bytes, bytes]:
    """Both files' content, read by the driver; tasks carry it with them."""
    with open(a_file, "rb") as a, open(b_file, "rb") as b:
        return a.read(), b.read()


def _byte_of() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return signs | {chr(256 + i): b for i, b in enumerate(others)}


class Encoders:
    """Both tokenizers, and the bytes and decimal texts of their ids.

    A's file lists its merges in the order of their ids, so merging by least id, as ``tiktoken`` does, gives the
    ids of the file's own library at a multiple of its speed. ``tests/llm`` compares both.
    """

    def __init__(self, model: tuple[bytes, bytes]):
        import sentencepiece
        import tiktoken

        parsed = json.loads(model[0])
        special = {x["content"] for x in parsed["added_tokens"]}
        of, vocabulary = _byte_of(), parsed["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = token.encode() if token in special else bytes(of[c] for c in token)
        ranks = {self.a_bytes[i]: i for token, i in vocabulary.items() if token not in special}
        self.fast = tiktoken.Encoding("a", pat_str=A_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.file, self.slow = model[0], None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model[1])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        # The decimal text of an id with the sign that follows it.
        self.texts = [f"{i}{sign}" for i in range(len(self.a_bytes)) for sign in ",|"]
        self.texts += [f"{i}{sign}" for i in range(len(self.b_bytes)) for sign in (",", ";", "")]

    def a_ids(self, text: str) -> list[int]:
        if len(text) < LONG:
            return self.fast(text)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_buffer(self.file)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids

    def both(self, text: str) -> tuple[list[int], list[int]]:
        """Ids by A and B; none if their bytes are not those of a space and the text."""
        if not text:
            return [], []
        spaced = " " + text
        a, b = self.a_ids(spaced), self.b.encode(text)
        whole = spaced.encode()
        same = all(b"".join(map(x.__getitem__, ids)) == whole for x, ids in ((self.a_bytes, a), (self.b_bytes, b)))
        return (a, b) if same else ([], [])


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """The group of every A token, then of every B token, from their lengths in bytes."""
    ends = [np.cumsum(x) for x in (a_sizes, b_sizes)]
    end = np.concatenate(ends)
    start = end - np.concatenate([a_sizes, b_sizes])
    kind = np.repeat([0, 1], [len(a_sizes), len(b_sizes)])
    order = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.concatenate(([False], start[order][1:] >= reach[:-1]))
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the sums of their counts."""
    flat, many = np.concatenate(keys), np.concatenate(counts)
    if not len(flat):
        return flat, many
    order = np.argsort(flat, kind="stable")
    flat, many = flat[order], many[order]
    first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    return flat[first], np.add.reduceat(many, first)


def links(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, doc: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (document, A id, B id), as one number each, and how often they are linked.

    ``ga``, ``gb``: the groups of the tokens, ascending; ``doc``: the document of each group; ``base``: number of B ids.
    """
    n = len(doc)
    na, nb = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    a0, b0 = np.cumsum(na) - na, np.cumsum(nb) - nb
    scale = np.int64(base) * (int(a.max(initial=0)) + 1)
    size = na * nb
    big = size > BIG
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for g in np.flatnonzero(big):
        one, ones = np.unique(a[a0[g] : a0[g] + na[g]], return_counts=True)
        two, twos = np.unique(b[b0[g] : b0[g] + nb[g]], return_counts=True)
        keys.append((doc[g] * scale + (one[:, None] * base + two[None, :])).ravel())
        counts.append((ones[:, None] * twos[None, :]).ravel())
    until = np.cumsum(np.where(big, 0, size))
    total = int(until[-1]) if n else 0
    cuts = np.unique(np.searchsorted(until, [*range(0, total, LINKS), total], side="left"))
    begin = 0
    for cut in cuts + 1:
        own = np.arange(begin, min(cut, n))[~big[begin:cut]]
        begin = cut
        if not len(own):
            continue
        left = np.repeat(a0[own], na[own]) + np.arange(na[own].sum()) - np.repeat(np.cumsum(na[own]) - na[own], na[own])
        times = np.repeat(nb[own], na[own])
        right = np.repeat(np.repeat(b0[own], na[own]), times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        where = np.repeat(doc[np.repeat(own, na[own])], times)
        found = np.unique(where * scale + np.repeat(a[left], times) * base + b[right], return_counts=True)
        keys.append(found[0])
        counts.append(found[1])
    flat, many = _added(keys, counts)
    # Back to the scale of all ids, whatever the greatest here was.
    return flat // scale, flat % scale, many


def aligned(texts: list[str], encoders: Encoders) -> tuple[list, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """n_a, n_b, n_groups, n_links and groups_sha256 of each text, and (text, pair, how often) of all links."""
    ids = [encoders.both(t) for t in texts]
    n_a, n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
    a, b = (np.fromiter(chain.from_iterable(x[k] for x in ids), np.int64, n.sum()) for k, n in ((0, n_a), (1, n_b)))
    group = coalesce(encoders.a_sizes[a], encoders.b_sizes[b])
    ga, gb = group[: len(a)], group[len(a) :]
    n = int(group.max()) + 1 if len(group) else 0
    doc = np.zeros(n, np.int64)
    doc[ga] = np.repeat(np.arange(len(texts)), n_a)  # every group has tokens of both
    n_groups = np.bincount(doc, minlength=len(texts))
    n_links = np.zeros(len(texts), np.int64)
    np.add.at(n_links, doc, np.bincount(ga, minlength=n) * np.bincount(gb, minlength=n))

    # Tokens group by group, A before B, each with the sign behind it.
    order = np.argsort(group, kind="stable")
    token, is_b, group = np.concatenate([a, b])[order], order >= len(a), group[order]
    last = np.concatenate((np.diff(group * 2 + is_b) != 0, [True])) if n else np.zeros(0, bool)
    final = np.concatenate((np.diff(doc[group]) != 0, [True])) if n else last
    place = np.where(is_b, token * 3 + last + final + 2 * len(encoders.a_bytes), token * 2 + last).tolist()
    bounds = np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
    digests = [
        hashlib.sha256("".join(map(encoders.texts.__getitem__, place[i:j])).encode()).hexdigest() if j > i else ""
        for i, j in zip(bounds[:-1], bounds[1:], strict=True)
    ]
    return [n_a, n_b, n_groups, n_links, digests], links(a, b, ga, gb, doc, len(encoders.b_bytes))


def block(texts: list[str], encoders: Encoders) -> dict:
    """What the texts of a block link: columns of documents, and the block's pairs."""
    parts, begin, size = [], 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= PART or i + 1 == len(texts):
            columns, (where, pair, mult) = aligned(texts[begin : i + 1], encoders)
            parts.append([*columns, where + begin, pair, mult])
            begin, size = i + 1, 0
    *columns, where, pair, mult = (np.concatenate(x) for x in zip(*parts, strict=True))
    pairs, idx = np.unique(pair, return_inverse=True)
    df = np.bincount(idx, minlength=len(pairs))
    ends = np.searchsorted(where, np.arange(len(texts) + 1))
    return {"docs": columns, "ends": ends, "idx": idx, "mult": mult, "pairs": pairs, "df": df}


def blocks(docs: DataFrame, model: tuple[bytes, bytes], chunk: int = CHUNK) -> DataFrame:
    """The blocks of all documents, see ``BLOCKS``."""

    def task(batches):
        from pyspark import TaskContext

        encoders, number = Encoders(model), TaskContext.get().partitionId() << 32
        for batch in batches:
            begin, size, texts = 0, 0, []
            for i in range(batch.num_rows):
                texts.append(batch.column(1)[i].as_py() or "")
                size += len(texts[-1])
                if size < chunk and i + 1 < batch.num_rows:
                    continue
                got = block(texts, encoders)
                offsets = pa.array(got["ends"], pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(got[k], t)) for k, t in (("idx", pa.int32()), ("mult", pa.int64()))]
                values = [batch.column(0).slice(begin, i + 1 - begin), *[pa.array(v, pa.int64()) for v in got["docs"][:4]], pa.array(got["docs"][4], pa.string()), *lists]
                names = [*(x.split()[0] for x in DOC.split(", ")), "idx", "mult"]
                row = [pa.array([number], pa.int64()), pa.StructArray.from_arrays(values, names=names), pa.array(got["pairs"], pa.int64()), pa.array(got["df"], pa.int64())]
                nested = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in row[1:]]
                yield pa.RecordBatch.from_arrays([row[0], *nested], names=["block", "docs", "pairs", "df"])
                number, begin, size, texts = number + 1, i + 1, 0, []

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(task, BLOCKS)


def align(docs: DataFrame, model: tuple[bytes, bytes], chunk: int = CHUNK) -> DataFrame:
    """The alignment of every document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Texts that are null or empty, or whose tokens' bytes are not those of a space and the text (such as those
    with U+2581), have no tokens: zeros and an empty digest. A pair's count is how many rows of the table link
    it, repeated rows each. An empty table gives an empty result. Other columns are not read.
    """
    stored = saved(blocks(docs, model, chunk), "alignment_blocks", max_rows=BLOCKS_PER_FILE)
    listed = stored.select("block", F.posexplode(F.arrays_zip("pairs", "df")).alias("pos", "p"))
    counts = listed.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.df").alias("n"))
    counts = saved(counts.withColumn("a", F.floor(F.col("pair") / F.lit(_b_size(model)))), "alignment_counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    # The count, and whether it is the highest of its A id, in one number.
    valued = counts.join(most, "a").select("pair", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")).alias("value"))
    wanted = stored.select("block", F.posexplode("pairs").alias("pos", "pair")).join(valued, "pair")
    back = wanted.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("values"))
    joined = stored.select("block", "docs").join(back, "block", "left")
    value = F.coalesce(F.col("values.value"), F.array().cast("array<long>"))
    total = lambda d, of: F.aggregate(F.zip_with(d["idx"], d["mult"], of), F.lit(0).cast("long"), lambda s, x: s + x)
    own = lambda i: F.get(F.col("own"), i)
    names = [x.split()[0] for x in DOC.split(", ")]

    def summed(d):
        best = total(d, lambda i, m: (own(i) % 2) * m)
        count = total(d, lambda i, m: F.shiftright(own(i), 1) * m)
        return F.struct(*[d[x].alias(x) for x in names[:5]], best.alias("n_best"), count.alias("count_sum"), d[names[5]].alias(names[5]))

    return joined.withColumn("own", value).select(F.explode(F.transform("docs", summed)).alias("d")).select("d.*")


def _b_size(model: tuple[bytes, bytes]) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model[1]).get_piece_size()
