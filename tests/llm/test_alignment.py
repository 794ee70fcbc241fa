"""Alignment of tokenizers against the libraries and a naive grouping."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from disclosure_spark.llm import alignment
from disclosure_spark.llm.shared import saved

R = random.Random(12)
WORDS = "the quick brown fox über naïve 中文 😀 don't  it's 1234 3.14 <|endoftext|> <s> \n\n \t x=y+z; Ünïcödé ﷽ ๒๓".split(" ")
ODD = [None, "", " ", "▁x", "a▁", "\x00", " lead", "trail ", "a" * 700, "=" * 900, " " * 5000 + "y", "  ", "é" * 30, "<0x41>"]


@pytest.fixture(scope="module")
def model():
    return alignment.load()


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_buffer(model[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=model[1])


def naive(texts, library):
    """Rows of (n_a, n_b, n_groups, n_links, n_best, count_sum, sha) for a list of texts, pair by pair."""
    a, b = library
    of = alignment._byte_of()
    rows, where = [], defaultdict(set)
    for k, t in enumerate(texts):
        if not t:
            rows.append(None)
            continue
        ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        ba = [bytes(of[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ib for p in [b.id_to_piece(i)]]
        if not b"".join(ba) == b"".join(bb) == (" " + t).encode():
            rows.append(None)
            continue
        ends = [np.cumsum([len(x) for x in xs]) for xs in (ba, bb)]
        cuts = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        groups = [([], []) for _ in cuts]
        for side, ids in ((0, ia), (1, ib)):
            for i, e in zip(ids, ends[side].tolist()):
                groups[next(g for g, c in enumerate(cuts) if c >= e) if len(cuts) < 50 else int(np.searchsorted(cuts, e))][side].append(i)
        pairs = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        for p in pairs:
            where[p].add(k)
        sha = hashlib.sha256(";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups).encode()).hexdigest()
        rows.append((len(ia), len(ib), len(groups), pairs, sha))
    most = defaultdict(int)
    for p, docs in where.items():
        most[p[0]] = max(most[p[0]], len(docs))
    for row in rows:
        if row is None:
            yield (0, 0, 0, 0, 0, 0, "")
        else:
            n_a, n_b, n_groups, pairs, sha = row
            best = sum(m for p, m in pairs.items() if len(where[p]) == most[p[0]])
            yield n_a, n_b, n_groups, sum(pairs.values()), best, sum(m * len(where[p]) for p, m in pairs.items()), sha


@pytest.mark.parametrize("chunk, big", [(1 << 20, 1024), (300, 3)])
def test_align(spark, sf_dir, model, library, monkeypatch, chunk, big):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()] + ODD
    texts += ["".join(R.choice(WORDS) + R.choice(["", " ", "  "]) for _ in range(R.randrange(1, 60))) for _ in range(80)] + [texts[0], texts[0]]
    ids = [None if i == 7 else i // 2 for i in range(len(texts))]
    rows = [(i, "x", 1, t) for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows, "doc_id int, block string, pair int, text string").repartition(3)
    monkeypatch.setattr(alignment, "LINKS", 500 if big == 3 else 1 << 21)
    monkeypatch.setattr(alignment, "BIG", big)
    monkeypatch.setattr(alignment, "PART", 90 if big == 3 else 1 << 17)
    got = alignment.align(docs, model, chunk)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected = Counter((i, *row) for i, row in zip(ids, naive(texts, library), strict=True))
    assert Counter(tuple(r) for r in got.select(names).collect()) == expected
    assert alignment.align(docs.limit(0), model).collect() == []


def test_few_blocks_a_file(spark, model, monkeypatch):
    """However many blocks a task makes, no file of them has many, as all of a file's rows may be in memory at once."""
    made = []
    monkeypatch.setattr(alignment, "saved", lambda df, name, **how: made.append((name, saved(df, name, **how))) or made[-1][1])
    texts = [f"text number {i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert alignment.align(docs, model, chunk=1).count() == 60
    blocks = next(df for name, df in made if name == "alignment_blocks")
    per_file = [r["count"] for r in blocks.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(per_file) == 60 and max(per_file) <= alignment.BLOCKS_PER_FILE


def test_encoder_is_the_library(model, library):
    own = alignment.Encoders(model)
    for c in [*range(0x20, 0xD7FF, 7), *range(0x10000, 0x10FFFF, 997)]:
        t = f" a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2 .{chr(c)}  {chr(c)}  x"
        assert own.a_ids(t) == library[0].encode(t, add_special_tokens=False).ids
    for t in (" " * (alignment.LONG - 2) + "x", "\n" * (alignment.LONG + 5) + "x", "ab" * alignment.LONG):
        assert own.a_ids(t) == library[0].encode(t, add_special_tokens=False).ids


def test_coalesce():
    assert alignment.coalesce(np.array([2, 2, 1]), np.array([1, 3, 1])).tolist() == [0, 0, 1, 0, 0, 1]
    assert alignment.coalesce(np.array([], int), np.array([], int)).tolist() == []
