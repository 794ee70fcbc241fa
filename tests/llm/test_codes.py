"""Codes and codebooks against plain k-means on Python's integers, and the work that balls save."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from disclosure_spark.llm import codes

G = np.random.default_rng(13)


def brute(rows, parts=4, entries=256, rounds=4):
    """Rows of (vec_id, vector, label) to a bag of the five columns."""
    usable = [(i, [math.floor(1024 * float(c)) for c in v], label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    if not usable:
        return Counter()
    width = max(1, -(-max(len(v) for _, v, _ in usable) // parts))
    full = [(i, v, v + [0] * (parts * width - len(v)), label) for i, v, label in usable]
    first = sorted(full, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(r[2], p) for r in first] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda x, p: min((gap(x, c), e) for e, c in enumerate(books[p]))[::-1]
    for turn in range(rounds + 1):
        coded = [[nearest(cut(r[2], p), p) for p in range(parts)] for r in full]
        if turn == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(r[2], p) for r, c in zip(full, coded) if c[p][0] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    sums = Counter()
    for r, c in zip(full, coded):
        sums[r[3]] += sum(g for _, g in c)
    return Counter((r[0], "".join(f"{e:02x}" for e, _ in c), sum(g for _, g in c), sums[r[3]], digest) for r, c in zip(full, coded))


def bag(df):
    return Counter(map(tuple, df.collect()))


def made(n, dims, spread, centres=12):
    middle = G.uniform(-1, 1, (centres, dims))
    return [(middle[G.integers(centres)] + G.normal(0, 0.05, dims)) * spread for _ in range(n)]


@pytest.mark.parametrize("spread, entries", [(0.5, 256), (0.5, 20), (1e5, 9)])
def test_equal_to_brute_force(spark, spread, entries):
    """Also where squared distances do not fit into doubles, with ties, and with fewer rows than entries."""
    rows = [(int(i), v.tolist(), int(G.integers(3))) for i, v in zip(G.permutation(1000), made(150, 8, spread))]
    rows += [(2000 + i, rows[i][1], None) for i in range(10)] + [(rows[5][0], rows[7][1], 1)] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    assert bag(codes.encode(df, entries=entries)) == brute(rows, entries=entries)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5] * 8, 1), (2, None, 1), (3, [nan] * 8, 1), (4, [1.0, None], 2), (5, [inf, 0.0], 2), (6, [], None), (None, [0.25] * 5, None)]
    rows += [(None, [0.25] * 5, None), (1, [0.5] * 8, 1), (1, [-0.5] * 9, None), (7, [-0.0001] * 3, 2)]
    extra = [(*r, 1, "c", 2) for r in rows]
    df = spark.createDataFrame(extra, "vec_id long, embedding array<float>, label int, x int, code string, gap int")
    as_float = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], label) for i, v, label in rows]
    got = codes.encode(df)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert bag(got) == brute(as_float)
    assert codes.encode(df.limit(0)).collect() == [] == codes.encode(df.filter("vec_id = 2")).collect()
    texts = df.withColumn("label", df.label.cast("string"))
    assert bag(codes.encode(texts)) == brute(as_float)
    with pytest.raises(Exception, match="too large for a long"):
        codes.encode(spark.createDataFrame([(1, [1e300], 1)], "vec_id long, embedding array<double>, label int")).collect()
    with pytest.raises(ValueError):
        codes.encode(df, entries=257)


@pytest.mark.parametrize("kind", [np.float64, object])
def test_balls_find_the_nearest(kind):
    """From any old assignment, with any entries moved; ties go to the lower entry."""
    x = np.floor(np.array(made(600, 6, 300))).astype(kind)
    book = x[:40].copy()
    book[7] = book[3]  # a tie wherever 3 is nearest
    for _ in range(5):
        gaps = codes._distances(x, book)
        nearest, best = codes._nearest(gaps), gaps.min(1)
        moved = G.random(40) < 0.5
        before = book.copy()
        before[moved] += G.integers(-30, 30, (moved.sum(), 6)).astype(kind)
        old = codes._nearest(codes._distances(x, before))
        past = codes._distances(x, before)[np.arange(600), old]
        code, gap = codes.assign(x, book, old, past, (before != book).any(1))
        assert code.tolist() == nearest.tolist() and gap.tolist() == best.tolist()
        book = np.floor(book.astype(np.float64) + G.normal(0, 3, book.shape)).astype(kind)


def test_balls_save_work():
    """In clusters most distances are not computed; nothing is where nothing moved."""
    x = np.floor(np.array(made(3000, 16, 500, centres=60))).astype(np.float64)
    book = x[:256].copy()
    work = np.zeros(1)
    old, gap = codes.assign(x, book, None, None, np.ones(256, bool), work)
    assert work[0] == x.shape[0] * 256
    assert codes.assign(x, book, old, gap, np.zeros(256, bool), still := np.zeros(1))[0].tolist() == old.tolist() and still[0] == 0
    moved = book.copy()
    for e in set(old.tolist()):
        moved[e] = x[old == e].sum(0) // (old == e).sum()
    again, _ = codes.assign(x, moved, old, gap, (moved != book).any(1), some := np.zeros(1))
    assert again.tolist() == codes._nearest(codes._distances(x, moved)).tolist()
    assert some[0] < 0.2 * work[0]
