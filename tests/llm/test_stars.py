"""Near duplicates against a comparison of all pairs, and components against a search."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from support import connect, spark_bag, sql_bag

from disclosure_spark.llm import queries, stars
from disclosure_spark.llm.components import components
from disclosure_spark.llm.shared import shingle_sets

R = random.Random(11)
WORDS = [a + b for a in "ba ce di fo gu Ha".split() for b in "nt rs ll ck mp".split()]


def shingles(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()


def reachable(n, edges):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    seen = {}
    for s in range(n):
        if s in seen:
            continue
        todo, group = [s], {s}
        while todo:
            for y in near[todo.pop()] - group:
                group.add(y)
                todo.append(y)
        seen |= dict.fromkeys(group, group)
    return seen


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    edges = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    groups = reachable(len(rows), edges)
    out = Counter()
    for i, (d, _) in enumerate(rows):
        own = min((rows[j][0] for j in groups[i] if rows[j][0] is not None), default=None)
        out[d, len(sets[i]), own, d == own] += 1
    return out


def edited(words, share):
    return [R.choice(WORDS) if R.random() < share else w for w in words]


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    base = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120).collect()]
    odd = [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "One TWO three"), (9005, "one two  three"), (9006, "É a b"), (9007, "é a b")]
    odd += [(None, "only null ids here now"), (None, "only null ids here now"), (9008, "x y z w"), (9008, "x y z w"), (9009, "x y z w v")]
    root = [R.choice(WORDS) for _ in range(150)]
    chain, made = root, []
    for i in range(40):  # every link leads a little further away
        chain = edited(chain, 0.02)
        made.append((10_000 - i, " ".join(chain)))
    made += [(20_000 + i, " ".join(edited(root, 0.04))) for i in range(60)]  # around one that is not there itself
    made += [(None if i == 3 else 30_000 + i // 2, " ".join(edited(root[:12], 0.05))) for i in range(40)]
    return base + odd + made + [(40_000, " ".join(root * 30)), (40_001, " ".join(root * 31))]


@pytest.mark.parametrize("bins, per_band, block", [(128, 4, 256), (128, 2, 3)])
def test_near_duplicates(spark, rows, bins, per_band, block):
    data = [(d, "x", 1, 2, t) for d, t in rows]
    docs = spark.createDataFrame(data, "doc_id int, class string, key int, n int, text string").repartition(4)
    got = stars.near_duplicates(docs, bins=bins, rows=per_band, block=block)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    # A null id is equal to nothing but a component without ids.
    assert Counter(map(tuple, got.collect())) == brute(rows)
    if block > 3:
        assert stars.near_duplicates(docs.limit(0)).collect() == []
        assert stars.near_duplicates(docs.filter("doc_id in (9001, 9002)")).count() == 2


def test_open_links_find_what_hubs_miss(spark):
    """Two pairs of copies in one bucket: the hub is linked to one of the others at most."""
    sets = {c: np.array(sorted(v), np.uint64) for c, v in {1: range(100), 2: range(50, 130), 3: range(52, 131), 4: range(100, 200)}.items()}
    members = spark.createDataFrame([(7, 0, c, len(s), 4) for c, s in sets.items()], "key long, band int, class long, n long, size long")
    classes = spark.createDataFrame([(c, [7]) for c in sets], "class long, keys array<long>")
    packed = spark.createDataFrame([(c, bytearray(s.tobytes())) for c, s in sets.items()], "class long, set binary")
    hubs = spark.createDataFrame([(7, 1, 100)], "key long, hub long, hub_n long")
    none = spark.createDataFrame([], "class long, label long")
    for block in (1, 2, 256):
        got = stars.open_links(members, hubs, none, classes, lambda wanted, name: packed, 80, block)
        assert {tuple(sorted(r)) for r in got.collect()} == {(2, 3)}


def test_densification():
    sets = shingle_sets([" ".join(WORDS[i % 30] + str(i) for i in range(n)).encode() for n in (4, 5, 9, 60, 4000)], 4)
    order = stars.probes(128)
    out = stars.signatures(sets, 128, order)
    for s, row in zip(sets, out):
        own = {}
        for h in s.tolist():
            own.setdefault(h >> 57, h)
        for b in range(128):
            lender = next(x for x in [b, *order[b].tolist()] if x in own) if b not in own else b
            assert int(row[b]) == own[lender]
    assert stars.signatures(sets, 1, stars.probes(1)).shape == (5, 1)


def test_recall_at_the_threshold(spark):
    """Sets whose similarity is just 0.8 share a bucket; of 2,000 pairs of each size none is missed."""
    order = stars.probes(stars.BINS)
    g = np.random.default_rng(5)
    for common, extra in ((8, 1), (40, 5), (400, 50)):
        missed = 0
        for _ in range(2000):
            h = g.integers(0, 1 << 64, common + 2 * extra, np.uint64)
            pair = [np.sort(h[: common + extra]), np.sort(np.concatenate([h[:common], h[common + extra :]]))]
            keys = stars.band_keys(stars.signatures(pair, stars.BINS, order), stars.ROWS)
            missed += not (keys[0] == keys[1]).any()
        assert missed == 0, (common, missed)


def test_components(spark):
    n = 300
    edges = [(R.randrange(n), R.randrange(n)) for _ in range(150)] + [(i, i + 1) for i in range(250, 290)] + [(5, 5), (299, 299)]
    got = {r["class"]: r.label for r in components(spark.createDataFrame(edges, "class long, parent long")).collect()}
    groups = reachable(n, edges)
    assert got == {i: min(groups[i]) for e in edges for i in e}
    assert components(spark.createDataFrame([], "class long, parent long")).collect() == []


def test_sql(spark, rows, tmp_path):
    some = [r for r in rows if r[0] is not None][-170:]
    docs = spark.createDataFrame(some, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert spark_bag(stars.near_duplicates(docs)) == sql_bag(con, queries.oracle_sql()["op11_near_dedup"])[1]
