"""Fingerprints, edited texts and neighbours against a computation value by value."""

from __future__ import annotations

import hashlib
import random
import re
import struct
from collections import Counter

import pytest
import xxhash

from disclosure_spark.llm import fingerprints

R = random.Random(9)
WORDS = "ab cde fghi jk lm nop é 中文 x y z".split()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def h(*values):
    """Spark's xxhash64 of texts, longs and ints."""
    seed = 42
    for kind, v in values:
        data = v.encode() if kind == "s" else struct.pack("<q" if kind == "l" else "<i", v)
        seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


def pair(p, q):
    return h(("l", p), ("l", q))


def bins(text):
    """The low bits of all bins; none without words."""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    if not w:
        return []
    if len(w) < 5:
        hashes = [h(("s", " ".join(w)))]
    else:
        g = [h(("s", x)) for x in w]
        hashes = [pair(pair(pair(g[i], g[i + 1]), pair(g[i + 2], g[i + 3])), g[i + 4]) for i in range(len(w) - 4)]
    least = {}
    for x in hashes:
        least[x >> 56] = min(x, least.get(x >> 56, x))
    out = []
    for i in range(256):
        if i - 128 in least:
            out.append(least[i - 128] & 255)
            continue
        probes = [(h(("i", i), ("i", k)) & 255) - 128 for k in range(fingerprints.PROBES)]
        lender = next((p for p in probes if p in least), None)
        if lender is None:
            lender = min(((h(("i", i), ("l", b)), x, b) for b, x in least.items()))[2]
        out.append(least[lender] & 255)
    return out


def text_of(b):
    return "".join("".join(f"{x:02x}" for x in reversed(b[i : i + 8])) for i in range(0, len(b), 8))


def like(a, b):
    if not a or not b:
        return float(not a and not b)
    return max(0.0, min(1.0, (sum(x == y for x, y in zip(a, b)) / 256.0 - 1 / 256) / (1 - 1 / 256)))


def brute(rows):
    order = sorted(rows, key=lambda r: (-(2**63) if r[0] is None else r[0], signed(xxhash.xxh64_intdigest((r[1] or "").encode(), nulls(r[0])))))
    out = Counter()
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        lent = len(t) // 4
        edited = t[: len(t) - lent] + after[:lent]
        own, other, following = bins(t), bins(edited), bins(after)
        out[d, len(t), hashlib.sha256(edited.encode()).hexdigest(), text_of(own), text_of(other), round(like(own, other), 12), round(like(own, following), 12)] += 1
    return out


def nulls(d):
    """Whether the id is null is hashed before the text."""
    return xxhash.xxh64_intdigest(struct.pack("<i", int(d is None)), 42)


def rounded(df):
    return Counter((*tuple(r)[:5], round(r.near_edited, 12), round(r.near_next, 12)) for r in df.collect())


def made(n):
    text = lambda: " ".join(R.choice(WORDS) + str(R.randrange(30)) for _ in range(R.choice([0, 1, 3, 5, 40, 300])))
    return [(R.choice([None, 7, R.randrange(10_000), R.randrange(-50, 50)]), R.choice([None, "", text(), text(), text()])) for _ in range(n)]


@pytest.mark.parametrize("ranges", [None, 1, 3, 200])
def test_all_values(spark, ranges):
    """Gaps between ids, repeated and null ids, equal rows, empty texts; the first follows the last."""
    rows = made(150)
    rows += rows[:20] + rows[:10] + [(7, "same text here now")] * 30 + [(None, None)] * 5 + [(99_999, "the last one of all of them")]
    df = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], "doc_id long, text string, k1 int, copies int, range int").repartition(5)
    assert rounded(fingerprints.fingerprints(df, ranges)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(5, "one two three four five six")], [(5, "a"), (5, "a")], [(None, None)], [(1, "x y"), (-3, "z")]])
def test_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rounded(fingerprints.fingerprints(df)) == brute(rows)


def test_one_shuffle_of_texts(spark, sf_dir):
    got = fingerprints.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    plan = got._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" in plan and "SortMergeJoin" not in plan
