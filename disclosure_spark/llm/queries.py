"""The registered queries of this package, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import alignment, codes, fingerprints, forest, mincut, mixing, pieces, quality, stars, suffixes, surrogates, topk, warc
from .shared import read_table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove(read_table(spark, sf_dir, "documents"), keep=False)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.with_ids(read_table(spark, sf_dir, "documents"), pieces.load())


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(spark, read_table(spark, sf_dir, "pages"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace(docs)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut.extract(read_table(spark, sf_dir, "pages"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.join(read_table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read_table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


def op11_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stars.near_duplicates(read_table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str, a_file: str = alignment.A_FILE, b_file: str = alignment.B_FILE) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"), alignment.load(a_file, b_file))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.encode(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_suffix_dedup, op2_sentencepiece, op3_mixing, op4_warc, op5_surrogates, op6_quality, op7_html_text,
        op8_jaccard_join, op9_fingerprints, op10_top_k, op11_near_dedup, op12_alignment, op13_vector_codes,
    ]
    return {q.__name__: q for q in named} | {"pipeline": corpus_pipeline.run}


_WARC = """
WITH page AS (
    SELECT page_id, coalesce(html, '') AS html FROM pages
), sized AS (
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM page
), firsts AS (
    SELECT payload_digest, min(page_id) AS first_id FROM sized WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM sized LEFT JOIN firsts USING (payload_digest)
"""

_TOP_K = """
WITH usable AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM usable
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""

_SHARE = f"{mixing.SHARE_NUM}.0 / {mixing.SHARE_DEN}"
_SALT = f"CAST('0x' || substr(md5('{mixing.SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT)"


def _apportioned(rows: str, group: str, weight: str, seats: str, order: str) -> str:
    """Common table expressions that end in ``<rows>_dealt``: the rows with ``dealt``, their seats.

    The seats of each group go one by one to the highest quotients; those that the rounded
    share surely covers are not listed.
    """
    return f"""
{rows}_own AS (
    SELECT *, {seats} AS seats, sum(CAST({weight} AS DOUBLE)) OVER (PARTITION BY {group}) AS everything,
           count(*) OVER (PARTITION BY {group}) AS members
    FROM {rows}
), {rows}_sure AS (
    SELECT *, CASE WHEN everything > 0
              THEN greatest(0, CAST(floor({weight} * seats / everything) AS BIGINT) - members) ELSE 0 END AS sure
    FROM {rows}_own
), {rows}_left AS (
    SELECT *, seats - sum(sure) OVER (PARTITION BY {group}) AS missing FROM {rows}_sure
), {rows}_quotients AS (
    SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {weight} / (2.0 * seat + 1) DESC, {order}) AS turn
    FROM (SELECT *, sure + unnest(range(CAST(2 * members + 2 AS BIGINT))) AS seat FROM {rows}_left)
    WHERE {weight} > 0
), {rows}_won AS (
    SELECT {group} AS g, {order} AS o, count(*) AS won FROM {rows}_quotients WHERE turn <= missing GROUP BY {group}, {order}
), {rows}_dealt AS (
    SELECT l.*, CAST(sure + coalesce(won, 0) AS BIGINT) AS dealt
    FROM {rows}_left l LEFT JOIN {rows}_won ON g = {group} AND o = {order}
)"""


_MIX = f"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
           {_SALT} AS salt
    FROM documents
), totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, ({list(mixing.WEIGHTS)})[(place - 1) % {len(mixing.WEIGHTS)} + 1] AS weight, {mixing.MOST} * source_size AS most
    FROM totals
), filling AS (
    SELECT *, most / CAST(weight AS DOUBLE) AS ratio,
           (SELECT sum(source_size) FROM totals) * {_SHARE} - coalesce(sum(most) OVER below, 0) AS remaining,
           (SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER below, 0) AS remaining_weight
    FROM weighed
    WINDOW below AS (ORDER BY most / CAST(weight AS DOUBLE), place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT ratio AS level_ratio, place AS level_place, remaining, remaining_weight FROM filling
    WHERE remaining * weight / remaining_weight <= most ORDER BY ratio, place LIMIT 1
), one AS (
    SELECT source, place, source_size, 1 AS whole,
           CASE WHEN ratio < level_ratio OR (ratio = level_ratio AND place < level_place) THEN CAST(most AS DOUBLE)
                ELSE level.remaining * weight / level.remaining_weight END AS target
    FROM filling, level
), {_apportioned("one", "whole", "target", f"CAST(round((SELECT sum(target) FROM one) / {mixing.BLOCK}) AS BIGINT)", "place")},
placed AS (
    SELECT doc_id, size, salt, source_size, target, place, dealt AS quota,
           salt % least({mixing.MOST_SHARDS}, greatest(1, CAST(ceil(source_size / {mixing.SHARD_WORDS}.0) AS BIGINT))) AS shard
    FROM sized JOIN one_dealt ON sized.source IS NOT DISTINCT FROM one_dealt.source
), cell AS (
    SELECT place, shard, CAST(sum(size) AS BIGINT) AS words, max(quota) AS quota FROM placed GROUP BY place, shard
), {_apportioned("cell", "place", "words", "quota", "shard")},
blocks AS (
    SELECT place, shard, n, least(dealt, {mixing.MOST} * n) AS q,
           CAST('0x' || substr(md5('{mixing.SEED}|' || place || '|' || shard), 1, 15) AS BIGINT) % n AS start
    FROM (SELECT *, greatest(1, words // {mixing.BLOCK}) AS n FROM cell_dealt)
), ended AS (
    SELECT *, CAST(sum(size) OVER (PARTITION BY place, shard ORDER BY salt, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS until
    FROM placed
), borders AS (
    SELECT *, least(until // {mixing.BLOCK}, n - 1) AS b1, least((until - size) // {mixing.BLOCK}, n - 1) AS b0
    FROM ended JOIN blocks USING (place, shard)
)
SELECT doc_id, size, source_size, target,
       CAST({mixing.BLOCK} * ((b1 * q + start) // n) + (until - b1 * {mixing.BLOCK}) * (((b1 + 1) * q + start) // n - (b1 * q + start) // n)
          - {mixing.BLOCK} * ((b0 * q + start) // n)
          - (until - size - b0 * {mixing.BLOCK}) * (((b0 + 1) * q + start) // n - (b0 * q + start) // n) AS BIGINT) AS taken
FROM borders
"""


_WORDS_OF = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"

# Links of documents by the similarity of their runs of five words, all pairs compared.
_JOIN = f"""
WITH RECURSIVE worded AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingled AS MATERIALIZED (
    SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {forest.WORDS} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {forest.WORDS - 2}), lambda i: array_to_string(w[i : i + {forest.WORDS - 1}], ' '))) END AS s
    FROM worded
), entry AS MATERIALIZED (
    SELECT r, len(s) AS n, unnest(s) AS x FROM shingled
), common AS (
    SELECT a.r AS p, b.r AS q, any_value(a.n) AS pn, any_value(b.n) AS qn, count(*) AS c
    FROM entry a JOIN entry b ON a.x = b.x AND a.r < b.r AND 100 * least(a.n, b.n) >= {round(100 * forest.THRESHOLD)} * greatest(a.n, b.n)
    GROUP BY a.r, b.r
), link AS MATERIALIZED (
    SELECT p, q FROM common WHERE 100 * c >= {round(100 * forest.THRESHOLD)} * (pn + qn - c)
), both_ways AS MATERIALIZED (
    SELECT p, q FROM link UNION ALL SELECT q, p FROM link
), reach(r, t) AS (
    SELECT r, r FROM shingled UNION SELECT reach.r, both_ways.q FROM reach JOIN both_ways ON reach.t = both_ways.p
), least_id AS (
    SELECT reach.r, min(shingled.doc_id) AS class_id FROM reach JOIN shingled ON reach.t = shingled.r GROUP BY reach.r
), counted AS (
    SELECT p AS r, count(*) AS n_links FROM both_ways GROUP BY p
)
SELECT doc_id, class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM shingled JOIN least_id USING (r) LEFT JOIN counted USING (r)
"""

_NEAR = f"""
WITH RECURSIVE worded AS (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS_OF} AS w FROM documents
), shingled AS MATERIALIZED (
    SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {stars.WORDS} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {stars.WORDS - 2}), lambda i: array_to_string(w[i : i + {stars.WORDS - 1}], ' '))) END AS s
    FROM worded
), entry AS MATERIALIZED (
    SELECT r, len(s) AS n, unnest(s) AS x FROM shingled
), common AS (
    SELECT a.r AS p, b.r AS q, any_value(a.n) AS pn, any_value(b.n) AS qn, count(*) AS c
    FROM entry a JOIN entry b ON a.x = b.x AND a.r < b.r AND 100 * least(a.n, b.n) >= {stars.PERCENT} * greatest(a.n, b.n)
    GROUP BY a.r, b.r
), link AS MATERIALIZED (
    SELECT p, q FROM common WHERE 100 * c >= {stars.PERCENT} * (pn + qn - c)
), both_ways AS MATERIALIZED (
    SELECT p, q FROM link UNION ALL SELECT q, p FROM link
), reach(r, t) AS (
    SELECT r, r FROM shingled UNION SELECT reach.r, both_ways.q FROM reach JOIN both_ways ON reach.t = both_ways.p
), least_id AS (
    SELECT reach.r, min(shingled.doc_id) AS component_id FROM reach JOIN shingled ON reach.t = shingled.r GROUP BY reach.r
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM shingled JOIN least_id USING (r)
"""


def _codes(rounds: int = codes.ROUNDS, entries: int = codes.ENTRIES, parts: int = codes.PARTS) -> str:
    """The rounds of assignment and update, one after another."""
    steps = f"""
WITH usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, * FROM usable
), part AS MATERIALIZED (
    SELECT r, p, list_slice(v, len(v) // {parts} * p + 1, len(v) // {parts} * (p + 1)) AS x FROM kept, range({parts}) AS positions(p)
), book0 AS MATERIALIZED (
    SELECT p, r - 1 AS e, x AS c FROM part WHERE r <= {entries}
)"""
    for k in range(rounds + 1):
        steps += f""", near{k} AS MATERIALIZED (
    SELECT r, p, min(gap * {entries} + e) % {entries} AS e, min(gap) AS gap
    FROM (SELECT r, part.p, e, list_sum(list_transform(list_zip(x, c), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) AS gap
          FROM part JOIN book{k} ON part.p = book{k}.p)
    GROUP BY r, p
)"""
        if k < rounds:
            steps += f""", mean{k} AS (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
    FROM (SELECT p, e, i, sum(x[i]) AS s, count(*) AS n
          FROM (SELECT part.p, e, x, unnest(range(1, len(x) + 1)) AS i FROM part JOIN near{k} USING (r, p)) GROUP BY p, e, i)
    GROUP BY p, e
), book{k + 1} AS MATERIALIZED (
    SELECT p, e, coalesce(mean{k}.c, book{k}.c) AS c FROM book{k} LEFT JOIN mean{k} USING (p, e)
)"""
    return steps + f""", coded AS (
    SELECT r, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(gap) AS BIGINT) AS error
    FROM near{rounds} GROUP BY r
), digest AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""


def oracle_sql() -> dict[str, str]:
    """SQL cannot express the others; tests/llm compares them with brute force."""
    return {"op3_mixing": _MIX, "op4_warc": _WARC, "op8_jaccard_join": _JOIN, "op10_top_k": _TOP_K, "op11_near_dedup": _NEAR, "op13_vector_codes": _codes()}
