"""What used to be limited: signs of a batch, lengths of keys, rounds of surrogates, rows sent to the driver."""

from __future__ import annotations

from pyspark.sql import functions as F

from disclosure_spark.llm import pieces, quality, surrogates

KEY_BODY = "\n".join("Ab1+/" * 12 + "wxyz" for _ in range(900))  # over 50,000 signs


def test_any_number_of_signs(spark):
    """A text of all printable code points, by the library's ids."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    v = pieces.load()
    many = "".join(c for c in map(chr, [*range(0x20, 0xD800), *range(0xE000, 0x110000)]) if c.isprintable() and c != "▁")
    assert len(set(many)) > 140_000
    texts = [many, "plain the text", many[::-1][:5000], "aé" + many[70_000:70_010] + " the end"]
    ids, bounds = pieces.encode(texts, v)
    for t, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == library.encode(t)
        assert pieces.decode(ids[a:b].tolist(), v) == t


def replaced(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: (r.text, r.n_entities) for r in surrogates.replace(df).collect()}


def test_keys_of_any_length(spark):
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    headers = "\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\n"
    long = f"before {begin}{headers}{KEY_BODY}\n{end} after"
    two = f"{begin}\nAAAAAAAAAAAAAAAAAAAAAAAA\nsome words here {begin}{headers}{KEY_BODY}\n{end} rest"
    cut = f"only a mark {begin} and words, no key"
    got = replaced(spark, long, two, cut, " ".join([cut] * 3000))
    assert KEY_BODY not in got[0][0] and got[0][1] == 1 and got[0][0].startswith("before ") and got[0][0].endswith(" after")
    assert KEY_BODY not in got[1][0] and "AAAAAAAAAAAAAAAAAAAAAAAA" not in got[1][0] and "\nsome words here " in got[1][0]
    assert got[2] == (cut, 0) and got[3][1] == 0


def test_surrogates_after_the_last_round(spark, monkeypatch):
    """With one round there are collisions left; they are told apart, also from real values that look like it."""
    monkeypatch.setattr(surrogates, "ROUNDS", 1)
    cores = [f"1.2.3.{i}" for i in range(200)] + ["9.9.9.9"]
    parts = spark.createDataFrame([("given-m-Latin", f"Name{i}") for i in range(60)] + [("given-m-Latin", "Adam-7")] + [("ipv4", c) for c in cores], "kind string, core string")
    got = surrogates.dictionary(parts).collect()
    assert len(got) == 60 + 1 + 201 and len({(r.kind, r.surrogate) for r in got}) == len(got)
    assert not {(r.kind, r.surrogate) for r in got} & {(r.kind, r.core) for r in got}
    again = surrogates.dictionary(parts).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_columns_of_the_same_name_stay(spark):
    df = spark.createDataFrame([(1, "write to a@b.example now", 7), (2, None, 8)], "doc_id long, text string, n_entities int")
    out = surrogates.replace(df)
    assert out.columns[:3] == df.columns and len(out.columns) == 4
    assert {(r.doc_id, r.n_entities, r[3]) for r in out.collect()} == {(1, 7, 1), (2, 8, 0)}


def test_sample_is_bounded(spark):
    """Of many rows in many tasks hardly more than wanted are sorted; equal rows count once, however many."""
    rows = spark.range(0, 30_000, 1, 40).select(F.col("id").alias("doc_id"), F.array(F.col("id") / 7, F.lit(1.0)).alias("x"))
    hot = spark.range(0, 15_000, 1, 10).select(F.lit(5).cast("long").alias("doc_id"), F.array(F.lit(0.5), F.lit(1.0)).alias("x"))
    both = rows.unionByName(hot)
    got = [tuple(r.x) for r in quality.sample(both, 300)]
    order = both.distinct().orderBy(F.xxhash64(F.lit(quality.SEED), "doc_id", "x")).limit(300)
    assert got == [tuple(r.x) for r in order.collect()] and len(set(got)) == 300
    assert len(quality.sample(rows, 50_000)) == 30_000
    assert quality.sample(rows.limit(0), 10) == []


def test_quality_of_odd_rows(spark, sf_dir):
    """Null, empty, repeated rows, ids without a label and labels that differ or are null."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    odd = spark.createDataFrame([(None, "no id here"), (9_000_001, None), (9_000_002, ""), (9_000_003, "a"), (9_000_003, "a")], "doc_id long, text string")
    more = spark.createDataFrame([(9_000_001, 1), (9_000_002, 0), (9_000_002, 1), (9_000_003, None), (None, 1)], "doc_id long, quality int")
    clash = docs.unionByName(odd).withColumns({"x": F.lit("x"), "held_out": F.lit(3), "score": F.lit("s")})
    got = quality.score(clash, labels.unionByName(more.select("doc_id", F.col("quality").cast(dict(labels.dtypes)["quality"]))))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == docs.count() + 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert len({r.score for r in rows if r.doc_id == 9_000_003}) == 1
    assert quality.score(docs.limit(0), labels).collect() == []
    assert {r.score for r in quality.score(docs.limit(5), labels.limit(0)).collect()} == {0.5}
    kept = quality.keep_good(clash, labels)
    assert kept.columns == clash.columns
    assert kept.count() == quality.score(clash, labels).filter("predicted = 1").count() > 0
