"""The registered queries of llm: against their SQL where there is one, else that they answer for whole tables."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import connect, differences
from llm import queries, toxicity

BY_SQL = sorted(queries.ORACLES)


@pytest.mark.parametrize("name", BY_SQL)
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(spark, connect(sf_dir), sf_dir, queries.QUERIES[name], queries.ORACLES[name]) == []


@pytest.mark.parametrize("name, table", [("op1_bpe", "documents"), ("op3_embeddings", "embeddings"), ("op4_minhash", "documents"), ("op5_quality", "documents"),
                                         ("op6_toxicity", "documents"), ("op10_sharding", "documents")])
def test_one_row_per_row(spark, sf_dir, name, table):
    assert queries.QUERIES[name](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def text(seed, n):
    rng = random.Random(seed)
    return [f"w{rng.randrange(40_000)}" for _ in range(n)]


def test_pipeline_on_planted_cases(spark, tmp_path):
    """Each stage against what was planted for it; clean documents stay whole."""
    passage = text(999, 90)
    rows = {i: text(i, 120 + i % 60) for i in range(300)}
    toxic = set(range(0, 300, 4))
    for i in toxic:
        rows[i][i % 100] = ["stupid", "moron", "zorgat"][i % 3]
    rows[400] = [w + "###" for w in text(400, 120)]  # symbols
    rows[401] = text(401, 20)  # short
    rows[402] = rows[1][:-1] + ["changed"]  # near copy of a clean document
    rows[403], rows[404] = text(403, 60) + passage, passage + text(404, 70)
    docs = [(i, " ".join(w), "en", "s", 5) for i, w in rows.items()] + [(500, None, None, None, None), (1, " ".join(rows[1]), "en", "s", 5)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(f"{tmp_path}/{name}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(rows) - set(kept["quality"]) == {400, 401} and 500 not in kept["quality"]
    gone = set(kept["quality"]) - set(kept["toxicity"])
    assert gone <= toxic and len(gone) >= 0.95 * len(toxic)
    assert set(kept["toxicity"]) - set(kept["minhash"]) == {402} and docs.filter("doc_id = 1").count() == 1
    assert set(kept["substring"]) == set(kept["minhash"])
    changed = {i for i, t in kept["substring"].items() if t != kept["minhash"][i]}
    assert changed == {404} and kept["substring"][404].split() == text(404, 70)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(kept["substring"])
    full = corpus_pipeline.run(spark, str(tmp_path))
    assert full.select("doc_id", "piece", "ids_crc32").exceptAll(packed.select("doc_id", "piece", "ids_crc32")).count() == 0


def test_held_out_rows_are_those_of_crc32(spark):
    got = {r["id"]: r["h"] for r in spark.range(50).withColumn("h", toxicity.held_out(F.col("id"))).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)}
