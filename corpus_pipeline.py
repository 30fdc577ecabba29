"""The corpus pipeline: five stages from raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and is written as
Parquet and read again before the next. All but the last return the columns of ``documents``. Stages
learn nothing about rows that were removed before. Verdicts and passages belong to rows: those that share an id,
or have none, are judged, compared and cut each by its own text. NULL texts fail the quality rules; alone, the later
stages keep them as they are. Other columns are dropped. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import minhash, packing, quality, substring, toxicity
from llm.registry import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE_WORDS = 5


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row_``, a number of each row: its doc_id for one row of each id, one above all ids for the others."""
    counts = docs.groupBy("doc_id").count()
    several = stored(counts.filter("count > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("twice_")), "repeated")
    if several.isEmpty() and docs.filter("doc_id IS NULL").isEmpty():
        return docs.withColumn("row_", F.col("doc_id"))
    above = docs.agg(F.coalesce(F.max("doc_id"), F.lit(-1))).first()[0] + 1
    # stored, so that every use of it sees the same numbers
    marked = stored(docs.join(several, F.col("doc_id") == F.col("twice_"), "left").withColumn("place_", F.monotonically_increasing_id()), "numbered")
    firsts = stored(marked.filter("twice_ IS NOT NULL").groupBy("twice_").agg(F.min("place_").alias("first_")).select("first_"), "firsts")
    own = F.col("doc_id").isNotNull() & (F.col("twice_").isNull() | F.col("first_").isNotNull())
    return marked.join(firsts, F.col("place_") == F.col("first_"), "left").withColumn(
        "row_", F.when(own, F.col("doc_id")).otherwise(above + F.col("place_"))).drop("twice_", "place_", "first_")


def _only(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The numbered rows that ``verdicts`` (row_, kept) keeps."""
    gone = stored(verdicts.filter("NOT kept").select(F.col("row_").alias("gone_")), "gone")
    return rows.join(gone, F.col("row_") == F.col("gone_"), "left_anti").select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    rows = _numbered(docs.select(*COLUMNS))
    return _only(rows, quality.judge(rows.select("row_", "text", "lang", "source")))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from their labels, finds less toxic than the threshold."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, COLUMNS).filter(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest number, of each group of near-duplicates on shingles of five words."""
    rows = _numbered(docs.select(*COLUMNS))
    verdicts = minhash.near_duplicates(rows.select(F.col("row_").alias("doc_id"), "text"), SHINGLE_WORDS)
    return _only(rows, verdicts.select(F.col("doc_id").alias("row_"), "kept"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of a smaller number has too; n_chars is counted anew where text went."""
    rows = _numbered(docs.select(*COLUMNS)).withColumnsRenamed({"doc_id": "own_id_", "row_": "doc_id"})
    cut = substring.remove_passages(rows.withColumn("before_", F.xxhash64("text")), substring.shared_passages(rows))
    changed = ~F.xxhash64("text").eqNullSafe(F.col("before_"))
    cut = cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.drop("doc_id").withColumnRenamed("own_id_", "doc_id").select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_rules),
    ("toxicity", toxicity_filter),
    ("minhash", minhash_dedup),
    ("substring", substring_dedup),
    ("packing", best_fit_packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
