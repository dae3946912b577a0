"""Stages of the corpus pipeline; each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last return the columns of documents. Extra columns of ``docs`` stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm import hilbert, jaccard, mixing, quality, wumanber
from veritab.llm.store import shared_path
from veritab.plans.registry import table

SHINGLE, PERCENT = 5, 80  # near-duplicates: five-word shingles, similarity 0.8 or more


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`").alias(f"__doc_{c}") for c in docs.columns])


def _unmarked(rows: DataFrame, cols: list[str]) -> DataFrame:
    return rows.select(*[F.col(f"`__doc_{c}`").alias(c) for c in cols])


def grade(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade reaches quality.KEEP; toxic and junk documents go. The model is
    fitted on the labelled rows of the documents table."""
    # the text stays in the row: the scorer passes every column through, under names that clash with none of its own
    inner = _marked(docs)
    rated = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("__doc_text"))
    kept = quality.grade_documents(inner, rated, table(spark, sf_dir, "labels"), inner.columns, "__doc_text")
    return _unmarked(kept.where("keep"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of the n-gram Jaccard join: the smallest doc_id (ties: the smallest text, then one
    row). Documents without a word stand alone and stay, as do rows without a doc_id that are alone in their
    class."""
    cols = docs.columns
    mark = F.xxhash64(*[F.col(c) for c in cols if c != "text"], "text")
    rows = docs.withColumn("__mark", mark)
    found = jaccard.jaccard_classes(rows, ["doc_id", "__mark"], SHINGLE, PERCENT)
    best = found.where("class IS NOT NULL").groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__mark")).alias("best"))
    chosen = best.select(F.col("best.doc_id").alias("__id"), F.col("best.__mark").alias("__m"))
    alone = found.where("class IS NULL").select(F.col("doc_id").alias("__id"), F.col("__mark").alias("__m"))
    # rows equal in every column share one mark; one of them is enough where they hold words
    keys = chosen.unionByName(alone).distinct()
    kept = rows.join(keys, (F.col("__mark") == F.col("__m")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__mark"]).select(*cols)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any occurrence of a ten-word window of a benchmark item."""
    inner = _marked(docs)
    found = wumanber.decontaminate(inner, table(spark, sf_dir, "benchmark"), window=10, keep=inner.columns, text="__doc_text")
    return _unmarked(found.where(F.size("hit_runs") == 0), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: taken / size, rounded down or up by a hash of the document so that
    every source keeps its share; documents without words stay once."""
    cols = docs.columns
    taken, _ = mixing.mix_sources(docs)
    per = taken.groupBy("doc_id", "text_hash", "source").agg(F.sum("taken").alias("__taken"), F.sum("size").alias("__size"))
    per = per.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("source").alias("__source"), "__taken", "__size")
    rows = docs.withColumn("__h", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash")) & F.col("source").eqNullSafe(F.col("__source"))
    part = F.pmod(F.xxhash64(F.lit(3), "doc_id", "__h"), F.lit(1 << 20)) / (1 << 20)
    times = F.when(F.col("__size") > 0, F.floor(F.col("__taken") / F.col("__size") + part)).otherwise(F.lit(1)).cast("int")
    copies = rows.join(per, same).withColumn("__times", times).where("__times > 0")
    return copies.select(*cols, F.explode(F.sequence(F.lit(1), F.col("__times"))).alias("__copy")).select(*cols)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every remaining document on the Hilbert curve; shard sizes differ by one row at most."""
    out = hilbert.shard_documents(docs, shards=8)
    return out.select("doc_id", "lang", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot")


STAGES = [
    ("quality classifier", grade),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
    ("sharding", shard),
]


def run_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents, each stage's result written as Parquet and read again as the next one's docs."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = shared_path(spark, f"stage-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
