"""Training-data pipeline over the documents table.

Five stages, each written as Parquet and read again as the next one's documents: reject documents whose perplexity under trusted
text is too high, drop exact copies, keep one document of each near-duplicate group, repeat sources to their target weights, and
pack what is left into token-budget batches. All stages but the last return the columns of ``documents``; a document that is
repeated by the mix is several rows with one id, and each is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import exact_dedup, kneser_ney, mixing, packing, simhash
from gleaner.llm.common import documents, scratch

#: Perplexities, fingerprints and a hash-seeded draw are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kneser_ney.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), train_docs=None)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.DigestIndex(spark, scratch(spark, "pipeline-digests")).drop_copies(docs, "pipeline")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Five-word shingles at a similarity of 0.8 here; op5's contract has four words and four bits.
    return simhash.keep_one(docs, k=5, radius=7, similarity=0.8)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mixed), ("pack", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
