"""Exact dedup against a persistent digest index.

The index is a table with one row per distinct text, bucketed and sorted by SHA-256 digest. A batch is reduced to one row per
digest before anything is joined; new digests come from a sort-merge anti-join that reads the index bucket by bucket without
shuffling it, and are appended.

Defined cases: a null text counts as empty; a null id is below all others and wins only among nulls; rows repeated with the same
id and text form one kept document (the kept flag of the row table is true for each of them, ``drop_copies`` returns one); an
empty batch appends nothing. Columns of the batch other than id and text are never read by the index.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import fresh, id_key, scratch, settle, whole_text


def text_digest(column: str = "text"):
    return F.unhex(F.sha2(whole_text(column), 256))


class DigestIndex:
    """Index below ``path`` (a folder all executors share). ``buckets`` is fixed when the index is created."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.buckets = spark, buckets
        location = f"{path}/digests-{buckets}"
        self.table = "digest_index_" + hashlib.md5(location.encode()).hexdigest()[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add the digests that the index lacks. One file per bucket and batch; running a batch again adds nothing."""
        new = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        new.select("digest", "keep_id", F.lit(batch).alias("batch")).repartition(self.buckets, "digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def dedup(self, docs: DataFrame, batch: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """One row per document: doc_id, keep_id, group_size (rows of this batch), kept, text_sha256.

        A text that an earlier batch brought is kept nowhere in this one; its keep_id is the earlier document.
        """
        digests = settle(docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text_digest(text_column).alias("digest")), "digests")
        groups = settle(digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
        self.append(groups, batch)
        held = self.rows().select("digest", F.col("keep_id").alias("held_id"), (F.col("batch") == batch).alias("is_new")).hint("merge")
        found = settle(groups.join(held, "digest").select("digest", F.col("held_id").alias("keep_id"), "group_size", "is_new"), "found")
        # One digest may hold a third of the rows: both sides are plain scans, so adaptive execution splits it.
        return digests.join(found, "digest").select(
            "doc_id", "keep_id", "group_size", (F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def drop_copies(self, docs: DataFrame, batch: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """The batch's kept rows with all their columns, one per distinct text."""
        key, digest, place = fresh(docs.columns, "__key"), fresh(docs.columns, "__digest"), fresh(docs.columns, "__place")
        kept = self.dedup(docs, batch, id_column, text_column).where("kept").select(
            id_key("doc_id").alias(key), F.unhex("text_sha256").alias(digest)
        )
        rows = docs.withColumns({key: id_key(F.col(id_column).cast("bigint")), digest: text_digest(text_column)})
        once = Window.partitionBy(key, digest).orderBy(key)
        return (
            rows.join(kept, [key, digest], "left_semi").withColumn(place, F.row_number().over(once)).where(F.col(place) == 1).select(*docs.columns)
        )


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    index = DigestIndex(spark, scratch(spark, "digest-index"))
    return index.dedup(spark.read.parquet(f"{folder}/documents.parquet"), "first")


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
