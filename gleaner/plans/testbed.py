"""The common item view over a documents table (``doc_id, text, lang, source``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import dates as dt
from gleaner.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def _first_line(text):
    """The first line that is not blank, as it is; the lines after it are not looked at."""
    line = F.regexp_extract(text, r"(?s)^(?: *+\r?\n)*+(.*?)(?=\r?\n|\z)", 1)
    return F.when(F.trim(line) != "", line).otherwise(F.lit(""))


def items(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    source_no = F.substring("source", 4, 10).cast("int")
    minutes = (F.col("doc_id") * 37) % 43200
    second = F.col("doc_id") % 10 == 1
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        (minutes * 1_000_000_000 + F.col("doc_id")).alias("arrival"),
        _first_line("text").alias("article_title"),
        F.col("text").alias("raw_content"),
        F.col("source").alias("source_name"),
        F.element_at(F.array(*[F.lit(t) for t in ("ai_media", "game_media", "ai_game_media", "official", "community")]), source_no % 5 + 1).alias("source_type"),
        (30 + (source_no * 7) % 66).cast("int").alias("source_weight"),
        (dt.ntz("2024-01-01 00:00:00") + F.expr("make_dt_interval(0, 0, cast((doc_id * 37) % 43200 as int), 0)")).alias("published_at"),
        (dt.ntz("2024-01-01 01:00:00") + F.expr("make_dt_interval(0, 0, cast((doc_id * 37) % 43200 as int), 0)")).alias("collected_at"),
        F.concat(
            F.lit("https://news.example.com/a/"),
            (F.col("doc_id") - second.cast("int")).cast("string"),
            F.when(second, F.lit("?utm_source=feed")).otherwise(F.lit("")),
        ).alias("source_url"),
        "doc_id",
    )


assert fv.SOURCE_TYPES == ["ai_media", "game_media", "ai_game_media", "official", "community"]
