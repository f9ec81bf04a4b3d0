"""Tables on shared storage: keyed upsert, append logs, schema evolution, per-edition sinks, key lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import fixed_values as fv


def latest_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last by ``order``."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def upsert(old: DataFrame, new: DataFrame, key: str, now: Column, defaults: dict[str, Column] | None = None, replace: bool = False) -> DataFrame:
    """Next snapshot of a keyed table.

    ``new`` has at most one row per key. Partial updates merge onto the current row and then onto ``defaults``;
    ``replace`` takes the new row's values as they are, nulls included. ``created_at`` stays, ``updated_at`` becomes ``now``
    on touched rows.
    """
    defaults = defaults or {}
    columns = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in (key, "created_at", "updated_at")]
    o = old.select(F.col(key), F.struct(*[c for c in old.columns if c != key]).alias("o"))
    n = new.select(F.col(key), F.struct(*[c for c in new.columns if c != key]).alias("n"))
    joined = o.join(n, key, "full")
    touched = F.col("n").isNotNull()
    values = []
    for c in columns:
        have_old = F.col(f"o.{c}") if c in old.columns else None
        have_new = F.col(f"n.{c}") if c in new.columns else None
        if have_new is None:
            value = have_old
        elif replace:
            value = F.when(touched, have_new).otherwise(have_old) if have_old is not None else have_new
        else:
            value = F.coalesce(have_new, have_old) if have_old is not None else have_new
        values.append((F.coalesce(value, defaults[c]) if c in defaults else value).alias(c))
    created = F.coalesce("o.created_at", now) if "created_at" in old.columns else now
    updated = F.when(touched, now).otherwise(F.col("o.updated_at")) if "updated_at" in old.columns else now
    return joined.select(key, *values, created.alias("created_at"), updated.alias("updated_at"))


def evolve(rows: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add missing columns and fill nulls with defaults."""
    return rows.withColumns(
        {name: (F.coalesce(F.col(name), value) if name in rows.columns else value) for name, value in defaults.items()}
    )


def mock_flag(item_id: Column) -> Column:
    return item_id.startswith("mock-")


def pending_items(raw: DataFrame, processed: DataFrame, sources: DataFrame, limit: int | None = None) -> DataFrame:
    """Raw rows without a processed row, with their source; oldest first when limited."""
    done = processed.select(F.col("raw_item_id").alias("id")).distinct()
    s = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"), F.col("type").alias("source_type"), F.col("weight").alias("source_weight"))
    rows = raw.join(done, "id", "left_anti").join(s, "source_id")
    return rows.orderBy("collected_at", "arrival").limit(limit) if limit else rows


def items_with_source(raw: DataFrame, sources: DataFrame) -> DataFrame:
    """Raw rows with their source's name, type and weight. The registry is a hand-kept dimension: the optimiser
    broadcasts it while it is below its size limit."""
    s = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"), F.col("type").alias("source_type"), F.col("weight").alias("source_weight"))
    return raw.join(s, "source_id")


def map_duplicate_ids(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """``id, duplicate_of``: raw duplicates mapped to the processed row of their original (null: not processed)."""
    one = processed.groupBy("raw_item_id").agg(F.min("id").alias("processed_duplicate_of"))
    marked = raw.filter("duplicate_of is not null").select("id", "duplicate_of")
    return marked.join(one, marked["duplicate_of"] == one["raw_item_id"], "left").select("id", "duplicate_of", "processed_duplicate_of")


def audit_log_scan(log: DataFrame, raw_item_id: str | Column | None = None) -> DataFrame:
    rows = log.filter(F.col("raw_item_id") == raw_item_id) if raw_item_id is not None else log
    return rows.orderBy("created_at", "raw_item_id")


# --- sinks ------------------------------------------------------------------------------------------------------------
def append_log(rows: DataFrame, path: str, *partition_by: str) -> None:
    """Add rows to a log; a reader sees all of one call's rows in a file or none."""
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_editions(rows: DataFrame, path: str, scope: str = "edition", fmt: str = "json") -> None:
    """One folder per edition; writing an edition again replaces only that edition.

    Rows are dealt by edition, and adaptive execution then evens the tasks out by size: small editions share one, and an edition
    that holds most rows is written by many.
    """
    writer = rows.hint("rebalance", scope).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope)
    writer.format(fmt).save(path)


def read_editions(spark: SparkSession, path: str, fmt: str = "json", schema: str | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


ITEM_DEFAULTS: dict[str, Column | str] = {
    "source_url": "", "source_name": "", "source_type": "community", "raw_content": "", "summary": "", "category": "",
    "article_title": "", "article_body": "", "intro_summary": "", "exclusion_reason": "",
}
ITEM_SCORE_COLUMNS = ["source_weight", "score", "news_value_score", "ai_relevance_score", "game_relevance_score", "cross_relevance_score"]
ITEM_FLAG_COLUMNS = ["selected", "is_mock", "is_topic_candidate"]
ITEM_LIST_COLUMNS = ["keywords", "official_sources", "script_segments", "ai_tags", "game_tags"]


def item_defaults() -> dict[str, Column]:
    """What a processed item's missing fields read as."""
    values = {name: F.lit(text) for name, text in ITEM_DEFAULTS.items()}
    values.update({name: F.lit(0) for name in ITEM_SCORE_COLUMNS})
    values.update({name: F.lit(False) for name in ITEM_FLAG_COLUMNS})
    values.update({name: F.array().cast("array<string>") for name in ITEM_LIST_COLUMNS})
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    values.update({"published_at": epoch, "collected_at": epoch})
    return values


assert ITEM_DEFAULTS["source_type"] in fv.SOURCE_TYPES
