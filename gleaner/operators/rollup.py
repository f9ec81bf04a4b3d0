"""Roll-ups over time: weekly digests, day and week spines, collection-window counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import dates as dt
from gleaner.functions import text as tx
from gleaner.sources.registry import routed


def weekly_candidates(items: DataFrame, start: Column, end: Column, limit: int = fv.WEEKLY_LIMIT, include_mock: bool = False) -> DataFrame:
    """Selected canonical items published or collected in the range, best first."""
    mock = F.lit(True) if include_mock else ~F.col("is_mock")
    rows = items.filter(
        F.col("selected") & mock & F.col("duplicate_of").isNull()
        & (F.col("published_at").between(start, end) | F.col("collected_at").between(start, end))
    )
    return rows.orderBy(F.desc("score"), F.desc("source_weight"), F.desc("published_at"), "arrival").limit(limit)


def weekly_digest(audit: DataFrame, persisted: DataFrame, limit: int = fv.WEEKLY_LIMIT, include_mock: bool = False) -> DataFrame:
    """Best items of every ISO week from the daily audits' selected entries.

    ``audit``: ``edition`` (date), ``generated_at`` and the audit columns. A later day replaces an earlier entry of the
    same id; the persisted row is preferred, otherwise the entry is rebuilt; mock rows are left out. Ties keep the day
    an id first appeared. All weeks are computed together.
    """
    chosen = audit.filter("bucket = 'selected'").withColumn("week", F.date_trunc("week", F.col("edition").cast("timestamp_ntz")).cast("date"))
    # the last day's entry and the first day seen, in one aggregate per week and id
    entries = chosen.groupBy("week", "id").agg(
        F.max_by(
            F.struct("edition", "generated_at", "title", "category", "source_name", "source_url", "score", "source_weight", "freshness_hours", "official_sources"),
            "edition",
        ).alias("e"),
        F.min("edition").alias("first_day"),
    )
    p = persisted.select("id", F.struct(*[c for c in persisted.columns if c != "id"]).alias("p"))
    joined = entries.join(p, "id", "left")
    if not include_mock:
        joined = joined.filter(~F.coalesce("p.is_mock", F.lit(False)))
    rebuilt_text = F.concat("e.title", F.lit(fv.WEEKLY_REBUILT_SUFFIX))
    rebuilt_category = F.coalesce(tx.null_if_blank(F.col("e.category")), F.lit("AI x Game"))
    nothing = F.array().cast("array<string>")
    rebuilt_sources = F.when(F.size("e.official_sources") > 0, F.col("e.official_sources")).otherwise(F.array("e.source_url"))
    here = F.col("p").isNotNull()

    def pick(name: str, rebuilt: Column) -> Column:
        return F.when(here, F.col(f"p.{name}")).otherwise(rebuilt).alias(name)

    rows = joined.select(
        "week", "id", "first_day", here.alias("was_persisted"),
        pick("article_title", F.col("e.title")),
        pick("category", rebuilt_category),
        pick("source_name", F.col("e.source_name")),
        pick("source_url", F.col("e.source_url")),
        pick("score", F.col("e.score")),
        pick("source_weight", F.col("e.source_weight")),
        pick("published_at", dt.published_from_freshness(F.col("e.generated_at"), F.col("e.freshness_hours"))),
        pick("summary", rebuilt_text),
        pick("intro_summary", rebuilt_text),
        pick("article_body", rebuilt_text),
        pick("cross_relevance_score", F.col("e.score")),
        pick("official_sources", rebuilt_sources),
        pick("ai_tags", nothing),
        pick("game_tags", nothing),
        pick("keywords", nothing),
    )
    order = Window.partitionBy("week").orderBy(F.desc("score"), F.desc("source_weight"), F.desc("published_at"), "first_day", "id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
    return ranked.withColumn("week_key", dt.iso_week_key(F.col("week").cast("timestamp_ntz")))


def day_spine(bounds: DataFrame, start: str = "start_day", end: str = "end_day") -> DataFrame:
    """Every day of each row's inclusive range."""
    return bounds.withColumn("day", F.explode(F.sequence(F.to_date(F.col(start)), F.to_date(F.col(end)))))


def period_coverage(editions: DataFrame, today: Column, days: int = 7, weeks: int = 4) -> DataFrame:
    """Last days and ISO weeks, newest first, with a flag for those that have a report. ``editions``: ``edition`` (date)."""
    spark = editions.sparkSession
    one = spark.range(1).select(today.cast("date").alias("today"))
    day_rows = one.select(
        F.lit("day").alias("kind"), F.explode(F.sequence(F.date_sub("today", days - 1), F.col("today"))).alias("start")
    ).select("kind", "start", F.date_format("start", "yyyy-MM-dd").alias("period"))
    monday = F.date_trunc("week", F.col("today").cast("timestamp_ntz")).cast("date")
    week_rows = one.select(
        F.lit("week").alias("kind"), F.explode(F.sequence(F.date_sub(monday, 7 * (weeks - 1)), monday, F.expr("interval 7 days"))).alias("start")
    ).select("kind", "start", dt.iso_week_key(F.col("start").cast("timestamp_ntz")).alias("period"))
    have = editions.select(F.date_format("edition", "yyyy-MM-dd").alias("period")).distinct().unionByName(
        editions.select(dt.iso_week_key(F.col("edition").cast("timestamp_ntz")).alias("period")).distinct()
    )
    spine = day_rows.unionByName(week_rows)
    return spine.join(have.withColumn("_has", F.lit(True)), "period", "left").select(
        "kind", "period", "start", F.coalesce("_has", F.lit(False)).alias("has_report")
    ).orderBy("kind", F.desc("start"))


def window_stats(items: DataFrame, key: str, start: Column, end: Column, samples: int = 5) -> DataFrame:
    """Counters per source; rows outside the window are counted, never dropped. The first samples come from a ranked
    limit, so only ``samples`` rows per source are ever gathered."""
    inside = F.coalesce(F.col("published_at").between(start, end), F.lit(False))
    counted = items.groupBy(key).agg(
        F.count("*").alias("fetched"),
        F.max("published_at").alias("newest_published_at"),
        F.min("published_at").alias("oldest_published_at"),
        F.count_if(inside).alias("within_window"),
        F.count_if(~inside).alias("outside_window"),
    )
    if not samples:
        return counted
    first = items.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("arrival"))).filter(F.col("_n") <= samples)
    taken = first.groupBy(key).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("_n", "title", "url", "published_at"))),
            lambda x: F.struct(x["title"].alias("title"), x["url"].alias("url"), x["published_at"].alias("published_at")),
        ).alias("samples")
    )
    return counted.join(taken, key, "left")


def source_audit(sources: DataFrame, items: DataFrame, failures: DataFrame, start: Column, end: Column, extractors: list[str]) -> DataFrame:
    """One row per registered source. ``items``: source_name, title, url, published_at, arrival; ``failures``: source_name, error."""
    stats = window_stats(items, "source_name", start, end)
    failed = failures.groupBy("source_name").agg(F.count("*").alias("failures"))
    base = routed(sources).withColumnRenamed("name", "source_name")
    joined = base.join(stats, "source_name", "left").join(failed, "source_name", "left")
    zero = F.lit(0).cast("bigint")
    joined = joined.withColumns({c: F.coalesce(c, zero) for c in ("fetched", "within_window", "outside_window", "failures")})
    status = (
        F.when(~F.coalesce(F.col("route").isin(*extractors), F.lit(False)), F.lit("no_collector"))
        .when((F.col("collection_strategy") != "manual_markdown") & F.coalesce(F.col("url") == "", F.lit(True)), F.lit("no_url"))
        .when((F.col("failures") > 0) & (F.col("fetched") > 0), F.lit("partial_failure"))
        .when(F.col("failures") > 0, F.lit("failed"))
        .when(F.col("fetched") > 0, F.lit("ok"))
        .otherwise(F.lit("empty"))
    )
    return joined.withColumn("status", status).select(
        F.col("id").alias("source_id"), "source_name", "collection_strategy", "status", "fetched", "failures", "within_window",
        "outside_window", "newest_published_at", "oldest_published_at", "samples",
    )


def run_totals(rows: DataFrame, scope: list[str], outcome: str) -> DataFrame:
    return rows.groupBy(*scope, outcome).agg(F.count("*").alias("n"))
