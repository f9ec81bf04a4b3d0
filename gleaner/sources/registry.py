"""Source registry: validation, routing, caps, and lookups by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import urls as ul


def corrected_names(sources: DataFrame) -> DataFrame:
    """Registry with the display names that replace a source's own name."""
    fixes = F.create_map(*[F.lit(x) for pair in fv.SOURCE_NAME_CORRECTIONS.items() for x in pair])
    return sources.withColumn("name", F.coalesce(F.try_element_at(fixes, F.col("id")), F.col("name")))


def violations(sources: DataFrame) -> DataFrame:
    """One row per broken rule: ``id, problem``. An empty result means the registry is valid."""
    def missing(name: str) -> Column:
        return F.coalesce(F.col(name) == "", F.lit(True))

    def outside(name: str, allowed: list[str]) -> Column:
        return ~F.coalesce(F.col(name).isin(*allowed), F.lit(False))

    rules = [
        ("bad id", ~F.coalesce(F.col("id").rlike("^[a-z0-9-]+$"), F.lit(False))),
        ("empty name", missing("name")),
        ("bad url", F.col("url").isNotNull() & ~ul.host(F.col("url")).rlike(".")),
        ("bad source_group", outside("source_group", fv.SOURCE_GROUPS)),
        ("bad source_type", outside("source_type", fv.SOURCE_TYPES)),
        ("bad priority", outside("priority", fv.PRIORITIES)),
        ("bad source_weight", ~F.coalesce(F.col("source_weight").between(1, 100), F.lit(False))),
        ("empty suggested_frequency", missing("suggested_frequency")),
        ("bad collection_strategy", outside("collection_strategy", list(fv.STRATEGY_ROUTES))),
        ("bad max_items_per_window", F.col("max_items_per_window").isNotNull() & ~F.col("max_items_per_window").between(1, 1000)),
        ("empty notes", F.coalesce(F.col("notes") == "", F.lit(False))),
    ]
    row_problems = sources.select(
        "id", F.explode(F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))).alias("problem")
    )
    same_id = sources.groupBy("id").count().filter("count > 1").select("id", F.lit("duplicate source id").alias("problem"))
    named = corrected_names(sources)
    same_name = named.groupBy("name").agg(F.count("*").alias("n"), F.max("id").alias("id")).filter("n > 1").select(
        "id", F.lit("duplicate source name").alias("problem")
    )
    return row_problems.unionByName(same_id).unionByName(same_name)


def routing_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fv.STRATEGY_ROUTES.items()), "collection_strategy string, route string")


def routed(sources: DataFrame) -> DataFrame:
    """Registry with the extractor of each strategy (null: none)."""
    return sources.join(F.broadcast(routing_table(sources.sparkSession)), "collection_strategy", "left")


def with_source(items: DataFrame, sources: DataFrame, how: str = "left") -> DataFrame:
    """Items with their source's id, type and weight; unknown names weigh 50. The registry is a small dimension that
    people maintain by hand, so the optimiser broadcasts it by its size."""
    looked_up = sources.select(
        F.col("name").alias("source_name"), F.col("id").alias("registry_id"),
        F.col("source_weight").alias("_weight"), F.col("max_items_per_window").alias("source_cap"),
    )
    return items.join(looked_up, "source_name", how).withColumn(
        "registry_weight", F.coalesce("_weight", F.lit(fv.DEFAULT_SOURCE_WEIGHT))
    ).drop("_weight")


def cap_per_source(items: DataFrame, order: list[Column], default_cap: int = fv.MAX_ITEMS_PER_SOURCE, most: int = 1000) -> DataFrame:
    """First rows of each source in arrival order; ``source_cap`` overrides the default. No cap may be above ``most``
    (the job fails on one; :func:`violations` reports such registry rows), so the rank filter becomes a per-partition
    group limit before the shuffle and no task holds a whole source."""
    if default_cap > most:
        raise ValueError(f"default_cap {default_cap} is above most {most}")
    given = F.coalesce(F.col("source_cap"), F.lit(default_cap))
    limit = F.when(given <= most, given).otherwise(F.raise_error(F.concat(F.lit("source cap above the largest: "), given.cast("string"))).cast("int"))
    ranked = items.withColumn("_cap", limit).withColumn("rank_in_source", F.row_number().over(Window.partitionBy("source_name").orderBy(*order)))
    return ranked.filter((F.col("rank_in_source") <= most) & (F.col("rank_in_source") <= F.col("_cap"))).drop("_cap")


def cap_total(items: DataFrame, order: list[Column], key: str, limit: int = fv.MAX_ITEMS_TOTAL) -> tuple[DataFrame, DataFrame]:
    """First ``limit`` rows overall, and how many rows of each source stayed behind."""
    kept = items.orderBy(*order).limit(limit)
    totals = items.groupBy("source_name").agg(F.count("*").alias("fetched"))
    used = kept.groupBy("source_name").agg(F.count("*").alias("kept"))
    counts = totals.join(used, "source_name", "left").select(
        "source_name", "fetched", F.coalesce("kept", F.lit(0).cast("bigint")).alias("kept"),
        (F.col("fetched") - F.coalesce("kept", F.lit(0))).alias("limited_out"),
    )
    return kept, counts
