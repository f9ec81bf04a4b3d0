"""The collection step as one plan: caps per source, the rule prefilter of low-trust sources, the cap over all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import dates as dt
from gleaner.operators.screening import Signals, prefilter_score
from gleaner.sources.registry import cap_per_source


def collect(
    items: DataFrame, order: list[Column], signals: Signals = Signals(), low_trust: list[str] | None = None,
    default_cap: int = fv.MAX_ITEMS_PER_SOURCE, total: int = fv.MAX_ITEMS_TOTAL,
) -> tuple[DataFrame, DataFrame]:
    """Collected items, and per source how many were fetched, capped, filtered, left out by the total, and collected.

    ``items``: ``source_name, source_cap, title, excerpt, published_at`` and what ``order`` (the order in a feed) needs. Each source gives
    its first rows up to its cap. Of a low-trust source only those with a sufficient prefilter score go on, best and newest first, and
    keep ``prefilter_score`` and ``prefilter_signals`` (null for other sources). Then the first ``total`` rows stay, source by source.
    Caps are ranked limits and the total is an ordered limit, so no task holds a source or the whole. Only what the caps leave is scored.
    """
    capped = cap_per_source(items, order, default_cap)
    flagged = F.col("source_name").isin(*(low_trust or fv.PREFILTER_SOURCE_IDS))
    scored = prefilter_score(capped.filter(flagged), signals).filter(F.col("prefilter_score") >= fv.PREFILTER_MIN_SCORE)
    best = Window.partitionBy("source_name").orderBy(F.desc("prefilter_score"), F.desc(dt.micros(F.col("published_at"))), "rank_in_source")
    scored = scored.withColumn("rank_in_source", F.row_number().over(best))
    rows = capped.filter(~flagged).unionByName(scored, allowMissingColumns=True)
    kept = rows.orderBy("source_name", "rank_in_source").limit(total)

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("source_name").agg(F.count("*").alias(name))

    counts = count(items, "fetched")
    for df, name in ((capped, "_capped"), (rows, "_rows"), (kept, "collected")):
        counts = counts.join(count(df, name), "source_name", "left").fillna(0, [name])
    return kept, counts.select(
        "source_name", "fetched", (F.col("fetched") - F.col("_capped")).alias("over_cap"), (F.col("_capped") - F.col("_rows")).alias("filtered"),
        (F.col("_rows") - F.col("collected")).alias("limited_out"), "collected",
    )
