"""Incremental forms: micro-batch ingest, bounded-state exact dedupe, window counters, running group roots."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import text as tx
from gleaner.functions import urls as ul
from gleaner.operators import dedupe as dd
from gleaner.operators.item_store import ItemStore
from gleaner.operators.ledger import Ledger, absolute, read_or_empty
from gleaner.session import cut_lineage, written

def stored_items(spark: SparkSession, store: str) -> DataFrame:
    """Inserted rows with their current ``duplicate_of``, of finished runs only."""
    return ItemStore(spark, store).items()


def ingest_batch(batch: DataFrame, batch_id: int, store: str, hours: int = fv.DEDUPE_WINDOW_HOURS) -> None:
    """Exact dedupe against everything stored, near-duplicate marks against the last hours, append.

    One run of the store's ledger: rows, marks and keys appear together when it is done. A batch that is done already is left alone, one
    that failed is done anew. Items without a URL or without content have no such key and are always new under it.
    """
    spark = batch.sparkSession
    shop = ItemStore(spark, store)
    state = shop.ledger.state()
    run_id = f"batch-{batch_id}"
    if run_id in state.done:
        return
    batch = cut_lineage(batch)
    if batch.isEmpty():
        return
    with shop.ledger.run(run_id, {"hours": hours}) as run:
        keys = cut_lineage(dd.ingest_keys(batch))
        known = shop.keys.seen(keys, [*state.hidden, run.attempt])
        fresh = dd.exact_dedupe(keys.join(known, "id", "left_anti"))
        rows = cut_lineage(batch.join(keys.select("id", "url_key", "hash_key"), "id").join(fresh, "id", "left_semi"))
        # A batch without any date has no window: its rows are stored, compared with each other only.
        now = rows.agg(F.max("collected_at")).first()[0] or datetime.max
        since = now - timedelta(hours=hours)
        window = shop.items(state, since.date())
        found = cut_lineage(dd.windowed_near_duplicates(rows, window, F.lit(since).cast("timestamp_ntz")))
        new = rows.join(found.filter("is_new").select("id", "duplicate_of", "duplicate_score"), "id", "left").withColumns(
            {"batch_id": F.lit(batch_id).cast("bigint"), "collected_date": F.to_date("collected_at")}
        )
        shop.write_raw(new, run)
        shop.write_marks(found.filter("not is_new").select("id", "duplicate_of", F.lit(batch_id).cast("bigint").alias("batch_id")), run)
        shop.keys.append(rows.select("id", "url_key", "hash_key"), run.attempt)
        run.result.update(fetched=batch.count(), inserted=rows.count())


def start_ingest(items: DataFrame, store: str, checkpoint: str, hours: int = fv.DEDUPE_WINDOW_HOURS):
    """Run a streaming frame of items through :func:`ingest_batch` until the available input is used up."""
    return (
        items.writeStream.foreachBatch(lambda df, n: ingest_batch(df, n, store, hours))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedupe(events: DataFrame, keys: list[str], ts: str = "ts", hours: int = fv.DEDUPE_WINDOW_HOURS) -> DataFrame:
    """Exact repeats inside the window dropped; state is bounded by the watermark."""
    return events.withWatermark(ts, f"{hours} hours").dropDuplicatesWithinWatermark(keys)


def window_counters(events: DataFrame, source: str, ts: str = "ts", hours: int = fv.COLLECTION_WINDOW_HOURS, late: str | None = None) -> DataFrame:
    """Counts and newest/oldest time per source and window; the same plan serves batch and stream."""
    rows = events.withWatermark(ts, late) if late else events
    return rows.groupBy(F.window(ts, f"{hours} hours").alias("w"), F.col(source)).agg(
        F.count("*").alias("fetched"), F.max(ts).alias("newest"), F.min(ts).alias("oldest")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), source, "fetched", "newest", "oldest")


NO_DATE = 2**62
_BEST = "other int, published_us bigint, lighter int, collected_us bigint, batch bigint, arrival bigint, id string"
_STATE = f"key string, best struct<{_BEST.replace(' ', ':').replace(',:', ',')}>, expires_us bigint"
_ROOTS = "key string, id string, root string, replaced string, batch_id bigint"


def follow_roots(batch: DataFrame, batch_id: int, store: str, key: str = "content", blocks: int | None = None) -> None:
    """Running preferred item of every exact key (content or URL): each row's root as known when it came, and the root it replaced.

    One run of the store's ledger. A running minimum in two levels: rows are dealt to blocks by arrival; inside (key, block) it is a window,
    and each block starts from the best of the blocks before it and of the key's stored root, one row per key and block. A key with a
    third of all rows is as many windows as there are blocks. Stored roots are one row per key and expire ``DEDUPE_WINDOW_HOURS`` of event
    time after they were last seen. A missing date is later than any other; a row without a key is its own root.
    """
    spark = batch.sparkSession
    ledger = Ledger(spark, f"{store}/runs")
    state = ledger.state()
    run_id = f"roots-{batch_id}"
    if run_id in state.done:
        return
    by = tx.content_hash(F.col("raw_content")) if key == "content" else ul.canonical_url(F.col("source_url"))

    def micros(column: str) -> Column:
        return F.coalesce(F.unix_micros(F.col(column).cast("timestamp")), F.lit(NO_DATE))

    best = F.struct(
        F.when(F.col("source_type") == "official", 0).otherwise(1).alias("other"), micros("published_at").alias("published_us"),
        (-F.coalesce("source_weight", F.lit(0))).alias("lighter"), micros("collected_at").alias("collected_us"),
        F.lit(batch_id).cast("bigint").alias("batch"), F.col("arrival").cast("bigint").alias("arrival"), F.col("id").alias("id"),
    )
    rows = batch.select(by.alias("key"), best.alias("best"))
    rows = rows.repartitionByRange(blocks, "best.arrival") if blocks else rows.repartitionByRange("best.arrival")
    hold = F.lit(fv.DEDUPE_WINDOW_HOURS * 3_600_000_000)
    with ledger.run(run_id) as run:
        dealt = written(rows.withColumn("block", F.spark_partition_id()))
        # rows without a key would all meet under the null one
        keyed, alone = dealt.filter("key IS NOT NULL"), dealt.filter("key IS NULL")
        before_us = ledger.records().agg(F.max(F.get_json_object("result", "$.seen_us").cast("bigint"))).first()[0]
        now_us = None if before_us is None else before_us - fv.DEDUPE_WINDOW_HOURS * 3_600_000_000
        held = read_or_empty(spark, absolute(store, state.below("state")), _STATE)
        held = held if now_us is None else held.filter(F.col("expires_us") >= now_us)
        firsts = written(keyed.groupBy("key", "block").agg(F.min("best").alias("first")))
        earlier = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        starts = firsts.join(held.select("key", F.col("best").alias("held")), "key", "left").select(
            "key", "block", F.least(F.min("first").over(earlier), F.col("held")).alias("start")
        )
        place = Window.partitionBy("key", "block").orderBy("best.arrival", "best.id")
        followed = keyed.withColumns(
            {
                "own": F.min("best").over(place.rowsBetween(Window.unboundedPreceding, 0)),
                "past": F.min("best").over(place.rowsBetween(Window.unboundedPreceding, -1)),
            }
        ).join(starts, ["key", "block"])
        root, past = F.least("own", "start"), F.least("past", "start")
        found = followed.select("key", F.col("best.id").alias("id"), root["id"].alias("root"), F.when(past["id"] != root["id"], past["id"]).alias("replaced"))
        found = found.unionByName(alone.select("key", F.col("best.id").alias("id"), F.col("best.id").alias("root"), F.lit(None).cast("string").alias("replaced")))
        found.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.parquet(f"{store}/roots/{run.attempt}")
        floor = F.lit(now_us if now_us is not None else 0)
        seen = F.when(F.col("best.collected_us") == NO_DATE, floor).otherwise(F.greatest(F.col("best.collected_us"), floor))
        new = firsts.groupBy("key").agg(F.min("first").alias("best")).withColumn("expires_us", seen + hold)
        kept = held.unionByName(new).groupBy("key").agg(F.min("best").alias("best"), F.max("expires_us").alias("expires_us"))
        kept.write.parquet(f"{store}/state/{run.attempt}")
        run.adds += [f"roots/{run.attempt}", f"state/{run.attempt}"]
        run.removes += state.below("state")
        last = dealt.filter(F.col("best.collected_us") != NO_DATE).agg(F.max("best.collected_us")).first()[0]
        run.result["seen_us"] = max(last or 0, before_us or 0) or None


def start_roots(items: DataFrame, store: str, checkpoint: str, key: str = "content"):
    """Run a streaming frame of items through :func:`follow_roots` until the available input is used up."""
    return (
        items.writeStream.foreachBatch(lambda df, n: follow_roots(df, n, store, key))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def followed_roots(spark: SparkSession, store: str) -> DataFrame:
    """``key, id, root, replaced, batch_id`` of all finished batches."""
    return read_or_empty(spark, absolute(store, Ledger(spark, f"{store}/runs").state().below("roots")), _ROOTS)
