"""Incremental forms give what the batch forms give."""

from pyspark.sql import functions as F

from gleaner.operators import dedupe as dd
from gleaner.plans import edition_queries as eq
from gleaner.plans.testbed import items, table
from gleaner.session import cut_lineage
from gleaner.streaming import ingest as stream

FOLDER = "/root/testdata/sf0.001"


def test_ingest_stores_what_one_batch_would_keep_and_repeats_cleanly(spark):
    store = eq.scratch(spark, "store")
    rows = items(spark, FOLDER).drop("doc_id")
    first = rows.filter("collected_at < timestamp_ntz'2024-01-04 00:00:00'")
    second = rows.filter("collected_at >= timestamp_ntz'2024-01-04 00:00:00'")
    stream.ingest_batch(first, 0, store)
    stream.ingest_batch(second, 1, store)

    def snapshot():
        return sorted((r["id"], str(r["duplicate_of"]), r["batch_id"]) for r in stream.stored_items(spark, store).collect())

    once = snapshot()
    stream.ingest_batch(second, 1, store)
    assert snapshot() == once
    batch = dd.exact_dedupe(cut_lineage(dd.ingest_keys(rows)))
    assert {i for i, _, _ in once} == {r["id"] for r in batch.collect()}


def test_closed_windows_equal_the_batch_counts(spark):
    streamed = eq.stream_window_counters(spark, FOLDER)
    batch = stream.window_counters(table(spark, FOLDER, "events").withColumn("ts", F.col("ts").cast("timestamp")), "event_type")
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end", "newest", "oldest")}
    got = {tuple(r) for r in streamed.collect()}
    expected = {tuple(r) for r in batch.withColumns(times).collect()}
    last = max(r[0] for r in expected)
    assert got <= expected and {r for r in expected if r[0] < last} <= got


def test_running_roots_end_at_the_preferred_item(spark):
    rows = eq.stream_canonical(spark, FOLDER).collect()
    final = {}
    for r in rows:
        if r["replaced"] is not None:
            final[r["key"]] = r["root"]
        final.setdefault(r["key"], r["root"])
    # within one micro-batch rows of a key come in arrival order, so its last root is the preferred item
    preferred = dd.preferred_per(items(spark, FOLDER).withColumn("key", eq.F.sha2("raw_content", 256)), "key").count()
    assert len(rows) == items(spark, FOLDER).count() and 0 < len(final) <= preferred


def test_a_batch_without_dates_is_stored(spark):
    store = eq.scratch(spark, "store")
    rows = items(spark, FOLDER).drop("doc_id").limit(5)
    stream.ingest_batch(rows, 0, store)
    undated = rows.limit(1).withColumns({"id": F.lit("new"), "collected_at": F.lit(None).cast("timestamp_ntz"), "raw_content": F.lit("other words here"), "source_url": F.lit("https://e.com/new")})
    stream.ingest_batch(undated, 1, store)
    assert stream.stored_items(spark, store).filter("id = 'new'").count() == 1
