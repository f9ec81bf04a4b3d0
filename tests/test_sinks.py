"""Sinks whose work is spread over tasks: hot editions, long subtitle scripts."""

import glob

from pyspark.sql import functions as F

from gleaner.operators import store as st
from gleaner.operators import timeline as tl
from gleaner.plans.edition_queries import scratch


def local(path):
    return path.removeprefix("file:")


def test_an_edition_with_most_rows_is_written_by_many_tasks(spark):
    rows = spark.range(20_000).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("e"), F.col("id") % 70)).otherwise(F.lit("hot")).alias("edition"), F.sha2(F.col("id").cast("string"), 512).alias("text")
    )
    path, key = scratch(spark, "editions"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "128k")
    try:
        st.write_editions(rows, path)
        st.write_editions(rows.where("edition = 'hot'"), path)
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(f"{local(path)}/edition=hot/*.json")) > 4
    back = st.read_editions(spark, path, schema="id string, text string, edition string")
    assert back.count() == 20_000 and back.exceptAll(rows.select("id", "text", "edition")).count() == 0


def test_a_long_script_is_written_in_ordered_files(spark):
    segments = spark.range(6_000).select(F.when(F.col("id") < 5_900, F.lit("long")).otherwise(F.lit("short")).alias("script"), F.col("id").alias("seq"), F.concat(F.lit("Sentence "), F.col("id")).alias("text"))
    timeline = tl.narration_timeline(segments, "script", "seq", stretch=500)
    path = scratch(spark, "subtitles")
    tl.write_srt(tl.srt_blocks(timeline, "script", stretch=700), path, "script", parts=8)
    want = {r["script"]: r["srt"] for r in tl.srt_text(timeline, "script").collect()}
    for script, files in (("long", 2), ("short", 1)):
        names = sorted(glob.glob(f"{local(path)}/script={script}/part-*.txt"))
        assert len(names) >= files
        text = "".join(open(n, encoding="utf-8").read() for n in names)
        assert text.rstrip("\n") == want[script].rstrip("\n")
    assert want["long"].startswith("1\n00:00:00,000 --> ") and "\n\n5900\n" in want["long"]
