"""Scripts to timed segments and subtitles, for any number of scripts at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import dates as dt
from gleaner.functions import text as tx
from gleaner.session import written


def script_segments(editions: DataFrame, items: DataFrame) -> DataFrame:
    """Spoken segments per edition: ``edition, seq, item_id, title, text``.

    ``items`` needs ``edition, rank`` (1-based) and the text fields. An edition without items gets the closing-only
    text. The number of items per edition is a count joined back, so nothing is gathered.
    """
    counts = items.groupBy("edition").agg(F.count("*").alias("n"))
    rows = editions.select("edition").distinct().join(counts, "edition", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))

    def segment(seq: Column, item_id: Column, title: Column, text: Column) -> Column:
        return F.struct(seq.cast("bigint").alias("seq"), item_id.alias("item_id"), title.alias("title"), text.alias("text"))

    show = F.lit("show")
    opening = F.when(
        F.col("n") == 0, F.lit(fv.SCRIPT_EMPTY)
    ).otherwise(F.concat(F.lit(fv.SCRIPT_INTRO[0]), F.col("n").cast("string"), F.lit(fv.SCRIPT_INTRO[1])))
    frame = F.array_compact(
        F.array(
            segment(F.lit(0), show, F.lit("Intro"), opening),
            F.when(F.col("n") > 0, segment(F.col("n") * 2, show, F.lit("Outro"), F.lit(fv.SCRIPT_OUTRO))),
        )
    )
    framed = rows.select("edition", F.inline(frame))
    rank = F.col("rank").cast("bigint")
    headline = tx.first_non_blank(F.col("article_title"), F.col("summary"), F.col("raw_content"), default=fv.SCRIPT_NO_DETAILS)
    detail = tx.first_non_blank(F.col("intro_summary"), F.col("summary"), F.col("article_body"), default=fv.SCRIPT_NO_DETAILS)
    title = F.coalesce(tx.null_if_blank(F.col("article_title")), tx.null_if_blank(F.col("summary")), F.lit("News item"))
    spoken = F.concat(rank.cast("string"), F.lit("、"), headline, F.lit("。"), detail)
    body = items.join(counts, "edition").select(
        "edition",
        F.inline(
            F.array_compact(
                F.array(
                    segment(rank * 2 - 1, F.col("id"), title, spoken),
                    F.when(rank < F.col("n"), segment(rank * 2, F.col("id"), F.lit("Transition"), F.lit(fv.SCRIPT_TRANSITION))),
                )
            )
        ),
    )
    return framed.unionByName(body)


def sentences(segments: DataFrame, text: str = "text") -> DataFrame:
    """One row per sentence, ``sentence_no`` inside the segment."""
    keep = [c for c in segments.columns if c != text]
    return segments.select(*keep, F.posexplode(tx.split_sentences(F.col(text))).alias("sentence_no", "text"))


def narration_timeline(
    segments: DataFrame, script: str, order: str, duration: Callable[[Column], Column] = dt.speech_ms, split: bool = True, stretch: int = 4096
) -> DataFrame:
    """Timed segments: ``segment_no`` and ``segment_id`` inside the script, ``duration_ms, start_ms, end_ms``.

    ``order`` is a number that orders a script's segments. The running sum has two levels, so a very long script is not
    one task: inside stretches of ``stretch`` order values, then over the totals of the stretches before.
    """
    rows = sentences(segments) if split else segments.withColumn("sentence_no", F.lit(0))
    # sentences are found once; totals read them without texts
    timed = written(rows.withColumns({"duration_ms": duration(F.col("text")), "_part": F.floor(F.col(order) / stretch)}))
    totals = timed.groupBy(script, "_part").agg(F.sum("duration_ms").alias("_ms"), F.count("*").alias("_rows"))
    before = Window.partitionBy(script).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    offsets = totals.select(
        script, "_part", F.coalesce(F.sum("_ms").over(before), zero).alias("_ms"), F.coalesce(F.sum("_rows").over(before), zero).alias("_rows")
    )
    place = Window.partitionBy(script, "_part").orderBy(order, "sentence_no")
    timed = timed.withColumns(
        {"_n": F.row_number().over(place), "_end": F.sum("duration_ms").over(place.rowsBetween(Window.unboundedPreceding, 0))}
    ).join(offsets, [script, "_part"])
    timed = timed.withColumns({"segment_no": (F.col("_n") + F.col("_rows")).cast("int"), "end_ms": F.col("_end") + F.col("_ms")})
    number = F.col("segment_no").cast("string")
    return timed.withColumns(
        {
            "start_ms": F.col("end_ms") - F.col("duration_ms"),
            "segment_id": F.concat(F.lit("tts-"), F.lpad(number, F.greatest(F.length(number), F.lit(3)), F.lit("0"))),
        }
    ).drop("_part", "_n", "_end", "_ms", "_rows")


def item_spans(timeline: DataFrame, script: str, item: str) -> DataFrame:
    """First start and last end of each item, and progress through the script."""
    spans = timeline.groupBy(script, item).agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))
    totals = spans.groupBy(script).agg(F.max("end_ms").alias("total_ms"))
    return spans.join(totals, script).withColumn(
        "progress", F.when(F.col("total_ms") > 0, F.col("end_ms") / F.col("total_ms")).otherwise(F.lit(0.0))
    )


def spans_for_items(items: DataFrame, timeline: DataFrame, script: str, item: str, position: str) -> DataFrame:
    """Span of every listed item. An item nobody speaks about takes the segment at its own position, if there is one."""
    timeline = written(timeline.select(script, item, "segment_no", "start_ms", "end_ms"))
    spans = item_spans(timeline, script, item).select(script, item, "start_ms", "end_ms")
    total = timeline.groupBy(script).agg(F.max("end_ms").alias("total_ms"))
    counts = items.groupBy(script).agg(F.count("*").alias("n_items"))
    by_place = timeline.select(
        script, F.col("segment_no").alias(position), F.col("start_ms").alias("_s"), F.col("end_ms").alias("_e")
    )
    joined = items.join(spans, [script, item], "left").join(by_place, [script, position], "left")
    joined = joined.join(total, script, "left").join(counts, script, "left")
    zero = F.lit(0).cast("bigint")
    start = F.coalesce("start_ms", "_s", zero)
    end = F.coalesce("end_ms", "_e", start)
    progress = F.when(F.col("total_ms") > 0, end / F.col("total_ms")).otherwise(F.col(position) / F.greatest(F.col("n_items"), F.lit(1)))
    return joined.withColumns({"start_ms": start, "end_ms": end, "progress": progress}).drop("_s", "_e", "total_ms", "n_items")


def legacy_timeline(items: DataFrame, scope: str, order: str) -> DataFrame:
    """One span per item, one after the other, timed by the length of its body. A scope holds one edition's selection."""
    w = Window.partitionBy(scope).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    timed = items.withColumn("_ms", dt.article_ms(F.col("article_body"))).withColumn("end_ms", F.sum("_ms").over(w))
    return timed.withColumn("start_ms", F.col("end_ms") - F.col("_ms")).drop("_ms")


def srt_blocks(timeline: DataFrame, *scope: str, stretch: int = 4096) -> DataFrame:
    """Numbered subtitle blocks per script (or per script and item), one row each: ``scope, number, block``.

    Segments of a scope are numbered in time order, as in :func:`narration_timeline` stretch by stretch, so a script of any length is
    many small windows.
    """
    rows = timeline.withColumn("_part", F.floor(F.col("segment_no") / stretch))
    totals = rows.groupBy(*scope, "_part").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*scope).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*scope, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_earlier"))
    place = F.row_number().over(Window.partitionBy(*scope, "_part").orderBy("start_ms", "segment_no"))
    numbered = rows.withColumn("_place", place).join(offsets, [*scope, "_part"]).withColumn("number", F.col("_place") + F.col("_earlier"))
    times = F.concat(dt.srt_time(F.col("start_ms")), F.lit(" --> "), dt.srt_time(F.col("end_ms")))
    return numbered.select(*scope, "number", F.concat_ws("\n", F.col("number").cast("string"), times, "text", F.lit("")).alias("block"))


def write_srt(blocks: DataFrame, path: str, scope: str, parts: int | None = None) -> None:
    """One folder per script. Its files, in the order of their names, are the subtitle text: blocks are dealt by ranges of
    (script, number) and written in order, so a long script is many files and no task or row holds it whole."""
    keys = [F.col(scope), F.col("number")]
    dealt = blocks.repartitionByRange(parts, *keys) if parts else blocks.repartitionByRange(*keys)
    ordered = dealt.sortWithinPartitions(*keys).select(scope, "block")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope).text(path)


def srt_text(timeline: DataFrame, *scope: str) -> DataFrame:
    """Subtitle text in one row per script (or per script and item), for scripts that fit a row; :func:`write_srt` has no such bound."""
    gathered = srt_blocks(timeline, *scope).groupBy(*scope).agg(F.sort_array(F.collect_list(F.struct("number", "block"))).alias("_blocks"))
    return gathered.select(*scope, F.array_join(F.transform("_blocks", lambda x: x["block"]), "\n").alias("srt"))
