"""Scoring, prefiltering and screening as column expressions over items.

Signal dictionaries are arguments: ``Signals`` bundles the pattern lists, and any callable ``DataFrame -> DataFrame``
that adds the score columns can take the dictionary scorer's place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import dates as dt
from gleaner.functions import text as tx


@dataclass(frozen=True)
class Signals:
    """(label, pattern) lists; patterns see lower-cased text."""

    ai: list = field(default_factory=lambda: list(fv.AI_SIGNALS))
    game: list = field(default_factory=lambda: list(fv.GAME_SIGNALS))
    cross: list = field(default_factory=lambda: list(fv.CROSS_SIGNALS))
    value: list = field(default_factory=lambda: list(fv.VALUE_SIGNALS))
    tutorial: str = fv.SCORER_TUTORIAL_PATTERN
    gossip: str = fv.SCORER_GOSSIP_PATTERN
    repost: str = "repost"
    screen_tutorial: str = fv.SCREEN_TUTORIAL_PATTERN
    screen_gossip: str = fv.SCREEN_GOSSIP_PATTERN
    screen_repost: str = fv.SCREEN_REPOST_PATTERN
    prefilter: list = field(default_factory=lambda: list(fv.PREFILTER_RULES))


def clamp_score(c: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(100), c)).cast("int")


def source_weight_adjust(score: Column, weight: Column) -> Column:
    return clamp_score(dt.round_half_up(score + (weight - 50) * 0.25))


def _hits(text: Column, signals: list) -> Column:
    total = F.lit(0)
    for _, pattern in signals:
        total = total + tx.matches(text, pattern).cast("int")
    return total


def _labels(text: Column, signals: list) -> Column:
    return F.array_compact(F.array(*[F.when(tx.matches(text, p), F.lit(label)) for label, p in signals]))


# --- rule prefilter -----------------------------------------------------------------------------------------------
def prefilter_score(items: DataFrame, signals: Signals = Signals()) -> DataFrame:
    """Adds ``prefilter_score`` and ``prefilter_signals`` from title and excerpt."""
    text = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("excerpt", F.lit(""))))
    df = tx.settle(items, {"_text": text})
    df = tx.settle(df, {f"_{name}": tx.matches(F.col("_text"), "|".join(f"(?:{p})" for p in patterns)) for name, _, patterns in signals.prefilter})
    held = {name: F.col(f"_{name}") for name, _, _ in signals.prefilter}
    risk, risk_points = fv.PREFILTER_OFF_TOPIC
    rules = [(name, points, held[name]) for name, points, _ in signals.prefilter] + [(risk, risk_points, ~held["game"])]
    score = F.lit(0)
    for _, points, holds in rules:
        score = score + F.when(holds, F.lit(points)).otherwise(F.lit(0))
    df = df.withColumns(
        {
            "prefilter_score": score,
            "prefilter_signals": F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, _, holds in rules])),
        }
    )
    return df.drop("_text", *[f"_{name}" for name, _, _ in signals.prefilter])


def prefilter_apply(
    items: DataFrame, limit: int, signals: Signals = Signals(), low_trust: list[str] | None = None, order: str = "arrival"
) -> DataFrame:
    """Low-trust sources keep scores of at least 8, best and newest first; other sources their first rows."""
    flagged = F.col("source_id").isin(*(low_trust or fv.PREFILTER_SOURCE_IDS))
    scored = prefilter_score(items, signals)
    scored = scored.filter(~flagged | (F.col("prefilter_score") >= fv.PREFILTER_MIN_SCORE))
    key = F.struct(
        F.when(flagged, -F.col("prefilter_score")).otherwise(F.lit(0)),
        F.when(flagged, -dt.micros(F.col("published_at"))).otherwise(F.lit(0).cast("bigint")),
        F.col(order),
    )
    ranked = scored.withColumn("rank_in_source", F.row_number().over(Window.partitionBy("source_id").orderBy(key)))
    return ranked.filter(F.col("rank_in_source") <= limit)


# --- dictionary scorer ----------------------------------------------------------------------------------------------
def _with_hits(items: DataFrame, extra: dict[str, Callable[[Column], Column]], signals: Signals) -> DataFrame:
    """Labels of the matched signals and flags of each item, every pattern matched once."""
    text = F.lower(F.concat(F.coalesce("article_title", F.lit("")), F.lit("\n"), F.col("raw_content")))
    df = tx.settle(items, {"_text": text})
    t = F.col("_text")
    labels = {"_ai": _labels(t, signals.ai), "_game": _labels(t, signals.game), "_cross": _labels(t, signals.cross)}
    return tx.settle(df, {**labels, **{name: make(t) for name, make in extra.items()}})


def _scores() -> dict[str, Column]:
    ai, game, cross = F.size("_ai"), F.size("_game"), F.size("_cross")
    a = clamp_score(F.when(ai == 0, F.lit(12)).otherwise(25 + ai * 20 + cross * 6))
    g = clamp_score(F.when(game == 0, F.lit(20)).otherwise(30 + game * 14 + cross * 6))
    one_sided = dt.round_half_up(a * 0.35 + g * 0.25)
    both = dt.round_half_up(a * 0.45 + g * 0.35 + cross * 8 + (F.col("source_weight") - 50) * 0.08)
    c = clamp_score(F.when((ai == 0) | (game == 0), one_sided).otherwise(both))
    return {"ai_relevance_score": a, "game_relevance_score": g, "cross_relevance_score": c}


def relevance_scores(items: DataFrame, signals: Signals = Signals()) -> DataFrame:
    """Adds the three relevance scores."""
    return tx.settle(_with_hits(items, {}, signals), _scores())


def classify(items: DataFrame, min_cross: int = fv.MIN_CROSS_SCORE, signals: Signals = Signals()) -> DataFrame:
    """Scores, news value, first matching exclusion, candidate flag and tags."""
    flags = {
        "_value": lambda t: _hits(t, signals.value),
        "_tutorial": lambda t: tx.matches(t, signals.tutorial),
        "_gossip": lambda t: tx.matches(t, signals.gossip),
        "_repost": lambda t: tx.matches(t, signals.repost),
        "_low": lambda t: tx.is_low_information(F.col("raw_content")),
    }
    df = tx.settle(_with_hits(items, flags, signals), _scores())
    value = clamp_score(
        dt.round_half_up(F.col("cross_relevance_score") * 0.55 + F.col("source_weight") * 0.2 + F.col("_value") * 6 + 20)
    )
    df = tx.settle(df, {"news_value_score": F.when(F.col("_repost") | F.col("_low"), F.lit(35)).otherwise(value)})
    rule = (
        F.when(F.col("_tutorial"), F.lit(fv.REASON_TUTORIAL))
        .when(F.col("_gossip"), F.lit(fv.REASON_GOSSIP))
        .when(F.col("_repost") | (F.length("_text") < 50), F.lit(fv.REASON_REPOST))
        .when((F.col("ai_relevance_score") < 40) & (F.col("game_relevance_score") >= 45), F.lit(fv.REASON_NON_AI))
        .when(F.col("cross_relevance_score") < min_cross, F.lit(fv.REASON_LOW_CROSS))
        .when(F.col("news_value_score") < 55, F.lit(fv.REASON_LOW_VALUE))
    )
    reasons = F.array_compact(F.array(F.when(F.col("_low"), F.lit(fv.REASON_LOW_INFORMATION)), rule))
    nothing = F.array().cast("array<string>")
    df = tx.settle(
        df,
        {
            "provider_reasons": reasons,
            "ai_tags": F.when(F.col("ai_relevance_score") > 50, F.array(F.lit("tooling"), F.lit("workflow"))).otherwise(nothing),
            "game_tags": F.when(F.col("game_relevance_score") > 50, F.array(F.lit("development"), F.lit("operations"))).otherwise(nothing),
        },
    )
    return df.withColumn("provider_candidate", F.size("provider_reasons") == 0).drop(*flags)


def keyword_labels() -> Column:
    """Labels of the matched signals in dictionary order, the cross label, no repeats, at most eight."""
    extra = F.array_compact(F.array(F.when(F.col("cross_relevance_score") >= 70, F.lit(fv.CROSS_LABEL))))
    return F.slice(F.array_distinct(F.concat("_ai", "_game", "_cross", extra)), 1, 8)


def category() -> Column:
    return (
        F.when(F.col("cross_relevance_score") >= 65, F.lit("AI x Game"))
        .when(F.col("ai_relevance_score") >= F.col("game_relevance_score"), F.lit("AI"))
        .otherwise(F.lit("Game Industry"))
    )


def describe(scored: DataFrame) -> DataFrame:
    """Adds summary, keywords, category and article texts of scored items."""
    # the texts below take 220 characters of it at most, and ask whether there are more
    compact = tx.collapse(tx.head(F.col("raw_content"), 300))
    df = tx.settle(scored, {"_content": compact, "_title": tx.strip(F.coalesce("article_title", F.lit("")))})
    content, title = F.col("_content"), F.col("_title")
    derived = F.substring(content, 1, 40)
    merged = F.concat_ws("：", tx.null_if_blank(title), tx.null_if_blank(content))
    subject = F.coalesce(tx.null_if_blank(title), tx.null_if_blank(derived), F.lit(fv.INTRO_NO_SUBJECT))
    ending = (
        F.when(F.col("cross_relevance_score") >= 70, F.lit(fv.INTRO_CROSS))
        .when(F.col("ai_relevance_score") >= 60, F.lit(fv.INTRO_AI))
        .otherwise(F.lit(fv.INTRO_GAME))
    )
    article_title = F.coalesce(tx.null_if_blank(title), tx.null_if_blank(derived))
    topical = F.col("cross_relevance_score") >= 60
    lead = F.when(article_title.isNotNull(), F.concat(article_title, F.lit("。"))).otherwise(F.lit(""))

    def cut(c: Column, n: int) -> Column:
        return F.when(F.length(c) > n, F.concat(tx.strip_end(F.substring(c, 1, n)), F.lit("..."))).otherwise(c)

    note = F.concat(F.substring(content, 1, 140), F.when(F.length(content) > 140, F.lit("...")).otherwise(F.lit("")))
    return tx.settle(
        df,
        {
            "summary": tx.clamp(merged, 140),
            "intro_summary": F.concat(subject, ending),
            "keywords": keyword_labels(),
            "category": category(),
            "article_body": F.when(topical, F.concat(lead, cut(content, 220))).otherwise(F.concat(F.lit(fv.BELOW_THRESHOLD_BODY), note)),
            "article_title": F.coalesce(article_title, F.when(topical, F.lit("AI x game update")).otherwise(F.lit("Game industry update"))),
            "official_sources": F.array("source_url"),
        },
    ).drop("_content", "_title")


Scorer = Callable[[DataFrame], DataFrame]


def dictionary_scorer(min_cross: int = fv.MIN_CROSS_SCORE, signals: Signals = Signals()) -> Scorer:
    return lambda items: describe(classify(items, min_cross, signals))


# --- screening ------------------------------------------------------------------------------------------------------
def normalize_reason(reason: Column) -> Column:
    """Free-text reason to the reason it stands for; null when it says nothing."""
    r = F.lower(tx.strip(reason))
    return (
        F.when((r == "") | r.isin("none", "keep"), F.lit(None).cast("string"))
        .when(r.contains("non-ai") | r.contains("no ai"), F.lit(fv.REASON_NON_AI))
        .when(r.contains("tutorial") | r.contains("guide"), F.lit(fv.REASON_TUTORIAL))
        .when(r.contains("gossip") | r.contains("entertainment"), F.lit(fv.REASON_GOSSIP))
        .when(r.contains("repost") | r.contains("low information"), F.lit(fv.REASON_REPOST))
        .when(r.contains("unrelated"), F.lit(fv.REASON_UNRELATED))
        .otherwise(r)
    )


def exclusion_reasons(
    min_ai: int = fv.MIN_AI_SCORE, min_game: int = fv.MIN_GAME_SCORE, min_value: int = fv.MIN_NEWS_VALUE,
    min_cross: int = fv.MIN_CROSS_SCORE, signals: Signals = Signals(),
) -> Column:
    """All reasons against a scored raw item, in rule order, without repeats."""
    text = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.col("raw_content")))
    weight = F.col("source_weight")
    low_ai = F.col("ai_relevance_score") < min_ai
    low_game = F.col("game_relevance_score") < min_game

    def held(t: Column) -> Column:
        rules = [
            (F.col("duplicate_of").isNotNull(), fv.REASON_DUPLICATE),
            (low_ai, fv.REASON_NON_AI),
            (low_game, fv.REASON_NO_GAME),
            (low_ai & low_game, fv.REASON_UNRELATED),
            (tx.matches(t, signals.screen_tutorial) & (F.col("news_value_score") < 70), fv.REASON_TUTORIAL),
            (tx.matches(t, signals.screen_gossip), fv.REASON_GOSSIP),
            (tx.matches(t, signals.screen_repost) | (F.length(tx.strip(F.col("raw_content"))) < 50), fv.REASON_REPOST),
            (source_weight_adjust(F.col("cross_relevance_score"), weight) < min_cross, fv.REASON_CROSS_BELOW),
            (source_weight_adjust(F.col("news_value_score"), weight) < min_value, fv.REASON_VALUE_BELOW),
        ]
        return F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in rules]))

    provider = F.filter(F.transform("provider_reasons", normalize_reason), lambda r: r.isNotNull())
    return F.array_distinct(F.concat(provider, tx.let(text, held)))


def screen_items(raw: DataFrame, scorer: Scorer | None = None, processed_ids: DataFrame | None = None, **thresholds) -> DataFrame:
    """Staged screening of raw items (``title`` holds the collected title).

    Verdict columns: ``exclusion_reasons, is_topic_candidate, score, selected, duplicate_of``. ``processed_ids``
    (raw_item_id, processed_id) maps a raw duplicate to the processed row it became. A scorer can add
    ``score_error``; such rows get status ``error`` and no verdict.
    """
    signals = thresholds.get("signals", Signals())
    scorer = scorer or dictionary_scorer(thresholds.get("min_cross", fv.MIN_CROSS_SCORE), signals)
    scored = scorer(raw.withColumn("article_title", F.coalesce("title", F.lit(""))))
    if "score_error" not in scored.columns:
        scored = scored.withColumn("score_error", F.lit(None).cast("string"))
    scored = tx.settle(scored, {"exclusion_reasons": exclusion_reasons(**thresholds)})
    weight = F.col("source_weight")
    score = dt.round_half_up(
        source_weight_adjust(F.col("cross_relevance_score"), weight) * 0.6 + source_weight_adjust(F.col("news_value_score"), weight) * 0.4
    ).cast("int")
    failed = F.col("score_error").isNotNull()
    out = scored.withColumns(
        {
            "is_topic_candidate": ~failed & (F.size("exclusion_reasons") == 0),
            "score": F.when(~failed, score),
            "status": F.when(failed, F.lit("error")).when(F.size("exclusion_reasons") == 0, F.lit("processed")).otherwise(F.lit("excluded")),
            "raw_duplicate_of": F.col("duplicate_of"),
        }
    )
    out = out.withColumns(
        {
            "selected": F.col("is_topic_candidate") & F.col("raw_duplicate_of").isNull(),
            "exclusion_reason": F.array_join("exclusion_reasons", "; "),
        }
    )
    if processed_ids is not None:
        mapped = processed_ids.select(F.col("raw_item_id").alias("raw_duplicate_of"), F.col("processed_id").alias("_mapped"))
        out = out.drop("duplicate_of").join(mapped, "raw_duplicate_of", "left").withColumnRenamed("_mapped", "duplicate_of")
    return out.drop("_text", "_ai", "_game", "_cross")


def screening_audit(screened: DataFrame) -> DataFrame:
    """One audit row per screened item."""
    weight = F.col("source_weight")
    message = (
        F.when(F.col("status") == "error", F.col("score_error"))
        .when(F.col("status") == "processed", F.lit("Item passed automated screening."))
        .otherwise(F.col("exclusion_reason"))
    )
    return screened.select(
        F.col("id").alias("raw_item_id"),
        F.when(F.col("status") != "error", F.col("id")).alias("processed_item_id"),
        F.lit("screening").alias("stage"), "status", message.alias("message"),
        "news_value_score", "cross_relevance_score",
        source_weight_adjust(F.col("news_value_score"), weight).alias("effective_news_value_score"),
        source_weight_adjust(F.col("cross_relevance_score"), weight).alias("effective_cross_relevance_score"),
    )


def enrich_items(items: DataFrame, scorer: Scorer | None = None, min_cross: int = fv.MIN_CROSS_SCORE, signals: Signals = Signals()) -> DataFrame:
    """One-pass enrichment: the score is the plain cross score, without source weight. Rows whose scorer reports
    ``score_error`` stay, excluded and with zero scores."""
    scorer = scorer or dictionary_scorer(min_cross, signals)
    before = items.withColumn("_raw_title", F.coalesce("article_title", F.lit("")))
    out = scorer(before)
    if "duplicate_of" not in out.columns:
        out = out.withColumn("duplicate_of", F.lit(None).cast("string"))
    speech = F.concat(F.col("article_title"), F.lit(". "), F.coalesce(tx.null_if_blank(F.col("intro_summary")), F.col("summary")))
    out = out.withColumns(
        {
            "score": F.col("cross_relevance_score"),
            "is_topic_candidate": F.col("provider_candidate"),
            "selected": F.col("provider_candidate") & F.col("duplicate_of").isNull(),
            "exclusion_reason": F.array_join("provider_reasons", "; "),
            "script_segments": F.array(speech),
        }
    )
    if "score_error" in out.columns:
        nothing = F.array().cast("array<string>")
        replaced = {
            "summary": F.substring("raw_content", 1, 240), "keywords": nothing, "category": F.lit("Excluded"),
            "score": F.lit(0), "news_value_score": F.lit(0), "selected": F.lit(False),
            "article_title": F.coalesce(tx.null_if_blank(F.col("_raw_title")), F.substring("raw_content", 1, 80)),
            "article_body": F.lit(""), "intro_summary": F.lit("AI enrichment failed; item excluded from automated selection."),
            "official_sources": nothing, "script_segments": nothing, "ai_relevance_score": F.lit(0), "game_relevance_score": F.lit(0),
            "cross_relevance_score": F.lit(0), "ai_tags": nothing, "game_tags": nothing, "is_topic_candidate": F.lit(False),
            "exclusion_reason": F.concat(F.lit("ai enrichment failed: "), F.col("score_error")),
        }
        failed = F.col("score_error").isNotNull()
        out = out.withColumns({name: F.when(failed, value).otherwise(F.col(name)) for name, value in replaced.items()})
    return out.drop("_text", "_ai", "_game", "_cross", "_raw_title")
