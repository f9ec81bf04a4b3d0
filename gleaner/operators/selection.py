"""Verification, quota-balanced top-k per edition, and the four-way audit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import dates as dt
from gleaner.functions import text as tx
from gleaner.functions import urls as ul
from gleaner.operators.dedupe import duplicate_groups
from gleaner.session import cut_lineage, written


def parse_quotas(text: str) -> list[tuple[str, int]]:
    """``"A=3, bad, B=2, C=0"`` -> ``[("A", 3), ("B", 2)]``; order kept, a repeated name keeps its first place."""
    quotas: dict[str, int] = {}
    for chunk in text.split(","):
        name, _, count = chunk.partition("=")
        count = count.partition("=")[0].strip()
        digits = count[: len(count) - len(count.lstrip("0123456789"))] if count[:1].isdigit() else ""
        if name.strip() and digits and int(digits) > 0:
            quotas[name.strip()] = int(digits)
    return list(quotas.items())


def quota_rows(rows: DataFrame, key: str, rules: str) -> DataFrame:
    """The same reading for a column of rule texts (one per edition, say): ``key, name, quota, place`` (from 0)."""
    chunks = F.transform(F.split(rules, ","), lambda x, i: F.struct(i.alias("at"), F.split(x, "=").alias("halves")))
    read = rows.select(key, F.inline(F.filter(chunks, lambda x: F.size(x["halves"]) > 1))).select(
        key, "at", F.trim(F.get("halves", F.lit(0))).alias("name"), F.expr("try_cast(nullif(regexp_extract(trim(get(halves, 1)), '^[0-9]+', 0), '') AS bigint)").alias("quota")
    )
    # a repeated name keeps its first place and takes its last count
    found = read.filter("name <> '' AND quota > 0").groupBy(key, "name").agg(F.min("at").alias("first"), F.max_by("quota", "at").alias("quota"))
    return found.select(key, "name", "quota", (F.row_number().over(Window.partitionBy(key).orderBy("first")) - 1).alias("place"))


@dataclass(frozen=True)
class Rules:
    count: int = fv.DAILY_ITEM_COUNT
    quotas: tuple = tuple(parse_quotas(fv.CATEGORY_QUOTAS))
    low_trust_weight: int = fv.LOW_TRUST_WEIGHT
    low_trust_high_score: int = fv.LOW_TRUST_HIGH_SCORE
    freshness_hours: int = fv.FRESHNESS_HOURS


_EVIDENCE = ["raw_content", "summary", "intro_summary", "source_name", "category", "source_url"]
_EVIDENCE_LISTS = ["official_sources", "keywords", "ai_tags", "game_tags"]


# characters of a text in which claims are looked up first
EVIDENCE_HEAD = 1500


def evidence_text(first: int | None = None) -> Column:
    """``first``: of the text only the words that end in so many characters, before a blank."""
    content = F.col("raw_content") if first is None else F.regexp_extract(F.substring("raw_content", 1, first), "(?s)^.* ", 0)
    parts = [F.coalesce(content if c == "raw_content" else F.col(c), F.lit("")) for c in _EVIDENCE]
    lists = [F.coalesce(F.array_join(c, " "), F.lit("")) for c in _EVIDENCE_LISTS]
    return F.concat_ws(" ", *parts, *lists)


# distinct claim tokens up to which each is looked up one by one, and claim tokens that are first looked for as parts of a text
LOOKED_UP, LOOKED_FOR = 16, 32


def repeats_of(tokens: Column, some: Column) -> Column:
    """How many of the tokens, repeats included, are among ``some`` distinct ones of them: both sorted, gone through side by side."""

    def step(x: Column, pair: Column) -> Column:
        # every one of ``some`` is met, so the next one is at most one place on
        at = x["at"] + F.when(pair > F.get(x["some"], x["at"]), F.lit(1)).otherwise(F.lit(0))
        return tx.let(at, lambda i: F.struct(i.alias("at"), (x["n"] + F.when(F.get(x["some"], i) == pair, F.lit(1)).otherwise(F.lit(0))).alias("n"), x["some"].alias("some")))

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), F.sort_array(some).alias("some"))
    return F.aggregate(F.sort_array(tokens), start, step, lambda x: x["n"])


def traced_share(claims: Column, evidence: Column) -> Column:
    """Share of claim tokens (repeats count) found in the evidence tokens; null without claim tokens."""

    def share(claimed: Column) -> Column:
        # Sets by hashing. A title can be a whole text of one line, so repeats are counted on the smaller side, known or missing.
        known = F.array_intersect(claimed, evidence)
        sides = tx.let(known, lambda k: F.struct(k.alias("known"), F.array_except(claimed, k).alias("missing")))

        def count(x: Column) -> Column:
            absent = F.size(F.filter(claimed, lambda t: F.array_contains(x["missing"], t)))
            present = F.size(F.filter(claimed, lambda t: F.array_contains(x["known"], t)))
            looked_up = F.when(F.size(x["missing"]) < F.size(x["known"]), F.size(claimed) - absent).otherwise(present)
            return F.when(F.least(F.size(x["missing"]), F.size(x["known"])) <= LOOKED_UP, looked_up).otherwise(repeats_of(claimed, x["known"]))

        held = tx.let(sides, count)
        return F.when(F.size(claimed) > 0, held / F.size(claimed))

    return tx.let(claims, share)


def traced(claims: Column, threshold: float) -> Column:
    """Whether the share of claim tokens found in the item's evidence reaches the threshold.

    More evidence never lowers the share, so the whole text is taken apart only where its first part does not settle it, and not where
    too few claim tokens are parts of it at all. Claim tokens hold no stop words, which therefore need not be taken out of the evidence.
    """

    def found(claimed: Column, first: int | None) -> Column:
        return F.coalesce(traced_share(claimed, tx.stem_lookup(evidence_text(first))) >= threshold, F.lit(False))

    def possible(claimed: Column) -> Column:
        # a token is a word of the evidence or a beginning of one
        part = tx.let(F.lower(evidence_text()), lambda text: F.size(F.filter(claimed, lambda t: text.contains(t))))
        return (F.size(claimed) > LOOKED_FOR) | (part >= F.size(claimed) * threshold)

    return tx.let(claims, lambda claimed: found(claimed, EVIDENCE_HEAD) | (possible(claimed) & found(claimed, None)))


def claims_trace(claim: Column, threshold: float = 0.5) -> Column:
    return traced(tx.claim_tokens(claim, fv.SELECTION_STOP_WORDS), threshold)


def verify(generated: Column, rules: Rules = Rules()) -> Column:
    """Reasons why an item must not be published; empty means verified."""
    age = dt.age_hours(generated, F.col("published_at"))
    checks = [
        (~ul.is_http_url(F.col("source_url")) & F.col("collected_at").isNull(), fv.VERIFY_BAD_URL),
        (tx.strip(F.col("article_title")) == "", fv.VERIFY_NO_TITLE),
        (tx.strip(F.col("article_body")) == "", fv.VERIFY_NO_BODY),
        (~F.coalesce((age >= -6) & (age <= rules.freshness_hours), F.lit(False)), fv.VERIFY_BAD_DATE),
        ((F.col("source_weight") < rules.low_trust_weight) & (F.col("score") < rules.low_trust_high_score), fv.VERIFY_LOW_TRUST),
        (F.col("duplicate_of").isNotNull(), fv.VERIFY_DUPLICATE),
        (~F.col("_traced"), fv.VERIFY_NO_TRACE),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(reason)) for bad, reason in checks]))


def with_verification(items: DataFrame, generated: Column, rules: Rules = Rules()) -> DataFrame:
    """Adds ``reasons``."""
    claim = F.concat_ws(" ", F.col("article_title"), F.col("article_body"))
    traced = tx.settle(items, {"_traced": claims_trace(claim)})
    return tx.settle(traced, {"reasons": verify(generated, rules)}).drop("_traced")


def fallback_fields(rows: DataFrame, use: Column, note: tuple[str, str], mark: str, tidy: bool) -> tuple[DataFrame, dict[str, Column]]:
    """Title, intro and body rebuilt from the item's own evidence, for the rows of ``use``.

    Lines are taken apart once per row, and only as far as a clamped text can reach.
    """
    held = tx.settle(rows, {"_lines": F.when(use, tx.content_lines(tx.line_head(F.col("raw_content"), 300)))})
    rest = F.array_join(F.slice("_lines", 2, F.greatest(F.size("_lines"), F.lit(1))), " ")
    held = tx.settle(held, {"_line": F.coalesce(F.try_element_at("_lines", F.lit(1)), F.lit("")), "_rest": rest})
    line, written_summary = tx.null_if_blank(F.col("_line")), tx.null_if_blank(F.col("summary"))
    title = F.coalesce(line, tx.null_if_blank(F.col("article_title")), written_summary, F.lit(fv.FALLBACK_TITLE))
    summary = F.coalesce(written_summary, line, F.col("article_title"))
    detail = F.coalesce(tx.null_if_blank(F.col("_rest")), summary)
    body = F.concat(
        F.lit("1. "), tx.clamp(summary, 180, mark, tidy), F.lit("\n2. "), tx.clamp(detail, 180, mark, tidy),
        F.lit("\n" + note[0]), F.col("source_name"), F.lit(note[1]),
    )
    return held, {"article_title": tx.clamp(title, 80, mark, tidy), "intro_summary": tx.clamp(summary, 80, mark, tidy), "article_body": body}


def evidence_fallback(verified: DataFrame) -> DataFrame:
    """Rebuild candidates whose only failing reason is an untraceable claim; adds ``fell_back``."""
    only_trace = F.col("is_topic_candidate") & (F.size("reasons") == 1) & (F.get("reasons", F.lit(0)) == fv.VERIFY_NO_TRACE)
    df, fields = fallback_fields(verified.withColumn("fell_back", only_trace), F.col("fell_back"), fv.SELECTION_FALLBACK_NOTE, "…", tidy=False)
    return tx.settle(df, {name: F.when(F.col("fell_back"), value).otherwise(F.col(name)) for name, value in fields.items()}).drop("_lines", "_line", "_rest")


# --- duplicate groups -------------------------------------------------------------------------------------------------
def selection_rank(generated: Column) -> list[Column]:
    """Score, weight, nearest to the edition time, arrival."""
    distance = F.abs(dt.micros(generated) - dt.micros(F.col("published_at")))
    return [
        (-F.col("score")).alias("r1"), (-F.col("source_weight")).alias("r2"),
        F.coalesce(distance, F.lit(9223372036854775807)).alias("r3"), F.col("arrival").alias("r4"),
    ]


def group_winners(grouped: DataFrame, scope: list[str]) -> DataFrame:
    """``scope, group_root, winner_id``: first unmarked item of the group; without one, the best ranked.

    Ranking inside a group without an unmarked item uses each item's own distance between collection and publication.
    """
    own = F.col("collected_at")
    first = F.struct(
        F.when(F.col("duplicate_of").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("g1"),
        F.when(F.col("duplicate_of").isNull(), F.col("arrival")).alias("g2"),
        F.struct(*selection_rank(own)).alias("g3"),
    )
    return grouped.groupBy(*scope, "group_root").agg(F.min_by("id", first).alias("winner_id"))


def group_links(grouped: DataFrame, winners: DataFrame, scope: list[str]) -> DataFrame:
    """``winner_id, alternatives``: ordered distinct official links of each group, the winner's own first.

    One row per link is aggregated to its first place before anything is collected, so copies of a link in a large
    group are merged on the map side and only distinct links are gathered.
    """
    joined = grouped.join(winners, [*scope, "group_root"])
    own = F.array_compact(F.array(F.when((F.col("source_type") == "official"), F.col("source_url"))))
    urls = F.concat(own, F.coalesce("official_sources", F.array().cast("array<string>")))
    rows = joined.select(
        *scope, "winner_id", (F.col("id") != F.col("winner_id")).alias("other"), "arrival", F.posexplode(urls).alias("pos", "url")
    ).filter(ul.is_http_url(F.col("url")))
    firsts = rows.groupBy(*scope, "winner_id", "url").agg(F.min(F.struct("other", "arrival", "pos")).alias("place"))
    return firsts.groupBy(*scope, "winner_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "url"))), lambda x: x["url"]).alias("alternatives")
    )


def group_candidates(items: DataFrame, scope: list[str]) -> DataFrame:
    """One candidate per duplicate group with the group's links.

    ``items`` should be materialised. Groups, winners and links are settled without texts, which move once, for the winners.
    """
    columns = ["id", "duplicate_of", "arrival", "score", "source_weight", "published_at", "collected_at", "source_type", "source_url", "official_sources"]
    grouped = cut_lineage(duplicate_groups(items.select(*scope, *[c for c in columns if c not in scope]), scope))
    winners = cut_lineage(group_winners(grouped, scope))
    links = group_links(grouped, winners, scope)
    chosen = winners.join(links, [*scope, "winner_id"], "left").withColumnRenamed("winner_id", "id")
    joined = items.join(chosen, [*scope, "id"])
    own = F.when(ul.is_http_url(F.col("source_url")), F.array("source_url")).otherwise(F.array().cast("array<string>"))
    alternatives = F.coalesce("alternatives", own)
    keeps_url = (F.col("source_type") == "official") & ul.is_http_url(F.col("source_url"))
    return joined.withColumns(
        {
            "official_sources": alternatives,
            "source_url": F.when(keeps_url, F.col("source_url")).otherwise(F.coalesce(F.get(alternatives, F.lit(0)), F.col("source_url"))),
        }
    ).drop("alternatives")


# --- balanced top-k -----------------------------------------------------------------------------------------------------
def balanced_topk(eligible: DataFrame, generated: Column, rules: Rules = Rules(), scope: list[str] | None = None) -> DataFrame:
    """Rows selected per edition with ``phase`` (quota or fill) and ``rank``.

    Categories take up to their quota in configured order, then the best remaining rows fill up to the count. Every
    stage is a ranked limit, which Spark applies before the shuffle as well, so a busy edition never reaches one task
    in full.
    """
    scope = scope or ["edition"]
    quotas = list(rules.quotas)
    index = F.lit(None).cast("int")
    quota = F.lit(0)
    for i, (name, n) in enumerate(quotas):
        index = F.when(F.col("category") == name, F.lit(i)).otherwise(index)
        quota = F.when(F.col("category") == name, F.lit(n)).otherwise(quota)
    by_rank = F.struct(*selection_rank(generated))
    reach = max([rules.count, *[n for _, n in quotas]])
    best = eligible.withColumn("_rank", by_rank).withColumn(
        "_in_category", F.row_number().over(Window.partitionBy(*scope, "category").orderBy("_rank"))
    ).filter(F.col("_in_category") <= reach)
    order = F.struct(
        F.when(F.col("_in_category") <= quota, F.lit(0)).otherwise(F.lit(1)).alias("o1"),
        F.when(F.col("_in_category") <= quota, index).otherwise(F.lit(0)).alias("o2"),
        F.col("_rank").alias("o3"),
    )
    taken = best.withColumn("_order", order).withColumn(
        "_taken", F.row_number().over(Window.partitionBy(*scope).orderBy("_order"))
    ).filter(F.col("_taken") <= rules.count)
    return taken.withColumns(
        {
            "phase": F.when(F.col("_order.o1") == 0, F.lit("quota")).otherwise(F.lit("fill")),
            "rank": F.row_number().over(Window.partitionBy(*scope).orderBy("_rank")),
        }
    ).drop("_rank", "_in_category", "_order", "_taken")


_AUDIT = ["title", "category", "source_name", "source_url", "reasons", "score", "source_weight", "freshness_hours", "official_sources", "duplicate_group"]


def _entries(rows: DataFrame, bucket: str | Column, reasons: Column, generated: Column, scope: list[str]) -> DataFrame:
    return rows.select(
        *scope, (F.lit(bucket) if isinstance(bucket, str) else bucket).alias("bucket"), "id",
        F.col("article_title").alias("title"), "category", "source_name", "source_url", reasons.alias("reasons"),
        "score", "source_weight", dt.freshness_hours(generated, F.col("published_at")).alias("freshness_hours"),
        "official_sources", F.coalesce("duplicate_of", "id").alias("duplicate_group"),
    )


def judged_candidates(items: DataFrame, generated: Column, rules: Rules = Rules(), scope: list[str] | None = None) -> DataFrame:
    """Group candidates with verification reasons, fallback texts and the ``eligible`` flag."""
    scope = scope or ["edition"]
    checked = evidence_fallback(with_verification(group_candidates(items, scope), generated, rules))
    passed = (F.size("reasons") == 0) | F.col("fell_back")
    return checked.withColumn("eligible", passed & F.col("is_topic_candidate"))


def select_and_audit(items: DataFrame, generated: Column, rules: Rules = Rules(), scope: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Selected items and the audit of all four buckets, for every edition at once.

    An item is in one edition; duplicates of items of another edition count for their own edition.
    """
    scope = scope or ["edition"]
    # scored items and judged candidates each feed several branches, most of them without texts; they are written once as columns
    items = written(items)
    judged = written(judged_candidates(items, generated, rules, scope))
    chosen = balanced_topk(judged.filter("eligible"), generated, rules, scope)
    picked = chosen.select("id", F.lit(True).alias("_picked"))
    rest = judged.join(picked, "id", "left").filter("_picked is null")
    verified = F.size("reasons") == 0
    bucket = F.when(F.col("eligible") | verified, F.lit("rejected")).otherwise(F.lit("failed_verification"))
    reason = (
        F.when(F.col("eligible"), F.array(F.lit(fv.AUDIT_OVER_COUNT)))
        .when(verified, F.array(F.coalesce(tx.null_if_blank(F.col("exclusion_reason")), F.lit(fv.AUDIT_NOT_CANDIDATE))))
        .otherwise(F.col("reasons"))
    )
    winners = judged.select(F.col("id").alias("_w"))
    followers = items.join(winners.select("_w"), items["id"] == winners["_w"], "left").filter("_w is null or duplicate_of is not null")
    audit = (
        _entries(chosen, "selected", F.array(F.lit(fv.AUDIT_SELECTED)), generated, scope)
        .unionByName(_entries(rest, bucket, reason, generated, scope))
        .unionByName(_entries(followers, "duplicate", F.array(F.lit(fv.AUDIT_DUPLICATE)), generated, scope))
    )
    selected = chosen.withColumn("selected", F.lit(True))
    return selected, audit


def topic_candidates(items: DataFrame, limit: int, min_cross: int = 0) -> DataFrame:
    """Best candidates overall; ordering with a limit, so only ``limit`` rows per task travel."""
    rows = items.filter(F.col("is_topic_candidate") & (F.col("cross_relevance_score") >= min_cross))
    return rows.orderBy(F.desc("score"), F.desc("source_weight"), F.desc("published_at"), "arrival").limit(limit)


def selected_candidates(items: DataFrame, limit: int, min_cross: int = 0) -> DataFrame:
    return topic_candidates(items.filter(F.col("selected") & F.col("duplicate_of").isNull()), limit, min_cross)
