"""Edition texts and per-platform packages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import dates as dt
from gleaner.functions import text as tx
from gleaner.functions import urls as ul
from gleaner.operators.articles import category_or_default
from gleaner.operators.dedupe import distinct_links, item_links


def unique_anchors(items: DataFrame, scope: str, place: str = "rank") -> DataFrame:
    """Adds ``category_anchor`` and ``anchor``; the n-th repeat of an anchor in an edition gets ``-n``."""
    df = items.withColumn("category", category_or_default())
    title = F.coalesce(tx.null_if_blank(F.col("article_title")), F.col("id"))
    df = df.withColumn("category_anchor", tx.slugify(F.col("category")))
    df = df.withColumn("_base", F.concat("category_anchor", F.lit("--"), tx.slugify(title)))
    n = F.row_number().over(Window.partitionBy(scope, "_base").orderBy(place))
    df = df.withColumn("_n", n)
    anchor = F.when(F.col("_n") == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("-"), F.col("_n").cast("string")))
    return df.withColumn("anchor", anchor).drop("_base", "_n")


def _numbered_links(sep: str, numbered: bool) -> Column:
    links = distinct_links(item_links(), ul.link_key)
    texts = F.transform(
        links,
        lambda x, i: F.concat(
            F.concat((i + 1).cast("string"), F.lit(". ")) if numbered else F.lit(""), tx.markdown_link(x["label"], x["url"])
        ),
    )
    return F.array_join(texts, sep)


def edition_markdown(editions: DataFrame, items: DataFrame, layout: str = "daily", scope: str = "edition") -> DataFrame:
    """One Markdown text per edition: ``scope, n_items, markdown``.

    ``editions`` holds the scope column and ``heading``, ``period`` texts; editions without items get the empty text.
    Layouts: ``daily`` and ``weekly`` (anchors), ``plain`` (no anchors). Only selected items reach this step, so the
    rows gathered per edition are as few as the selection's count.
    """
    plain = layout == "plain"
    comment = "小编点评：" if layout == "weekly" else "小编评论："
    df = unique_anchors(items, scope)
    df = df.withColumn("_place", F.min("rank").over(Window.partitionBy(scope, "category")))
    title = tx.escape_markdown(F.col("article_title"))
    said = tx.escape_markdown(tx.first_non_blank(F.col("intro_summary"), F.col("summary"), default=fv.NO_SUMMARY))
    tags = F.array_join(F.transform(F.concat("ai_tags", "game_tags"), tx.escape_markdown), ", ")
    body = F.coalesce(tx.null_if_blank(tx.strip(F.col("article_body"))), F.lit(fv.NO_BODY))
    bullet = F.concat(F.lit("- **"), title, F.lit("**：" if plain else "**: "), said)
    if plain:
        toc = F.concat(F.lit("  - "), title)
        category_line = F.concat(F.lit("- "), tx.escape_markdown(F.col("category")))
        shown = F.regexp_replace(body, r'(?i)<a\s+id="[^"]*"></a>\n*', "")
        block = F.concat_ws(
            "\n", F.concat(F.lit("### "), title), F.lit(""), F.concat(F.lit("**点评**："), said), F.lit(""), shown, F.lit(""),
            F.concat(F.lit("**来源**："), _numbered_links(" / ", numbered=False)), F.lit(""),
        )
    else:
        toc = F.concat(F.lit("  - ["), title, F.lit("](#"), F.col("anchor"), F.lit(")"))
        category_line = F.concat(F.lit("- ["), tx.escape_markdown(F.col("category")), F.lit("](#"), F.col("category_anchor"), F.lit(")"))
        numbered = _numbered_links("\n", numbered=True)
        sources = F.when(numbered == "", F.lit("Sources:")).otherwise(F.concat(F.lit("Sources:\n"), numbered))
        block = F.concat_ws(
            "\n", F.concat(F.lit('<a id="'), tx.escape_html(F.col("anchor"), backtick=True), F.lit('"></a>')), F.lit(""),
            F.concat(F.lit("### "), title), F.lit(""),
            F.concat(F.lit("*" + comment), said, F.lit("*")),
            F.concat(F.lit("- Source: "), tx.markdown_link(F.col("source_name"), F.col("source_url"))),
            F.concat(F.lit("- Published: "), dt.iso_text(F.col("published_at"))),
            F.concat(F.lit("- Score: "), F.col("cross_relevance_score").cast("string")),
            F.concat(F.lit("- Tags: "), F.coalesce(tx.null_if_blank(tags), F.lit("None"))),
            F.lit(""), body, F.lit(""), sources, F.lit(""),
        )
    rows = df.select(
        scope, "rank", F.col("_place").alias("place"), F.col("category").alias("cat"), bullet.alias("bullet"), toc.alias("toc"),
        category_line.alias("cat_line"), F.concat(F.lit("## "), tx.escape_markdown(F.col("category")), F.lit("\n\n")).alias("cat_head"),
        block.alias("block"),
    )
    gathered = rows.groupBy(scope).agg(
        F.count("*").alias("n_items"),
        F.sort_array(F.collect_list(F.struct("rank", "bullet"))).alias("_bullets"),
        F.sort_array(F.collect_list(F.struct("place", "rank", "cat", "cat_line", "cat_head", "toc", "block"))).alias("_rows"),
    )
    joined = editions.join(gathered, scope, "left")

    def opens(x: Column, i: Column) -> Column:
        return (i == 0) | (x["cat"] != F.get(F.col("_rows"), F.greatest(i - 1, F.lit(0)))["cat"])

    toc_lines = F.transform("_rows", lambda x, i: F.concat(F.when(opens(x, i), F.concat(x["cat_line"], F.lit("\n"))).otherwise(F.lit("")), x["toc"], F.lit("\n")))
    sections = F.transform("_rows", lambda x, i: F.concat(F.when(opens(x, i), x["cat_head"]).otherwise(F.lit("")), x["block"], F.lit("\n")))
    head = {
        "daily": ("Date: ", "## Summary", "## Table of Contents", fv.EMPTY_DAY),
        "weekly": ("Period: ", "## Weekly Highlights", "## Table of Contents", fv.EMPTY_WEEK),
        "plain": ("> ", "## 今日要点", "## 目录", fv.EMPTY_DAY_PLAIN),
    }[layout]
    bullets = F.coalesce(F.array_join(F.transform("_bullets", lambda x: x["bullet"]), "\n"), F.lit(head[3]))
    whole = F.concat(
        F.lit("# "), tx.escape_markdown(F.col("heading")), F.lit("\n\n" + head[0]), F.col("period"), F.lit(f"\n\n{head[1]}\n\n"), bullets,
        F.lit(f"\n\n{head[2]}\n\n"), F.coalesce(F.array_join(toc_lines, ""), F.lit("")), F.lit("\n"),
        F.coalesce(F.array_join(sections, ""), F.lit("")),
    )
    markdown = F.concat(F.regexp_replace(whole, rf"{tx.WS}+$", ""), F.lit("\n"))
    return joined.select(scope, F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"), markdown.alias("markdown"))


def daily_headings(editions: DataFrame, title: str = fv.DAILY_TITLE) -> DataFrame:
    """Headings start with ``title``, the publication's own name for its daily edition."""
    day = F.date_format("edition", "yyyy-MM-dd")
    return editions.select(
        "edition", F.concat(F.lit(title), F.replace(day, F.lit("-"), F.lit(""))).alias("heading"), day.alias("period")
    )


def weekly_headings(weeks: DataFrame, title: str = fv.WEEKLY_TITLE) -> DataFrame:
    """``week`` is the Monday."""
    end = F.date_add("week", 6)
    return weeks.select(
        "week",
        F.concat(F.lit(title), dt.iso_week_key(F.col("week").cast("timestamp_ntz"))).alias("heading"),
        F.concat(F.date_format("week", "yyyy-MM-dd"), F.lit(" to "), F.date_format(end, "yyyy-MM-dd")).alias("period"),
    )


# --- packages ---------------------------------------------------------------------------------------------------------
def edition_tags(items: DataFrame, scope: str = "edition") -> DataFrame:
    """``scope, tags``: base tags, then the items' tags by first use; at most 20."""
    tags = F.filter(F.transform(F.concat("ai_tags", "game_tags", "keywords"), tx.strip), lambda t: t != "")
    rows = items.select(scope, "rank", F.posexplode(tags).alias("pos", "tag"))
    firsts = rows.filter(~F.col("tag").isin(*fv.BASE_TAGS)).groupBy(scope, "tag").agg(F.min(F.struct("rank", "pos")).alias("place"))
    ranked = firsts.withColumn("_n", F.row_number().over(Window.partitionBy(scope).orderBy("place")))
    extra = ranked.filter(F.col("_n") <= fv.MAX_TAGS - len(fv.BASE_TAGS)).groupBy(scope).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_n", "tag"))), lambda x: x["tag"]).alias("_extra")
    )
    base = F.array(*[F.lit(t) for t in fv.BASE_TAGS])
    return items.select(scope).distinct().join(extra, scope, "left").select(
        scope, F.concat(base, F.coalesce("_extra", F.array().cast("array<string>"))).alias("tags")
    )


def edition_links(items: DataFrame, scope: str = "edition") -> DataFrame:
    """``scope, links``: source links of all items, first per URL key."""
    rows = items.select(scope, "rank", F.posexplode(item_links()).alias("pos", "link")).filter(ul.is_http_url(F.col("link.url")))
    keyed = rows.withColumn("key", ul.package_link_key(F.col("link.url")))
    firsts = keyed.groupBy(scope, "key").agg(F.min_by("link", F.struct("rank", "pos")).alias("link"), F.min(F.struct("rank", "pos")).alias("place"))
    label = F.coalesce(tx.null_if_blank(F.col("link.label")), F.col("link.url"))
    return firsts.groupBy(scope).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("place", label.alias("label"), F.col("link.url").alias("url")))),
            lambda x: F.struct(x["label"].alias("label"), x["url"].alias("url")),
        ).alias("links")
    )


def platform_table() -> Column:
    """The platforms as a literal array; exploding it multiplies every edition by six rows without a join."""
    rows = []
    for name, video, subtitles, content, title_limit, text_limit in fv.PLATFORMS:
        rows.append(
            F.struct(
                F.lit(name).alias("platform"), F.lit(video).alias("video"), F.lit(subtitles).alias("subtitles"),
                F.lit(content).alias("content"), F.lit(title_limit).cast("int").alias("title_limit"),
                F.lit(text_limit).cast("int").alias("description_limit"),
            )
        )
    return F.array(*rows)


def platform_packages(items: DataFrame, paths: DataFrame, scope: str = "edition") -> DataFrame:
    """One package per edition and platform. ``paths``: scope, markdown_path, video_path, subtitle_path."""
    said = tx.first_non_blank(F.col("intro_summary"), F.col("summary"), default=fv.NO_SUMMARY)
    stories = items.groupBy(scope).agg(
        F.sort_array(F.collect_list(F.struct("rank", F.concat("article_title", F.lit(" - "), said).alias("line")))).alias("_stories"),
        F.min_by(tx.strip(F.col("article_title")), "rank").alias("_first"),
    )
    df = paths.join(stories, scope, "left").join(edition_tags(items, scope), scope, "left").join(edition_links(items, scope), scope, "left")
    none = F.array().cast("array<string>")
    day = F.date_format(scope, "yyyy-MM-dd")
    title = F.concat(day, F.lit(fv.PACKAGE_TITLE), F.when(F.coalesce("_first", F.lit("")) != "", F.concat(F.lit(": "), F.col("_first"))).otherwise(F.lit("")))
    story_lines = F.coalesce(F.transform("_stories", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["line"])), none)
    link_lines = F.coalesce(F.transform("links", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["label"], F.lit(": "), x["url"])), none)
    text = F.array_join(
        F.concat(F.array(F.lit(fv.PACKAGE_HEAD)), story_lines, F.array(F.lit(""), F.lit("Sources:")), link_lines, F.array(F.lit(""), F.lit(fv.PACKAGE_TAIL))), "\n"
    )
    df = df.withColumns({"_title": title, "_text": F.concat(tx.strip(text), F.lit("\n")), "_p": F.explode(platform_table())})
    p = F.col("_p")
    return df.select(
        scope, p["platform"].alias("platform"),
        tx.clamp_at(F.col("_title"), p["title_limit"]).alias("title"),
        tx.clamp_at(F.col("_text"), p["description_limit"]).alias("description"),
        F.coalesce("tags", F.array(*[F.lit(t) for t in fv.BASE_TAGS])).alias("tags"),
        F.col("links").alias("source_links"),
        F.when(p["subtitles"], F.col("subtitle_path")).alias("subtitle_path"),
        F.when(p["video"], F.col("video_path")).alias("video_path"),
        F.when(p["content"], F.col("markdown_path")).alias("content_path"),
        p["title_limit"].alias("title_limit"), p["description_limit"].alias("description_limit"),
    )


def package_violations(packages: DataFrame) -> DataFrame:
    """Packages over a limit: ``scope columns, platform, field, length, limit``."""
    over = F.array_compact(
        F.array(*[
            F.when(
                F.length(field) > F.col(f"{field}_limit"),
                F.struct(F.lit(field).alias("field"), F.length(field).alias("length"), F.col(f"{field}_limit").alias("limit")),
            )
            for field in ("title", "description")
        ])
    )
    keep = [c for c in packages.columns if c not in ("title", "description", "title_limit", "description_limit")]
    return packages.select(*keep, F.inline(over))
