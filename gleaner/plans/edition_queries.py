"""Queries over time roll-ups, narration, edition texts, packages, table maintenance and the incremental forms."""

from __future__ import annotations

import contextlib
import uuid
from datetime import date

from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import dates as dt
from gleaner.operators import editions as ed
from gleaner.operators import rollup as ro
from gleaner.operators import store as st
from gleaner.operators import timeline as tl
from gleaner.operators.item_store import ItemStore
from gleaner.operators.ledger import Ledger, absolute, read_or_empty
from gleaner.plans import curation_queries as cq
from gleaner.plans import sql as s
from gleaner.plans.dedupe_queries import SPLIT, linked
from gleaner.plans.registry import query
from gleaner.plans.source_queries import _ROUTES, REGISTRY, registry
from gleaner.plans.testbed import items, table
from gleaner.session import cut_lineage, ensure_checkpoint_dir, written
from gleaner.streaming import ingest as stream

joined = cq.joined


def scratch(spark, name):
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- roll-ups -----------------------------------------------------------------------------------------------------------
_RANGE = "timestamp '2024-01-08 00:00:00' AND timestamp '2024-01-14 23:59:59.999'"


@query(
    "weekly_candidates",
    f"""{cq._ENRICHED} SELECT id, score FROM enriched WHERE is_topic_candidate AND duplicate_of IS NULL AND doc_id%17<>0
    AND (published_at BETWEEN {_RANGE} OR collected_at BETWEEN {_RANGE}) ORDER BY {cq._STORED_ORDER} LIMIT 9""",
)
def weekly_candidates(spark, folder):
    rows = cq.enriched(spark, folder).withColumn("is_mock", F.col("doc_id") % 17 == 0)
    found = ro.weekly_candidates(rows, dt.ntz("2024-01-08 00:00:00"), dt.ntz("2024-01-14 23:59:59.999"))
    return found.select("id", "score")


_DIGEST = f"""{cq._AUDIT}, a AS (SELECT *, cast(date_trunc('week', edition) AS date) AS week, {s.freshness(cq._GEN, 'published_at')} AS fh FROM audit WHERE bucket='selected'),
  rebuilt AS (SELECT a.week, a.edition, a.id, CASE WHEN lost THEN a.title ELSE g.article_title END AS title, CASE WHEN lost THEN a.score ELSE g.score END AS score,
     CASE WHEN lost THEN a.source_url ELSE g.source_url END AS source_url, CASE WHEN lost THEN a.source_weight ELSE g.source_weight END AS source_weight,
     CASE WHEN lost THEN cast(a.edition AS timestamp) - to_microseconds(cast(fh*3600000000 AS bigint)) ELSE g.published_at END AS published_at
     FROM (SELECT *, cast(id AS bigint)%4=0 AS lost FROM a) a JOIN garbled g ON g.id=a.id WHERE lost OR g.doc_id%17<>0),
  digest AS (SELECT *, cast(row_number() OVER (PARTITION BY week ORDER BY score DESC, source_weight DESC, published_at DESC, edition, id) AS int) AS rank FROM rebuilt)"""


def digest(spark, folder):
    """Three quarters of the items are persisted; the others are rebuilt from their audit entry."""
    rows = written(cq._garbled(cq.enriched(spark, folder)))
    audit = cq.audit_of(rows)[1].withColumn("generated_at", cq.generated())
    persisted = rows.filter("doc_id % 4 <> 0").withColumn("is_mock", F.col("doc_id") % 17 == 0)
    return ro.weekly_digest(audit, persisted)


@query(
    "weekly_digest",
    f"""{_DIGEST} SELECT strftime(week, '%G-W%V') AS week_key, week, id, rank, title AS article_title, score, source_url, cast(id AS bigint)%4<>0 AS was_persisted FROM digest WHERE rank<=9""",
)
def weekly_digest(spark, folder):
    return digest(spark, folder).select("week_key", "week", "id", "rank", "article_title", "score", "source_url", "was_persisted")


@query(
    "day_spine",
    f"""WITH {s.ITEMS}, b AS (SELECT source_name, min(published_at) AS a, max(published_at) AS z FROM items GROUP BY 1)
    SELECT source_name, cast(unnest(generate_series(date_trunc('day', a), date_trunc('day', z), interval 1 day)) AS date) AS day FROM b""",
)
def day_spine(spark, folder):
    bounds = items(spark, folder).groupBy("source_name").agg(F.min("published_at").alias("start_day"), F.max("published_at").alias("end_day"))
    return ro.day_spine(bounds).select("source_name", "day")


@query(
    "period_coverage",
    f"""{cq._TOP}, today AS (SELECT date '2024-02-03' AS t), spine AS (
      SELECT 'day' AS kind, cast(unnest(generate_series(t - 6, t, interval 1 day)) AS date) AS start FROM today
      UNION ALL SELECT 'week', cast(unnest(generate_series(date_trunc('week', t) - interval 21 days, date_trunc('week', t), interval 7 days)) AS date) FROM today)
    SELECT kind, CASE WHEN kind='day' THEN strftime(start, '%Y-%m-%d') ELSE strftime(start, '%G-W%V') END AS period, start,
      EXISTS (SELECT 1 FROM top WHERE CASE WHEN kind='day' THEN edition = start ELSE date_trunc('week', edition) = start END) AS has_report FROM spine""",
)
def period_coverage(spark, folder):
    return ro.period_coverage(cq.top(spark, folder).select("edition").distinct(), F.lit("2024-02-03").cast("date"))


@query(
    "source_audit",
    f"""WITH {s.ITEMS}, {REGISTRY}, w AS (SELECT max(published_at) AS z FROM items),
    st AS (SELECT source_name, count(*) AS fetched, max(published_at) AS newest, min(published_at) AS oldest,
      count(*) FILTER (published_at BETWEEN z - interval 24 hours AND z) AS inside FROM items, w GROUP BY 1),
    sm AS (SELECT source_name, string_agg(article_title, '|' ORDER BY arrival) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY arrival) AS rn FROM items) WHERE rn<=5 GROUP BY 1),
    fl AS (SELECT source AS source_name, count(*) AS failures FROM documents WHERE doc_id%50=3 AND cast(substr(source,4) AS int)%3=1 GROUP BY 1),
    j AS (SELECT reg.*, {_ROUTES} AS route, coalesce(fetched,0) AS f, coalesce(failures,0) AS e, newest, oldest, coalesce(inside,0) AS i, samples
      FROM reg LEFT JOIN st ON st.source_name=reg.name LEFT JOIN sm ON sm.source_name=reg.name LEFT JOIN fl ON fl.source_name=reg.name)
    SELECT id AS source_id, name AS source_name, CASE WHEN coalesce(route,'') NOT IN ('rss','web_page','json_api','manual_markdown') THEN 'no_collector'
      WHEN collection_strategy<>'manual_markdown' AND url IS NULL THEN 'no_url' WHEN e>0 AND f>0 THEN 'partial_failure' WHEN e>0 THEN 'failed' WHEN f>0 THEN 'ok' ELSE 'empty' END AS status,
      f AS fetched, e AS failures, i AS within_window, f-i AS outside_window, newest AS newest_published_at, oldest AS oldest_published_at, samples FROM j""",
)
def source_audit(spark, folder):
    it = items(spark, folder).select("source_name", F.col("article_title").alias("title"), F.col("source_url").alias("url"), "published_at", "arrival", "doc_id")
    failures = it.filter((F.col("doc_id") % 50 == 3) & (F.substring("source_name", 4, 10).cast("int") % 3 == 1)).select(
        "source_name", F.lit("fetch failed").alias("error")
    )
    end_col = it.agg(F.max("published_at")).scalar()
    audit = ro.source_audit(registry(spark, folder), it, failures, dt.shift_hours(end_col, -24), end_col, ["rss", "web_page", "json_api", "manual_markdown"])
    return audit.drop("collection_strategy").withColumn("samples", joined(F.transform("samples", lambda x: x["title"])))


@query(
    "window_counters",
    """SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + interval 1 day AS window_end, event_type, count(*) AS fetched, max(ts) AS newest, min(ts) AS oldest
    FROM events GROUP BY 1, 2, 3""",
)
def window_counters(spark, folder):
    return stream.window_counters(table(spark, folder, "events"), "event_type")


# --- narration ------------------------------------------------------------------------------------------------------------
_TIMED = f"""x AS (SELECT conv_id, turn, unnest({s.sentences('text')}) AS text, unnest(range(0, len({s.sentences('text')}))) AS sentence_no FROM conversations),
 timed AS (SELECT *, {s.speech_ms('text')} AS duration_ms, row_number() OVER w AS segment_no, cast(sum({s.speech_ms('text')}) OVER w AS bigint) AS end_ms FROM x
   WINDOW w AS (PARTITION BY conv_id ORDER BY turn, sentence_no ROWS UNBOUNDED PRECEDING))"""


def timeline(spark, folder):
    return tl.narration_timeline(table(spark, folder, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn", stretch=4)


@query(
    "narration_timeline",
    f"""WITH {_TIMED} SELECT conv_id, turn, text, cast(segment_no AS int) AS segment_no, printf('tts-%03d', segment_no) AS segment_id, duration_ms, end_ms - duration_ms AS start_ms, end_ms FROM timed""",
)
def narration_timeline(spark, folder):
    return timeline(spark, folder).select("conv_id", "turn", "text", "segment_no", "segment_id", "duration_ms", "start_ms", "end_ms")


@query(
    "item_spans",
    f"""WITH {_TIMED}, sp AS (SELECT conv_id, turn, min(end_ms-duration_ms) AS start_ms, max(end_ms) AS end_ms FROM timed GROUP BY 1, 2)
    SELECT conv_id, turn, start_ms, end_ms, round(end_ms::double / max(end_ms) OVER (PARTITION BY conv_id), 9) AS progress FROM sp""",
)
def item_spans(spark, folder):
    spans = tl.item_spans(timeline(spark, folder), "conv_id", "turn")
    return spans.select("conv_id", "turn", "start_ms", "end_ms", F.round("progress", 9).alias("progress"))


@query(
    "legacy_timeline",
    f"""{cq._TOP}, l AS (SELECT edition, id, article_title, rank, greatest(3000, length(article_body) * 45) AS ms FROM top)
    SELECT edition, id, article_title, cast(sum(ms) OVER w - ms AS bigint) AS start_ms, cast(sum(ms) OVER w AS bigint) AS end_ms FROM l WINDOW w AS (PARTITION BY edition ORDER BY rank)""",
)
def legacy_timeline(spark, folder):
    return tl.legacy_timeline(cq.top(spark, folder), "edition", "rank").select("edition", "id", "article_title", "start_ms", "end_ms")


@query(
    "spans_by_position",
    f"""WITH {_TIMED}, said AS (SELECT * FROM timed WHERE turn % 3 <> 1),
    sp AS (SELECT conv_id, turn, min(end_ms-duration_ms) AS s, max(end_ms) AS e FROM said GROUP BY 1, 2),
    t AS (SELECT conv_id, max(end_ms) AS total FROM said GROUP BY 1), n AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n_items FROM (SELECT DISTINCT conv_id, turn FROM conversations)),
    j AS (SELECT n.conv_id, n.turn, n_items, total, coalesce(sp.s, p.end_ms-p.duration_ms, 0) AS start_ms, coalesce(sp.e, p.end_ms, sp.s, p.end_ms-p.duration_ms, 0) AS end_ms
      FROM n LEFT JOIN sp ON sp.conv_id = n.conv_id AND sp.turn = n.turn LEFT JOIN said p ON p.conv_id = n.conv_id AND p.segment_no = n.turn LEFT JOIN t ON t.conv_id = n.conv_id)
    SELECT conv_id, turn, start_ms, end_ms, round(CASE WHEN total > 0 THEN end_ms::double / total ELSE turn::double / greatest(n_items, 1) END, 9) AS progress FROM j""",
)
def spans_by_position(spark, folder):
    """Turns nobody speaks about (every third) take the span of the segment at their own place."""
    said = timeline(spark, folder).filter("turn % 3 <> 1")
    turns = table(spark, folder, "conversations").select("conv_id", "turn").distinct()
    spans = tl.spans_for_items(turns.withColumn("place", F.col("turn")), said, "conv_id", "turn", "place")
    return spans.select("conv_id", "turn", "start_ms", "end_ms", F.round("progress", 9).alias("progress"))


@query(
    "srt_text",
    f"""WITH {_TIMED} SELECT conv_id, string_agg(concat(segment_no, chr(10), {s.srt_time('(end_ms-duration_ms)')}, ' --> ', {s.srt_time('end_ms')}, chr(10), text, chr(10)), chr(10) ORDER BY segment_no) AS srt
    FROM timed GROUP BY conv_id""",
)
def srt_text(spark, folder):
    return tl.srt_text(timeline(spark, folder), "conv_id")


@query(
    "srt_blocks",
    f"""WITH {_TIMED} SELECT conv_id, cast(segment_no AS bigint) AS number, concat(segment_no, chr(10), {s.srt_time('(end_ms-duration_ms)')}, ' --> ', {s.srt_time('end_ms')}, chr(10), text, chr(10)) AS block
    FROM timed""",
)
def srt_blocks(spark, folder):
    return tl.srt_blocks(timeline(spark, folder), "conv_id", stretch=8)


def _editions(spark, folder):
    """Every edition day of the items, whether or not something was selected."""
    return items(spark, folder).select(F.date_add(F.to_date("published_at"), 1).alias("edition")).distinct()


_ED = "eds AS (SELECT DISTINCT cast(date_trunc('day', published_at) AS date) + 1 AS edition FROM items)"


@query(
    "script_segments",
    f"""{cq._TOP}, {_ED}, n AS (SELECT eds.edition, count(top.id) AS n FROM eds LEFT JOIN top ON top.edition=eds.edition GROUP BY 1)
    SELECT edition, cast(0 AS bigint) AS seq, 'show' AS item_id, 'Intro' AS title, CASE WHEN n=0 THEN {s.q(fv.SCRIPT_EMPTY)} ELSE concat({s.q(fv.SCRIPT_INTRO[0])}, n, {s.q(fv.SCRIPT_INTRO[1])}) END AS text FROM n
    UNION ALL SELECT edition, n*2, 'show', 'Outro', {s.q(fv.SCRIPT_OUTRO)} FROM n WHERE n>0
    UNION ALL SELECT edition, rank*2-1, id, article_title, concat(rank, '、', {s.strip('article_title')}, '。', {s.strip('intro_summary')}) FROM top
    UNION ALL SELECT t.edition, rank*2, id, 'Transition', {s.q(fv.SCRIPT_TRANSITION)} FROM top t JOIN n ON n.edition=t.edition WHERE rank<n""",
)
def script_segments(spark, folder):
    return tl.script_segments(_editions(spark, folder), cq.top(spark, folder))


# --- edition texts ----------------------------------------------------------------------------------------------------------
_LINK = f"concat('[', {s.escape_md('source_name')}, '](<', source_url, '>)')"
_ITEM_BLOCK = f"""concat('<a id="', anchor, '"></a>', chr(10), chr(10), '### ', {s.escape_md('article_title')}, chr(10), chr(10), {{comment}}, {s.escape_md('intro_summary')}, '*', chr(10), '- Source: ', {_LINK}, chr(10),
  '- Published: ', strftime(published_at, '%Y-%m-%dT%H:%M:%S'), '.000Z', chr(10), '- Score: ', cross_relevance_score, chr(10), '- Tags: ',
  coalesce(nullif(array_to_string(list_transform(list_concat(ai_tags, game_tags), lambda t: {s.escape_md('t')}), ', '), ''), 'None'), chr(10), chr(10), {s.strip('article_body')}, chr(10), chr(10),
  'Sources:', chr(10), '1. ', {_LINK}, chr(10))"""


def _anchors_sql(src: str, scope: str) -> str:
    return f"""an0 AS (SELECT *, {s.slug('category')} AS category_anchor, concat({s.slug('category')}, '--', {s.slug('article_title')}) AS _base FROM {src}),
 an1 AS (SELECT *, row_number() OVER (PARTITION BY {scope}, _base ORDER BY rank) AS _n, min(rank) OVER (PARTITION BY {scope}, category) AS _place FROM an0),
 an AS (SELECT *, CASE WHEN _n=1 THEN _base ELSE concat(_base, '-', _n) END AS anchor FROM an1)"""


def _markdown_sql(scope: str, comment: str) -> str:
    block = _ITEM_BLOCK.replace("{comment}", s.q("*" + comment))
    return f"""md AS (SELECT *, row_number() OVER (PARTITION BY {scope}, category ORDER BY rank) = 1 AS opens, {block} AS block FROM an),
 body AS (SELECT {scope}, count(*) AS n, string_agg(concat('- **', {s.escape_md('article_title')}, '**: ', {s.escape_md('intro_summary')}), chr(10) ORDER BY rank) AS bullets,
   string_agg(concat(CASE WHEN opens THEN concat('- [', {s.escape_md('category')}, '](#', category_anchor, ')', chr(10)) ELSE '' END, '  - [', {s.escape_md('article_title')}, '](#', anchor, ')', chr(10)), '' ORDER BY _place, rank) AS toc,
   string_agg(concat(CASE WHEN opens THEN concat('## ', {s.escape_md('category')}, chr(10), chr(10)) ELSE '' END, block, chr(10)), '' ORDER BY _place, rank) AS sections FROM md GROUP BY {scope})"""


def _whole_sql(head: str, period: str, first: str, second: str, empty: str) -> str:
    return f"""concat(regexp_replace(concat('# ', {s.escape_md(head)}, chr(10), chr(10), {period}, chr(10), chr(10), '{first}', chr(10), chr(10), coalesce(bullets, {s.q(empty)}), chr(10), chr(10),
   '{second}', chr(10), chr(10), coalesce(toc, ''), chr(10), coalesce(sections, '')), '\\s+$', ''), chr(10))"""


@query(
    "edition_markdown",
    f"""{cq._TOP}, {_ED}, {_anchors_sql('top', 'edition')}, {_markdown_sql('edition', '小编评论：')}
    SELECT eds.edition, coalesce(n, 0) AS n_items, {_whole_sql(f"concat({s.q(fv.DAILY_TITLE)}, strftime(eds.edition, '%Y%m%d'))", "concat('Date: ', strftime(eds.edition, '%Y-%m-%d'))", '## Summary', '## Table of Contents', fv.EMPTY_DAY)} AS markdown
    FROM eds LEFT JOIN body ON body.edition=eds.edition""",
)
def edition_markdown(spark, folder):
    return ed.edition_markdown(ed.daily_headings(_editions(spark, folder)), cq.top(spark, folder))


@query(
    "edition_plain_markdown",
    f"""{cq._TOP}, {_ED}, pl AS (SELECT *, min(rank) OVER (PARTITION BY edition, category) AS _place, row_number() OVER (PARTITION BY edition, category ORDER BY rank) = 1 AS opens FROM top),
    body AS (SELECT edition, count(*) AS n, string_agg(concat('- **', {s.escape_md('article_title')}, '**：', {s.escape_md('intro_summary')}), chr(10) ORDER BY rank) AS bullets,
      string_agg(concat(CASE WHEN opens THEN concat('- ', {s.escape_md('category')}, chr(10)) ELSE '' END, '  - ', {s.escape_md('article_title')}, chr(10)), '' ORDER BY _place, rank) AS toc,
      string_agg(concat(CASE WHEN opens THEN concat('## ', {s.escape_md('category')}, chr(10), chr(10)) ELSE '' END, '### ', {s.escape_md('article_title')}, chr(10), chr(10), '**点评**：', {s.escape_md('intro_summary')}, chr(10), chr(10),
        {s.strip('article_body')}, chr(10), chr(10), '**来源**：', {_LINK}, chr(10), chr(10)), '' ORDER BY _place, rank) AS sections FROM pl GROUP BY edition)
    SELECT eds.edition, coalesce(n, 0) AS n_items, {_whole_sql(f"concat({s.q(fv.DAILY_TITLE)}, strftime(eds.edition, '%Y%m%d'))", "concat('> ', strftime(eds.edition, '%Y-%m-%d'))", '## 今日要点', '## 目录', fv.EMPTY_DAY_PLAIN)} AS markdown
    FROM eds LEFT JOIN body ON body.edition=eds.edition""",
)
def edition_plain_markdown(spark, folder):
    return ed.edition_markdown(ed.daily_headings(_editions(spark, folder)), cq.top(spark, folder), layout="plain")


_WEEKLY_TOP = f"""{cq._ENRICHED}, w0 AS (SELECT *, cast(date_trunc('week', edition) AS date) AS week FROM enriched WHERE is_topic_candidate AND duplicate_of IS NULL),
 w1 AS (SELECT *, cast(row_number() OVER (PARTITION BY week ORDER BY {cq._STORED_ORDER}) AS int) AS rank FROM w0), wk AS (SELECT * FROM w1 WHERE rank<=9)"""


@query(
    "weekly_markdown",
    f"""{_WEEKLY_TOP}, {_anchors_sql('wk', 'week')}, {_markdown_sql('week', '小编点评：')}
    SELECT week, n AS n_items, {_whole_sql(f"concat({s.q(fv.WEEKLY_TITLE)}, strftime(week, '%G-W%V'))", "concat('Period: ', strftime(week, '%Y-%m-%d'), ' to ', strftime(week + 6, '%Y-%m-%d'))", '## Weekly Highlights', '## Table of Contents', fv.EMPTY_WEEK)} AS markdown FROM body""",
)
def weekly_markdown(spark, folder):
    from pyspark.sql import Window

    rows = cq.enriched(spark, folder).filter("is_topic_candidate and duplicate_of is null")
    rows = rows.withColumn("week", F.date_trunc("week", F.col("edition").cast("timestamp_ntz")).cast("date"))
    best = Window.partitionBy("week").orderBy(F.desc("score"), F.desc("source_weight"), F.desc("published_at"), "arrival")
    top = cut_lineage(rows.withColumn("rank", F.row_number().over(best)).filter("rank <= 9"))
    return ed.edition_markdown(ed.weekly_headings(top.select("week").distinct()), top, layout="weekly", scope="week")


@query("unique_anchors", f"{cq._TOP}, {_anchors_sql('top', 'edition')} SELECT edition, id, category_anchor, anchor FROM an")
def unique_anchors(spark, folder):
    return ed.unique_anchors(cq.top(spark, folder), "edition").select("edition", "id", "category_anchor", "anchor")


# --- packages -----------------------------------------------------------------------------------------------------------------
_TAGS = """tg AS (SELECT edition, tag, rank, pos FROM (SELECT edition, rank, unnest(l) AS tag, unnest(range(0, len(l))) AS pos FROM (SELECT edition, rank, list_concat(ai_tags, game_tags, keywords) AS l FROM top)) WHERE tag NOT IN ('AI','Game','News')),
 tf AS (SELECT edition, tag, row_number() OVER (PARTITION BY edition ORDER BY rank, pos) AS k FROM (SELECT *, row_number() OVER (PARTITION BY edition, tag ORDER BY rank, pos) AS rn FROM tg) WHERE rn=1),
 tags AS (SELECT e.edition, concat('AI|Game|News', coalesce('|' || x.t, '')) AS tags FROM (SELECT DISTINCT edition FROM top) e LEFT JOIN (SELECT edition, string_agg(tag, '|' ORDER BY k) AS t FROM tf WHERE k<=17 GROUP BY 1) x ON x.edition=e.edition)"""


@query("edition_tags", f"{cq._TOP}, {_TAGS} SELECT edition, tags FROM tags")
def edition_tags(spark, folder):
    return ed.edition_tags(cq.top(spark, folder)).withColumn("tags", joined("tags"))


def packages(spark, folder):
    day = F.date_format("edition", "yyyy-MM-dd")
    paths = _editions(spark, folder).select(
        "edition", F.concat(day, F.lit("/daily.md")).alias("markdown_path"), F.concat(day, F.lit("/daily.mp4")).alias("video_path"),
        F.concat(day, F.lit("/subtitles.srt")).alias("subtitle_path"),
    )
    return ed.platform_packages(cq.top(spark, folder), paths)


_PLATFORMS = ", ".join(
    f"({s.q(n)}, {str(v).lower()}, {str(u).lower()}, {str(c).lower()}, {t if t else 'NULL'}, {d if d else 'NULL'})" for n, v, u, c, t, d in fv.PLATFORMS
)


def _limit_sql(x: str, limit: str) -> str:
    return f"CASE WHEN {limit} IS NULL OR length({x}) <= {limit} THEN {x} ELSE concat(regexp_replace(substr({x}, 1, cast({limit} AS int) - 3), '\\s+$', ''), '...') END"


_PACKAGES = f"""{cq._TOP}, {_ED}, {_TAGS},
 lk AS (SELECT edition, min(rank) AS place, source_name AS label, source_url AS url FROM top GROUP BY edition, source_name, source_url),
 lks AS (SELECT edition, list(concat(label, ': ', url) ORDER BY place) AS links FROM lk GROUP BY 1),
 stt AS (SELECT edition, list(concat(rank, '. ', article_title, ' - ', {s.strip('intro_summary')}) ORDER BY rank) AS stories, arg_min({s.strip('article_title')}, rank) AS first_title FROM top GROUP BY 1),
 pk AS (SELECT eds.edition, concat(strftime(eds.edition, '%Y-%m-%d'), {s.q(fv.PACKAGE_TITLE)}, CASE WHEN coalesce(first_title,'')<>'' THEN concat(': ', first_title) ELSE '' END) AS full_title,
   concat({s.q(fv.PACKAGE_HEAD)}, chr(10), CASE WHEN stories IS NULL THEN '' ELSE concat(array_to_string(stories, chr(10)), chr(10)) END, chr(10), 'Sources:', chr(10),
     CASE WHEN links IS NULL THEN '' ELSE concat(array_to_string(list_transform(list_zip(links, range(1, len(links)+1)), lambda z: concat(z[2], '. ', z[1])), chr(10)), chr(10)) END, chr(10), {s.q(fv.PACKAGE_TAIL)}, chr(10)) AS full_text,
   coalesce(tags, 'AI|Game|News') AS tags FROM eds LEFT JOIN stt ON stt.edition=eds.edition LEFT JOIN lks ON lks.edition=eds.edition LEFT JOIN tags ON tags.edition=eds.edition),
 platforms(platform, video, subtitles, content, title_limit, description_limit) AS (VALUES {_PLATFORMS}),
 packages AS (SELECT edition, platform, {_limit_sql('full_title', 'title_limit')} AS title, {_limit_sql('full_text', 'description_limit')} AS description, tags,
   CASE WHEN subtitles THEN concat(strftime(edition, '%Y-%m-%d'), '/subtitles.srt') END AS subtitle_path, CASE WHEN video THEN concat(strftime(edition, '%Y-%m-%d'), '/daily.mp4') END AS video_path,
   CASE WHEN content THEN concat(strftime(edition, '%Y-%m-%d'), '/daily.md') END AS content_path FROM pk, platforms)"""


@query("platform_packages", f"{_PACKAGES} SELECT * FROM packages")
def platform_packages(spark, folder):
    found = packages(spark, folder)
    return found.select("edition", "platform", "title", "description", joined("tags").alias("tags"), "subtitle_path", "video_path", "content_path")


@query(
    "package_violations",
    f"""{_PACKAGES}, d AS (SELECT edition, platform, concat(title, repeat('x', 40)) AS title, concat(description, repeat('y', 3000)) AS description FROM packages)
    SELECT edition, platform, 'title' AS field, cast(length(title) AS int) AS length, 100 AS "limit" FROM d WHERE platform='youtube' AND length(title)>100
    UNION ALL SELECT edition, platform, 'description', cast(length(description) AS int), CASE platform WHEN 'youtube' THEN 5000 ELSE 2000 END FROM d
      WHERE (platform='youtube' AND length(description)>5000) OR (platform='bilibili' AND length(description)>2000)""",
)
def package_violations(spark, folder):
    longer = packages(spark, folder).select(
        "edition", "platform", F.concat("title", F.repeat(F.lit("x"), 40)).alias("title"), F.concat("description", F.repeat(F.lit("y"), 3000)).alias("description"),
        "title_limit", "description_limit",
    )
    return ed.package_violations(longer)


# --- table maintenance ------------------------------------------------------------------------------------------------------------
_NOW = "2024-02-01 00:00:00"


@query(
    "upsert_sources",
    f"""WITH {REGISTRY}, one AS (SELECT name, arg_max(source_weight, id) AS source_weight, max_by(struct_pack(u := url), id).u AS url, cast(substr(name,4) AS int) AS n FROM reg GROUP BY name),
    o AS (SELECT * FROM one WHERE n%3<>0), w AS (SELECT * FROM one WHERE n%2=0)
    SELECT coalesce(o.name, w.name) AS name, CASE WHEN w.name IS NOT NULL THEN w.source_weight+1 ELSE o.source_weight END AS weight, CASE WHEN w.name IS NOT NULL THEN w.url ELSE o.url END AS url,
      CASE WHEN o.name IS NOT NULL THEN timestamp '2024-01-01 00:00:00' ELSE timestamp '{_NOW}' END AS created_at,
      CASE WHEN w.name IS NOT NULL THEN timestamp '{_NOW}' ELSE timestamp '2024-01-01 00:00:00' END AS updated_at FROM o FULL JOIN w ON o.name=w.name""",
)
def upsert_sources(spark, folder):
    reg = registry(spark, folder)
    # two registry rows share a name on purpose; the store keeps one row per name
    rows = st.latest_per_key(reg.select("name", F.col("source_weight").alias("weight"), "url", "id"), "name", "id")
    n = F.substring("name", 4, 10).cast("int")
    first = dt.ntz("2024-01-01 00:00:00")
    old = rows.filter(n % 3 != 0).select("name", "weight", "url", first.alias("created_at"), first.alias("updated_at"))
    new = rows.filter(n % 2 == 0).select("name", (F.col("weight") + 1).alias("weight"), "url")
    return st.upsert(old, new, "name", dt.ntz(_NOW), replace=True)


@query(
    "upsert_items",
    f"""WITH {s.ITEMS}, o AS (SELECT id, article_title, raw_content, source_name FROM items WHERE collected_at < timestamp '{SPLIT}'),
    w AS (SELECT id, concat('New ', article_title) AS article_title, 77 AS score FROM items WHERE collected_at >= timestamp '2024-01-11 00:00:00')
    SELECT coalesce(o.id, w.id) AS id, coalesce(w.article_title, o.article_title) AS article_title, coalesce(o.source_name, '') AS source_name, md5(coalesce(o.raw_content, '')) AS digest, coalesce(w.score, 0) AS score,
      CASE WHEN o.id IS NULL THEN timestamp '{_NOW}' ELSE timestamp '2024-01-01 00:00:00' END AS created_at, CASE WHEN w.id IS NULL THEN timestamp '2024-01-01 00:00:00' ELSE timestamp '{_NOW}' END AS updated_at
    FROM o FULL JOIN w ON o.id=w.id""",
)
def upsert_items(spark, folder):
    it = items(spark, folder)
    first = dt.ntz("2024-01-01 00:00:00")
    old = it.filter(F.col("collected_at") < dt.ntz(SPLIT)).select("id", "article_title", "raw_content", "source_name", first.alias("created_at"), first.alias("updated_at"))
    new = it.filter(F.col("collected_at") >= dt.ntz("2024-01-11 00:00:00")).select("id", F.concat(F.lit("New "), "article_title").alias("article_title"), F.lit(77).alias("score"))
    merged = st.upsert(old, new, "id", dt.ntz(_NOW), defaults=st.item_defaults())
    return merged.select("id", "article_title", "source_name", F.md5("raw_content").alias("digest"), "score", "created_at", "updated_at")


@query(
    "evolve_schema",
    f"WITH {s.ITEMS} SELECT id, source_type, '' AS summary, 0 AS score, doc_id%10=1 AS is_mock, 'x' AS extra FROM items",
)
def evolve_schema(spark, folder):
    it = linked(spark, folder)
    old = it.select(F.when(F.col("doc_id") % 10 == 1, F.concat(F.lit("mock-"), "id")).otherwise(F.col("id")).alias("id"), "source_type")
    new = st.evolve(old.withColumn("is_mock", st.mock_flag(F.col("id"))), {**st.item_defaults(), "extra": F.lit("x")})
    return new.select(F.regexp_replace("id", "^mock-", "").alias("id"), "source_type", "summary", "score", "is_mock", "extra")


@query("sink_editions", f"{cq._TOP} SELECT edition, id, rank, score FROM top")
def sink_editions(spark, folder):
    """Editions written one folder each, written again (only their own folders are replaced), and read back."""
    path = scratch(spark, "editions")
    rows = cq.top(spark, folder).select("edition", "id", "rank", "score")
    st.write_editions(rows, path)
    st.write_editions(rows, path)
    return st.read_editions(spark, path, schema="id string, rank int, score int, edition date").select("edition", "id", "rank", "score")


# --- incremental forms ----------------------------------------------------------------------------------------------------------------
INGEST_COLUMNS = ["id", "arrival", "source_url", "article_title", "raw_content", "published_at", "collected_at", "source_type", "source_weight"]
INGEST_DAYS, INGEST_SLICES, INGEST_HOURS = 8, 4, 6
# hours since the first collection are in the arrival, which every CTE has
_SLICE = f"least((({{0}}.arrival // 1000000000) + 60) // {1440 * INGEST_DAYS}, {INGEST_SLICES - 1})"
#: Rows are kept as by one pass over all slices; every slice is longer than the window, so near matches stay inside a slice (tests/test_ingest.py
#: has windows that reach back).
_INGESTED = f"""WITH RECURSIVE {s.ITEMS}, k AS MATERIALIZED (SELECT id, dense_rank() OVER (ORDER BY url_key) AS url_key, dense_rank() OVER (ORDER BY sha256({s.norm('raw_content')})) AS hash_key,
      row_number() OVER (ORDER BY arrival) AS n FROM items),
    step AS (SELECT cast(0 AS bigint) AS n, cast([] AS bigint[]) AS urls, cast([] AS bigint[]) AS hashes, cast(NULL AS varchar) AS kept
      UNION ALL SELECT k.n, CASE WHEN seen THEN urls ELSE list_append(urls, url_key) END, CASE WHEN seen THEN hashes ELSE list_append(hashes, hash_key) END,
        CASE WHEN NOT seen THEN id END
      FROM (SELECT k.*, step.urls, step.hashes, list_contains(step.urls, k.url_key) OR list_contains(step.hashes, k.hash_key) AS seen FROM step JOIN k ON k.n = step.n + 1) k),
    rows AS MATERIALIZED (SELECT items.*, {_SLICE.format('items')} AS batch_id FROM items WHERE id IN (SELECT kept FROM step WHERE kept IS NOT NULL)),
    toks AS MATERIALIZED (SELECT id, arrival, id AS url_key, id AS hash_key, {s.tokens(s.norm_title('article_title'))} AS tset, {s.tokens('raw_content')} AS bset FROM rows),
    {s.best_match(f"{_SLICE.format('a')} = {_SLICE.format('b')}")},
    root AS (SELECT id, id AS root FROM rows WHERE id NOT IN (SELECT id FROM best) UNION ALL SELECT b.id, r.root FROM best b JOIN root r ON b.parent=r.id),
    tagged AS (SELECT rows.*, root.root, best.score FROM rows JOIN root ON root.id=rows.id LEFT JOIN best ON best.id=rows.id),
    win AS (SELECT root, id AS winner FROM (SELECT root, id, row_number() OVER (PARTITION BY root ORDER BY {s.PREFERENCE}) AS rn FROM tagged) WHERE rn=1)"""


def ingest_slices(spark, folder):
    """Items in slices of eight days of collection: (number, rows)."""
    rows = items(spark, folder).select(*INGEST_COLUMNS)
    number = F.least(F.floor(F.datediff("collected_at", F.lit("2024-01-01")) / INGEST_DAYS), F.lit(INGEST_SLICES - 1))
    return [rows.filter(number == n) for n in range(INGEST_SLICES)]


@query(
    "stream_ingest",
    f"""{_INGESTED} SELECT tagged.id, source_url, collected_at, CASE WHEN winner<>tagged.id THEN winner END AS duplicate_of, round(score, 6) AS duplicate_score, batch_id
    FROM tagged JOIN win ON win.root=tagged.root""",
)
def stream_ingest(spark, folder):
    """Documents arrive slice by slice; the stream is started again for each and goes on where it ended. Closed days are rewritten once."""
    inbox, store, progress = scratch(spark, "inbox"), scratch(spark, "store"), scratch(spark, "progress")
    for n, rows in enumerate(ingest_slices(spark, folder)):
        rows.write.mode("append").parquet(inbox)
        feed = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1_000_000).parquet(inbox)
        stream.start_ingest(feed, store, progress, INGEST_HOURS).awaitTermination()
        if n == 2:
            ItemStore(spark, store).compact(date(2024, 1, 20), folders=1)
    found = stream.stored_items(spark, store).select("id", "source_url", "collected_at", "duplicate_of", "duplicate_score", "batch_id")
    return found.withColumn("duplicate_score", F.round("duplicate_score", 6))


@query(
    "run_ledger",
    f"""WITH {s.ITEMS}, n AS (SELECT {_SLICE.format('items')} AS slice, count(*) AS n FROM items GROUP BY 1)
    SELECT concat('load-', slice) AS id, CASE WHEN slice=3 THEN 'failed' ELSE 'completed' END AS status, CASE WHEN slice=1 THEN 2 ELSE 1 END AS attempts, CASE WHEN slice IN (1, 3) THEN 1 ELSE 0 END AS failures,
      CASE WHEN slice=3 THEN 'ValueError: the source broke off' END AS error, CASE WHEN slice=3 THEN 0 ELSE coalesce(n, 0) END AS visible
    FROM (SELECT unnest(range({INGEST_SLICES})) AS slice) LEFT JOIN n USING (slice)""",
)
def run_ledger(spark, folder):
    """Loads that write and then record; the second fails after writing and is repeated, the last fails and is not."""
    store = scratch(spark, "ledger")
    ledger = Ledger(spark, f"{store}/runs")

    def load(n, rows, breaks):
        with contextlib.suppress(ValueError), ledger.run(f"load-{n}", {"slice": n}) as run:
            rows.select("id", F.lit(n).alias("slice")).write.parquet(f"{store}/raw/{run.attempt}")
            run.adds.append(f"raw/{run.attempt}")
            if breaks:
                raise ValueError("the source broke off")

    for n, rows in enumerate(ingest_slices(spark, folder)):
        load(n, rows, breaks=n in (1, 3))
        if n == 1:
            load(n, rows, breaks=False)
    loaded = read_or_empty(spark, absolute(store, ledger.state().below("raw")), "id string, slice int")
    seen = loaded.groupBy(F.concat(F.lit("load-"), F.col("slice").cast("string")).alias("id")).agg(F.count("*").alias("visible"))
    runs = ledger.runs().join(seen, "id", "left")
    return runs.select("id", "status", F.col("attempts").cast("int").alias("attempts"), F.col("failures").cast("int").alias("failures"), "error", F.coalesce("visible", F.lit(0)).cast("bigint").alias("visible"))


def _drain(spark, frame, name, mode="append"):
    """Run a streaming frame over the available input and return what it wrote."""
    out = scratch(spark, name)
    q = frame.writeStream.format("parquet").outputMode(mode).option("path", out).option("checkpointLocation", scratch(spark, name + "-progress"))
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(frame.schema).parquet(out)


def events_stream(spark, folder):
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type, props FROM events")
def stream_dedupe(spark, folder):
    kept = stream.stream_dedupe(events_stream(spark, folder), ["user_id", "event_type", "props"])
    return _drain(spark, kept.select("user_id", "event_type", "props"), "dedupe")


@query(
    "stream_window_counters",
    """SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + interval 1 day AS window_end, event_type, count(*) AS fetched, max(ts) AS newest, min(ts) AS oldest
    FROM events GROUP BY 1, 2, 3 HAVING date_trunc('day', ts) + interval 1 day <= (SELECT max(ts) FROM events) - interval 1 hour""",
)
def stream_window_counters(spark, folder):
    counted = stream.window_counters(events_stream(spark, folder), "event_type", late="1 hour")
    times = ("window_start", "window_end", "newest", "oldest")
    return _drain(spark, counted, "windows").withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


@query(
    "stream_canonical",
    f"""WITH {s.ITEMS}, k AS (SELECT sha256({s.norm('raw_content')}) AS key, id, arrival,
      min({{'a': CASE WHEN source_type='official' THEN 0 ELSE 1 END, 'b': published_at, 'c': -source_weight, 'd': collected_at, 'e': arrival, 'id': id}}) OVER (PARTITION BY sha256({s.norm('raw_content')}) ORDER BY arrival ROWS UNBOUNDED PRECEDING).id AS root FROM items),
    l AS (SELECT *, lag(root) OVER (PARTITION BY key ORDER BY arrival) AS before FROM k)
    SELECT key, id, root, CASE WHEN before <> root THEN before END AS replaced FROM l""",
)
def stream_canonical(spark, folder):
    inbox = scratch(spark, "inbox")
    items(spark, folder).drop("doc_id").write.mode("append").parquet(inbox)
    feed, store = spark.readStream.schema(spark.read.parquet(inbox).schema).parquet(inbox), scratch(spark, "roots")
    stream.start_roots(feed, store, scratch(spark, "roots-progress")).awaitTermination()
    return stream.followed_roots(spark, store).select("key", "id", "root", "replaced")
