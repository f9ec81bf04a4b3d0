"""Queries over the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import dates as dt
from gleaner.functions import text as tx
from gleaner.functions import urls as ul
from gleaner.plans import sql as s
from gleaner.plans.registry import query
from gleaner.plans.testbed import items, table


def docs(spark, folder):
    return table(spark, folder, "documents")


def title(c="text"):
    return tx.first_line(F.col(c))


@query("canonical_url", f"SELECT page_id, {s.canonical('url')} AS canonical FROM pages")
def canonical_url(spark, folder):
    return table(spark, folder, "pages").select("page_id", ul.canonical_url(F.col("url")).alias("canonical"))


@query(
    "valid_http_url",
    r"""SELECT page_id, regexp_matches(url, '^https?://[^/?#\s]+') AS valid, false AS valid_ftp,
    false AS valid_bare, regexp_matches(url, '^https?://[^/?#\s]+') AS valid_upper FROM pages""",
)
def valid_http_url(spark, folder):
    url = F.col("url")
    return table(spark, folder, "pages").select(
        "page_id",
        ul.is_http_url(url).alias("valid"),
        ul.is_http_url(F.regexp_replace(url, "^https?", "ftp")).alias("valid_ftp"),
        ul.is_http_url(F.regexp_replace(url, "^https?://", "")).alias("valid_bare"),
        ul.is_http_url(F.upper(url)).alias("valid_upper"),
    )


@query("normalize_text", f"SELECT doc_id, md5({s.norm('text')}) AS digest, cast(length({s.norm('text')}) AS int) AS n FROM documents")
def normalize_text(spark, folder):
    n = tx.normalize_text(F.col("text"))
    return docs(spark, folder).select("doc_id", F.md5(n).alias("digest"), F.length(n).alias("n"))


@query("normalize_title", f"WITH {s.ITEMS} SELECT id, {s.norm_title('article_title')} AS title FROM items")
def normalize_title(spark, folder):
    return items(spark, folder).select("id", tx.normalize_title(F.col("article_title")).alias("title"))


@query("content_hash", f"SELECT doc_id, sha256({s.norm('text')}) AS hash FROM documents")
def content_hash(spark, folder):
    return docs(spark, folder).select("doc_id", tx.content_hash(F.col("text")).alias("hash"))


@query("token_set", f"SELECT doc_id, cast(len({s.tokens('text')}) AS int) AS n, md5(array_to_string(list_sort({s.tokens('text')}), ' ')) AS digest FROM documents")
def token_set(spark, folder):
    tokens = docs(spark, folder).select("doc_id", tx.token_set(F.col("text")).alias("t"))
    return tokens.select("doc_id", F.size("t").alias("n"), F.md5(F.array_join(F.sort_array("t"), " ")).alias("digest"))


@query("stem_tokens", f"SELECT doc_id, cast(len({s.stems('text')}) AS int) AS n, md5(array_to_string({s.stems('text')}, ' ')) AS digest FROM documents")
def stem_tokens(spark, folder):
    tokens = docs(spark, folder).select("doc_id", tx.stem_tokens(F.col("text")).alias("t"))
    return tokens.select("doc_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ")).alias("digest"))


@query(
    "jaccard",
    f"WITH {s.ITEMS}, t AS (SELECT id, {s.tokens(s.norm_title('article_title'))} AS a, {s.tokens('raw_content')} AS b FROM items) "
    f"SELECT id, round({s.jaccard('a', 'b')}, 9) AS similarity FROM t",
)
def jaccard(spark, folder):
    sets = items(spark, folder).select(
        "id", tx.token_set(tx.normalize_title(F.col("article_title"))).alias("a"), tx.token_set(F.col("raw_content")).alias("b")
    )
    return sets.select("id", F.round(tx.jaccard(F.col("a"), F.col("b")), 9).alias("similarity"))


@query(
    "clamp_text",
    f"SELECT doc_id, {s.clamp('text', 60)} AS dots, {s.clamp('text', 60, '…', False)} AS mark, {s.clamp('text', 500)} AS paragraph FROM documents",
)
def clamp_text(spark, folder):
    text = F.col("text")
    return docs(spark, folder).select(
        "doc_id", tx.clamp(text, 60).alias("dots"), tx.clamp(text, 60, "…", tidy=False).alias("mark"), tx.clamp(text, 500).alias("paragraph")
    )


@query("first_line", f"SELECT doc_id, {s.first_line('text')} AS line, md5({s.rest_lines('text')}) AS rest FROM documents")
def first_line(spark, folder):
    return docs(spark, folder).select("doc_id", tx.first_line(F.col("text")).alias("line"), F.md5(tx.rest_lines(F.col("text"))).alias("rest"))


@query("html_to_text", f"SELECT page_id, {s.html_text('html')} AS text FROM pages")
def html_to_text(spark, folder):
    return table(spark, folder, "pages").select("page_id", tx.html_to_text(F.col("html")).alias("text"))


@query(
    "split_sentences",
    f"SELECT conv_id, turn, cast(len({s.sentences('text')}) AS int) AS n, array_to_string({s.sentences('text')}, '|') AS sentences FROM conversations",
)
def split_sentences(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", tx.split_sentences(F.col("text")).alias("x"))
    return rows.select("conv_id", "turn", F.size("x").alias("n"), F.array_join("x", "|").alias("sentences"))


@query("low_information", f"SELECT doc_id, {s.low_information('text')} AS low FROM documents")
def low_information(spark, folder):
    return docs(spark, folder).select("doc_id", tx.is_low_information(F.col("text")).alias("low"))


@query("slugify", f"WITH {s.ITEMS} SELECT id, {s.slug('article_title')} AS slug FROM items")
def slugify(spark, folder):
    return items(spark, folder).select("id", tx.slugify(F.col("article_title")).alias("slug"))


@query(
    "escape_texts",
    rf"""WITH {s.ITEMS} SELECT id, {s.escape_md('article_title')} AS markdown,
    replace(replace(replace(replace(replace(article_title,'&','&amp;'),'<','&lt;'),'>','&gt;'),'"','&quot;'),'''','&#39;') AS html FROM items""",
)
def escape_texts(spark, folder):
    return items(spark, folder).select(
        "id", tx.escape_markdown(F.col("article_title")).alias("markdown"), tx.escape_html(F.col("article_title")).alias("html")
    )


@query(
    "mojibake_flag",
    f"""SELECT doc_id, len(regexp_extract_all(concat(text, CASE WHEN doc_id%7=0 THEN '锛x' ELSE '' END, CASE WHEN doc_id%5=0 THEN '銆' ELSE '' END),
    '{fv.MOJIBAKE_CLASS}')) >= 2 AS flag FROM documents""",
)
def mojibake_flag(spark, folder):
    damaged = F.concat(
        "text", F.when(F.col("doc_id") % 7 == 0, F.lit("锛x")).otherwise(F.lit("")), F.when(F.col("doc_id") % 5 == 0, F.lit("銆")).otherwise(F.lit(""))
    )
    return docs(spark, folder).select("doc_id", tx.looks_like_mojibake(damaged).alias("flag"))


@query(
    "parse_listing_time",
    """SELECT event_id, CASE event_id%6 WHEN 0 THEN ts - to_minutes(cast(event_id%50 AS int)) WHEN 1 THEN ts - to_hours(cast(event_id%50 AS int))
      WHEN 2 THEN ts - to_days(cast(event_id%50 AS int)) WHEN 3 THEN date_trunc('day', ts) - interval 8 hours
      WHEN 4 THEN date_trunc('second', ts) - interval 8 hours END AS published_at FROM events""",
)
def parse_listing_time(spark, folder):
    n, kind, ts = F.col("event_id") % 50, F.col("event_id") % 6, F.col("ts")
    written = (
        F.when(kind == 0, F.concat(n.cast("string"), F.lit(" 分钟前")))
        .when(kind == 1, F.concat(n.cast("string"), F.lit("小时前")))
        .when(kind == 2, F.concat(n.cast("string"), F.lit(" 天前 ")))
        .when(kind == 3, F.date_format(ts, "MM月dd日"))
        .when(kind == 4, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.lit("soon"))
    )
    return table(spark, folder, "events").select("event_id", dt.listing_time(written, ts).alias("published_at"))


@query("iso_week", "SELECT event_id, strftime(ts, '%G-W%V') AS week, cast(date_trunc('week', ts) AS date) AS monday FROM events")
def iso_week(spark, folder):
    return table(spark, folder, "events").select("event_id", dt.iso_week_key(F.col("ts")).alias("week"), dt.week_start(F.col("ts")).alias("monday"))


@query(
    "freshness_hours",
    f"WITH {s.ITEMS} SELECT id, " + s.freshness("timestamp '2024-02-01 00:00:00'", "published_at") + " AS hours FROM items",
)
def freshness_hours(spark, folder):
    return items(spark, folder).select("id", dt.freshness_hours(dt.ntz("2024-02-01 00:00:00"), F.col("published_at")).alias("hours"))


@query("srt_time", f"SELECT event_id, {s.srt_time('event_id*97713')} AS stamp FROM events")
def srt_time(spark, folder):
    return table(spark, folder, "events").select("event_id", dt.srt_time(F.col("event_id") * 97713).alias("stamp"))


@query("speech_duration", f"SELECT conv_id, turn, {s.speech_ms('text')} AS ms, cast(greatest(3000, 45*length(text)) AS bigint) AS article_ms FROM conversations")
def speech_duration(spark, folder):
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", dt.speech_ms(F.col("text")).alias("ms"), dt.article_ms(F.col("text")).alias("article_ms")
    )


@query(
    "json_field",
    "SELECT event_id, CASE WHEN event_id%5=0 THEN -1 ELSE cast(json_extract_string(props, '$.k') AS int) END AS k FROM events",
)
def json_field(spark, folder):
    broken = F.when(F.col("event_id") % 5 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    value = F.try_variant_get(F.try_parse_json(broken), "$.k", "int")
    return table(spark, folder, "events").select("event_id", F.coalesce(value, F.lit(-1)).alias("k"))


@query(
    "render_template",
    """SELECT event_id, CASE WHEN event_id%9<>0 THEN concat('User ', user_id, ' did ', event_type, ' (', event_type, ')') END AS prompt FROM events""",
)
def render_template(spark, folder):
    template = F.when(F.col("event_id") % 9 == 0, F.lit("User {{user}} wrote {{missing}}")).otherwise(F.lit("User {{user}} did {{kind}} ({{kind}})"))
    filled = tx.render_template(template, {"user": F.col("user_id").cast("string"), "kind": F.col("event_type")})
    return table(spark, folder, "events").select("event_id", filled.alias("prompt"))
