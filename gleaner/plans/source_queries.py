"""Queries over extraction and the source registry.

Payloads that the tables do not hold (feeds, JSON answers, templated listings, front-matter files) are composed from
the documents in Spark, so their volume grows with the documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import dates as dt
from gleaner.functions import text as tx
from gleaner.plans import sql as s
from gleaner.plans.registry import query
from gleaner.plans.testbed import items, table
from gleaner.sources import extract as ex
from gleaner.sources import registry as rg

NOW = "2024-02-01 00:00:00"


def _xml(c):
    return tx.escape_html(c)


def _payloads(spark, folder, per_payload=20):
    """Documents grouped into payload pages of ``per_payload`` rows: ``payload_id, rows`` in order."""
    it = items(spark, folder).withColumn("headline", tx.collapse(F.col("article_title")))
    it = it.withColumn("payload_id", F.floor(F.col("doc_id") / per_payload).cast("bigint"))
    row = F.struct("doc_id", "headline", "source_url", "published_at", "source_name")
    return it.groupBy("payload_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))


def _as_payload(df, source_id, base_url):
    known = F.when(F.col("payload_id").isNotNull(), F.lit(source_id))
    return df.withColumns({"source_id": known, "base_url": F.lit(base_url), "collected_at": dt.ntz(NOW)})


@query(
    "extract_page_links",
    f"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>')) AS anchor,
      unnest(range(0, len(regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>')))) AS pos FROM pages),
    b AS (SELECT page_id, pos, regexp_extract(anchor, '(?i)\\bhref="([^"]+)"', 1) AS href, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS origin,
      {s.html_text("regexp_extract(anchor, '(?is)^<a[^>]*>(.*)</a>$', 1)")} AS title FROM a),
    c AS (SELECT page_id, pos, title, concat(origin, array_to_string(list_transform(regexp_extract_all(href, '.'), lambda ch:
      CASE WHEN regexp_matches(ch, '[a-zA-Z0-9/.,]') THEN ch ELSE url_encode(ch) END), '')) AS url FROM b WHERE length(title) >= 4),
    d AS (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY pos) AS rn FROM c)
    SELECT page_id, cast(pos AS int) AS pos, title, url FROM d WHERE rn = 1""",
)
def extract_page_links(spark, folder):
    pages = table(spark, folder, "pages").select(
        F.col("page_id").alias("payload_id"), F.lit("pages").alias("source_id"), F.col("url").alias("base_url"),
        F.col("html").alias("payload"), dt.ntz(NOW).alias("collected_at"),
    )
    return ex.page_links(pages).select(F.col("payload_id").alias("page_id"), "pos", "title", "url")


_EXPECTED = f"""WITH {s.ITEMS}, h AS (SELECT *, {s.collapse('article_title')} AS headline FROM items)
SELECT doc_id//20 AS payload_id, headline AS title, {{url}} AS url, {{published}} AS published_at, {{more}} FROM h WHERE headline <> ''"""


@query(
    "extract_feed_items",
    _EXPECTED.format(
        url="url_key", published="CASE WHEN doc_id%4=0 THEN timestamp '2024-02-01 00:00:00' ELSE date_trunc('second', published_at) END",
        more="CASE WHEN doc_id%3=0 THEN source_name END AS author, CASE WHEN doc_id%2=0 THEN concat('About ', headline) ELSE '' END AS excerpt",
    ),
)
def extract_feed_items(spark, folder):
    def entry(r):
        n = r["doc_id"]
        atom = F.floor(n / 20) % 2 == 1
        link = F.when(atom, F.concat(F.lit('<link rel="alternate" href="'), _xml(r["source_url"]), F.lit('#top"/>'))).otherwise(
            F.concat(F.lit("<link>"), _xml(r["source_url"]), F.lit("</link>"))
        )
        stamp = F.when(atom, F.date_format(r["published_at"], "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
            F.concat(F.date_format(r["published_at"], "E, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
        )
        stamp = F.when(n % 4 == 0, F.lit("soon")).otherwise(stamp)
        date_tag = F.when(atom, F.concat(F.lit("<updated>"), stamp, F.lit("</updated>"))).otherwise(F.concat(F.lit("<pubDate>"), stamp, F.lit("</pubDate>")))
        about = F.when(n % 2 == 0, F.concat(F.lit("<description><![CDATA[About <b>"), r["headline"], F.lit("</b>]]></description>"))).otherwise(F.lit(""))
        author = F.when(n % 3 == 0, F.concat(F.lit("<dc:creator>"), r["source_name"], F.lit("</dc:creator>"))).otherwise(F.lit(""))
        tag = F.when(atom, F.lit("entry")).otherwise(F.lit("item"))
        return F.concat(
            F.lit("<"), tag, F.lit("><title>"), _xml(r["headline"]), F.lit("</title>"), link, about, date_tag, author, F.lit("</"), tag, F.lit(">")
        )

    feeds = _payloads(spark, folder).withColumn(
        "payload", F.concat(F.lit('<?xml version="1.0"?><rss><channel>'), F.array_join(F.transform("rows", entry), ""), F.lit("</channel></rss>"))
    )
    found = ex.feed_items(_as_payload(feeds, "feed", "https://news.example.com/feed"))
    return found.select("payload_id", "title", "url", "published_at", "author", "excerpt")


@query(
    "extract_json_items",
    _EXPECTED.format(
        url="concat('https://www.youxituoluo.com/', doc_id, '.html')", published="date_trunc('second', published_at)",
        more="concat('About ', headline) AS excerpt, CASE WHEN doc_id%2=0 THEN source_name ELSE concat(source_name, '|news') END AS tags",
    ),
)
def extract_json_items(spark, folder):
    def record(r):
        named = F.concat(F.lit('{"name":"'), r["source_name"], F.lit('"}'))
        tags = F.when(r["doc_id"] % 2 == 0, named).otherwise(F.concat(named, F.lit(',"news"')))
        fields = F.to_json(
            F.struct(
                r["doc_id"].alias("aid"), r["headline"].alias("title"), F.concat(F.lit("About "), r["headline"]).alias("dis"),
                F.unix_timestamp(r["published_at"].cast("timestamp")).alias("sendtime"),
            )
        )
        return F.concat(F.regexp_replace(fields, r"\}$", ""), F.lit(',"tags":['), tags, F.lit("]}"))

    payloads = _payloads(spark, folder).withColumn(
        "payload", F.concat(F.lit('{"code":200,"data":{"data":['), F.array_join(F.transform("rows", record), ","), F.lit("]}}"))
    )
    found = ex.json_items(_as_payload(payloads, "json", "https://www.youxituoluo.com/"))
    return found.select("payload_id", "title", "url", "published_at", "excerpt", F.array_join("tags", "|").alias("tags"))


# a repeated URL belongs to the page it came on first; with pages of 20, number 10k+1 follows 10k on the same page
_FIRST_URL = f"""WITH {s.ITEMS}, h AS (SELECT *, {s.collapse('article_title')} AS headline FROM items),
f AS (SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY doc_id) AS rn FROM h WHERE headline <> '')
SELECT doc_id//20 AS payload_id, headline AS title, url_key AS url, {{published}} AS published_at, concat('About ', headline) AS excerpt FROM f WHERE rn=1"""


@query("extract_jsonp_items", _FIRST_URL.format(published="date_trunc('minute', published_at)"))
def extract_jsonp_items(spark, folder):
    def item(r):
        local = F.date_format(dt.shift_hours(r["published_at"], 8), "yyyy-MM-dd HH:mm")
        return F.concat(
            F.lit('<li><div class="tit"><a class="tt" href="'), _xml(r["source_url"]), F.lit('" target="_blank">'), _xml(r["headline"]),
            F.lit('</a></div><div class="con"><div class="txt">About '), _xml(r["headline"]), F.lit('</div><div class="time">'), local, F.lit("</div></div></li>"),
        )

    body = F.to_json(F.struct(F.array_join(F.transform("rows", item), "\n").alias("body")))
    payloads = _payloads(spark, folder).withColumn("payload", F.concat(F.lit("("), body, F.lit(");")))
    found = ex.jsonp_items(_as_payload(payloads, "jsonp", "https://news.example.com/"))
    return found.select("payload_id", "title", "url", "published_at", "excerpt")


@query("extract_templated_items", _FIRST_URL.format(published="date_trunc('second', published_at)"))
def extract_templated_items(spark, folder):
    def item(r):
        local = F.date_format(dt.shift_hours(r["published_at"], 8), "yyyy-MM-dd HH:mm:ss")
        path = F.regexp_replace(r["source_url"], "^https://news.example.com", "")
        return F.concat(
            F.lit('<li class="selectpost"><a href="'), _xml(path), F.lit('" target="_blank" class="bt">'), _xml(r["headline"]),
            F.lit('</a><div class="bq"><span class="time">'), local, F.lit('</span></div><div class="miaoshu">About '), _xml(r["headline"]), F.lit("</div></li>"),
        )

    payloads = _payloads(spark, folder).withColumn("payload", F.concat(F.lit("<ul>"), F.array_join(F.transform("rows", item), "\n"), F.lit("</ul>")))
    found = ex.templated_items(_as_payload(payloads, "3dm", "https://news.example.com/list"), ex.listing_templates(spark))
    return found.select("payload_id", "title", "url", "published_at", "excerpt")


@query(
    "read_frontmatter_docs",
    rf"""WITH {s.ITEMS}, h AS (SELECT *, {s.collapse('article_title')} AS headline FROM items)
    SELECT concat('doc-', doc_id, '.md') AS file_name, CASE WHEN doc_id%3=0 THEN coalesce(nullif({s.strip(r"regexp_extract(raw_content, '(?m)^#\s+(.+)$', 1)")}, ''), concat('doc-', doc_id))
        ELSE regexp_replace(headline, '^["'']|["'']$', '', 'g') END AS title,
      CASE WHEN doc_id%3=0 THEN concat('manual://doc-', doc_id, '.md') ELSE url_key END AS url,
      CASE WHEN doc_id%3=0 THEN 'Manual Markdown' ELSE source_name END AS source_name,
      CASE WHEN doc_id%3=0 THEN timestamp '2024-02-01 00:00:00' ELSE date_trunc('day', published_at) END AS published_at,
      md5({s.strip('raw_content')}) AS digest, substr({s.collapse("regexp_replace(raw_content, '(?m)^#.+$', '', 'g')")}, 1, 280) AS excerpt, CASE WHEN doc_id%3=0 THEN '' ELSE 'a|b' END AS tags FROM h""",
)
def read_frontmatter_docs(spark, folder):
    it = items(spark, folder).withColumn("headline", tx.collapse(F.col("article_title")))
    head = F.concat(
        F.lit("---\ntitle: "), F.col("headline"), F.lit("\nsource_url: "), F.col("source_url"), F.lit("\nsource_name: "), F.col("source_name"),
        F.lit("\npublished_at: "), F.date_format("published_at", "yyyy-MM-dd"), F.lit("\ntags: [a, 'b']\n---\n"),
    )
    files = it.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_name"),
        F.concat(F.when(F.col("doc_id") % 3 != 0, head).otherwise(F.lit("")), F.col("raw_content")).alias("content"),
    )
    found = ex.frontmatter_docs(files, dt.ntz(NOW))
    return found.select("file_name", "title", "url", "source_name", "published_at", F.md5("raw_content").alias("digest"), "excerpt", F.array_join("tags", "|").alias("tags"))


# --- registry ---------------------------------------------------------------------------------------------------------
def registry(spark, folder):
    """A registry with one row per source name of the documents; some rows break a rule."""
    names = table(spark, folder, "documents").select("source").distinct()
    n = F.substring("source", 4, 10).cast("int")
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), n % len(values) + 1)
    return names.select(
        F.when(n % 7 == 3, F.concat(F.lit("Bad "), F.col("source"))).when(n == 5, F.lit("src4")).otherwise(F.col("source")).alias("id"),
        F.when(n == 9, F.lit("src8")).otherwise(F.col("source")).alias("name"),
        F.when(n % 4 != 2, F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/feed"))).alias("url"),
        pick(fv.SOURCE_GROUPS).alias("source_group"),
        F.when(n == 11, F.lit("blog")).otherwise(pick(fv.SOURCE_TYPES)).alias("source_type"),
        pick(fv.PRIORITIES).alias("priority"),
        (n * 13 % 120).alias("source_weight"),
        F.lit("daily").alias("suggested_frequency"),
        pick(list(fv.STRATEGY_ROUTES)).alias("collection_strategy"),
        F.when(n % 3 == 0, n * 100).cast("int").alias("max_items_per_window"),
        F.lit("x").alias("notes"),
    )


REGISTRY = f"""r0 AS (SELECT DISTINCT source, cast(substr(source,4) AS int) AS n FROM documents),
reg AS (SELECT n, CASE WHEN n%7=3 THEN concat('Bad ', source) WHEN n=5 THEN 'src4' ELSE source END AS id, CASE WHEN n=9 THEN 'src8' ELSE source END AS name,
  CASE WHEN n%4<>2 THEN concat('https://', source, '.example.com/feed') END AS url, CASE WHEN n=11 THEN 'blog' ELSE ({fv.SOURCE_TYPES!r})[n%5+1] END AS source_type,
  n*13%120 AS source_weight, ({list(fv.STRATEGY_ROUTES)!r})[n%8+1] AS collection_strategy, CASE WHEN n%3=0 THEN n*100 END AS max_items FROM r0)"""


@query(
    "validate_sources",
    f"""WITH {REGISTRY} SELECT id, 'bad id' AS problem FROM reg WHERE NOT regexp_matches(id, '^[a-z0-9-]+$')
    UNION ALL SELECT id, 'bad source_type' FROM reg WHERE source_type='blog'
    UNION ALL SELECT id, 'bad source_weight' FROM reg WHERE source_weight NOT BETWEEN 1 AND 100
    UNION ALL SELECT id, 'bad max_items_per_window' FROM reg WHERE max_items NOT BETWEEN 1 AND 1000
    UNION ALL SELECT id, 'duplicate source id' FROM reg GROUP BY id HAVING count(*)>1
    UNION ALL SELECT max(id), 'duplicate source name' FROM reg GROUP BY name HAVING count(*)>1""",
)
def validate_sources(spark, folder):
    return rg.violations(registry(spark, folder))


_ROUTES = "CASE collection_strategy " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fv.STRATEGY_ROUTES.items() if v) + " END"


@query("route_sources", f"WITH {REGISTRY} SELECT id, collection_strategy, {_ROUTES} AS route FROM reg")
def route_sources(spark, folder):
    return rg.routed(registry(spark, folder)).select("id", "collection_strategy", "route")


@query(
    "source_lookup",
    f"""WITH {s.ITEMS}, {REGISTRY} SELECT items.id, reg.id AS registry_id, coalesce(reg.source_weight, 50) AS registry_weight
    FROM items LEFT JOIN reg ON reg.name = items.source_name""",
)
def source_lookup(spark, folder):
    return rg.with_source(items(spark, folder), registry(spark, folder)).select("id", "registry_id", "registry_weight")


def _caps(spark, folder):
    names = table(spark, folder, "documents").select(F.col("source").alias("source_name")).distinct()
    n = F.substring("source_name", 4, 10).cast("int")
    return names.withColumn("source_cap", F.when(n % 3 != 0, n + 5))


@query(
    "cap_per_source",
    f"""WITH {s.ITEMS}, r AS (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY arrival) AS rn, cast(substr(source_name,4) AS int) AS n FROM items)
    SELECT id, source_name, cast(rn AS int) AS rank_in_source FROM r WHERE rn <= CASE WHEN n%3<>0 THEN n+5 ELSE 50 END""",
)
def cap_per_source(spark, folder):
    rows = items(spark, folder).join(_caps(spark, folder), "source_name")
    return rg.cap_per_source(rows, [F.col("arrival")]).select("id", "source_name", "rank_in_source")


@query(
    "cap_total",
    f"""WITH {s.ITEMS}, k AS (SELECT id, source_name FROM items ORDER BY arrival LIMIT 500),
    c AS (SELECT source_name, count(*) AS kept FROM k GROUP BY 1)
    SELECT t.source_name, t.fetched, coalesce(c.kept, 0) AS kept, t.fetched - coalesce(c.kept, 0) AS limited_out
    FROM (SELECT source_name, count(*) AS fetched FROM items GROUP BY 1) t LEFT JOIN c USING (source_name)""",
)
def cap_total(spark, folder):
    return rg.cap_total(items(spark, folder).select("id", "source_name", "arrival"), [F.col("arrival")], "id")[1]


@query("cap_total_rows", f"WITH {s.ITEMS} SELECT id, source_name FROM items ORDER BY arrival LIMIT 500")
def cap_total_rows(spark, folder):
    return rg.cap_total(items(spark, folder).select("id", "source_name", "arrival"), [F.col("arrival")], "id")[0].select("id", "source_name")
