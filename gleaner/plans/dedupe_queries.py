"""Queries over duplicate detection and ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import dates as dt
from gleaner.functions import text as tx
from gleaner.functions import urls as ul
from gleaner.operators import dedupe as dd
from gleaner.plans import sql as s
from gleaner.plans.registry import query
from gleaner.plans.testbed import items
from gleaner.session import cut_lineage, written

SPLIT = "2024-01-16 00:00:00"


def linked(spark, folder):
    """Items with a cheap duplicate relation: every tenth document repeats the URL of the one before."""
    return items(spark, folder).withColumn(
        "duplicate_of", F.when(F.col("doc_id") % 10 == 1, (F.col("doc_id") - 1).cast("string"))
    )


@query(
    "exact_match",
    f"""WITH {s.ITEMS}, k AS (SELECT id, collected_at, url_key, sha256({s.norm('raw_content')}) AS hash_key FROM items),
    hits AS (SELECT a.id, b.id AS match_id, row_number() OVER (PARTITION BY a.id ORDER BY b.collected_at DESC, b.id DESC) AS rn
      FROM k a JOIN k b ON a.collected_at >= timestamp '{SPLIT}' AND b.collected_at < timestamp '{SPLIT}' AND (a.url_key=b.url_key OR a.hash_key=b.hash_key))
    SELECT id, match_id FROM hits WHERE rn=1""",
)
def exact_match(spark, folder):
    it = items(spark, folder)
    keys = dd.ingest_keys(it).join(it.select("id", "collected_at"), "id")
    old = F.col("collected_at") < dt.ntz(SPLIT)
    return dd.exact_match(keys.filter(~old), keys.filter(old))


@query(
    "exact_dedupe",
    f"""WITH RECURSIVE {s.ITEMS}, k AS MATERIALIZED (SELECT id, dense_rank() OVER (ORDER BY url_key) AS url_key, dense_rank() OVER (ORDER BY sha256({s.norm('raw_content')})) AS hash_key,
      row_number() OVER (ORDER BY arrival) AS n FROM items),
    step AS (SELECT cast(0 AS bigint) AS n, cast([] AS bigint[]) AS urls, cast([] AS bigint[]) AS hashes, cast(NULL AS varchar) AS kept
      UNION ALL SELECT k.n, CASE WHEN seen THEN urls ELSE list_append(urls, url_key) END, CASE WHEN seen THEN hashes ELSE list_append(hashes, hash_key) END,
        CASE WHEN NOT seen THEN id END
      FROM (SELECT k.*, step.urls, step.hashes, list_contains(step.urls, k.url_key) OR list_contains(step.hashes, k.hash_key) AS seen FROM step JOIN k ON k.n = step.n + 1) k)
    SELECT kept AS id FROM step WHERE kept IS NOT NULL""",
)
def exact_dedupe(spark, folder):
    return dd.exact_dedupe(cut_lineage(dd.ingest_keys(items(spark, folder))))


@query(
    "best_dup_match",
    f"WITH {s.ITEMS}, {s.TOKS}, {s.best_match()} SELECT id, parent, round(score, 6) AS score, reason FROM best",
)
def best_dup_match(spark, folder):
    found = dd.best_matches(written(dd.dedupe_keys(items(spark, folder)), "zstd"))
    return found.filter("parent is not null").select("id", "parent", F.round("score", 6).alias("score"), "reason")


@query(
    "preferred_item",
    f"""WITH {s.ITEMS}, k AS (SELECT *, sha256({s.norm('raw_content')}) AS hash_key FROM items)
    SELECT hash_key, id AS preferred_id FROM (SELECT hash_key, id, row_number() OVER (PARTITION BY hash_key ORDER BY {s.PREFERENCE}) AS rn FROM k) WHERE rn=1""",
)
def preferred_item(spark, folder):
    return dd.preferred_per(items(spark, folder).withColumn("hash_key", tx.content_hash(F.col("raw_content"))), "hash_key")


@query("mark_duplicates", f"WITH RECURSIVE {s.MARKED} SELECT id, duplicate_of FROM marked")
def mark_duplicates(spark, folder):
    return dd.mark_duplicates(items(spark, folder)).select("id", "duplicate_of")


@query(
    "windowed_near_dup",
    f"""WITH RECURSIVE {s.ITEMS}, old AS (SELECT id FROM items WHERE collected_at < timestamp '{SPLIT}'),
    toks0 AS (SELECT * FROM items WHERE collected_at >= timestamp '{SPLIT}' - interval 72 hours),
    toks AS (SELECT id, arrival, id AS url_key, id AS hash_key, {s.tokens(s.norm_title('article_title'))} AS tset, {s.tokens('raw_content')} AS bset FROM toks0),
    {s.best_match('a.id NOT IN (SELECT id FROM old)')},
    root AS (SELECT id, id AS root FROM toks WHERE id NOT IN (SELECT id FROM best) UNION ALL SELECT b.id, r.root FROM best b JOIN root r ON b.parent=r.id),
    tagged AS (SELECT toks0.*, root.root, toks0.id IN (SELECT id FROM old) AS is_old, best.score FROM toks0 JOIN root ON root.id=toks0.id LEFT JOIN best ON best.id=toks0.id),
    contenders AS (SELECT * FROM tagged WHERE NOT is_old OR id=root),
    win AS (SELECT root, id AS winner FROM (SELECT root, id, row_number() OVER (PARTITION BY root ORDER BY CASE WHEN source_type='official' THEN 0 ELSE 1 END,
      published_at, source_weight DESC, collected_at, is_old DESC, arrival) AS rn FROM contenders) WHERE rn=1)
    SELECT id, CASE WHEN winner<>id THEN winner END AS duplicate_of, round(score, 6) AS duplicate_score, NOT is_old AS is_new
    FROM contenders JOIN win USING (root) WHERE NOT is_old OR (winner<>id)""",
)
def windowed_near_dup(spark, folder):
    it = items(spark, folder).withColumn("duplicate_of", F.lit(None).cast("string"))
    old = F.col("collected_at") < dt.ntz(SPLIT)
    found = dd.windowed_near_duplicates(it.filter(~old), it.filter(old), dt.shift_hours(dt.ntz(SPLIT), -72))
    return found.withColumn("duplicate_score", F.round("duplicate_score", 6))


def store_tables(spark, folder):
    """Raw, processed and source tables as the store would hold them; rows up to SPLIT are processed."""
    it = linked(spark, folder)
    raw = it.select(
        "id", "source_url", "raw_content", "published_at", "collected_at", "arrival", "duplicate_of", F.col("source_name").alias("source_id"),
        ul.canonical_url(F.col("source_url")).alias("canonical_url"), tx.content_hash(F.col("raw_content")).alias("content_hash"),
        F.col("article_title").alias("title"),
    )
    processed = it.filter(F.col("collected_at") < dt.ntz(SPLIT)).select(
        F.concat(F.lit("p"), "id").alias("id"), F.col("id").alias("raw_item_id"), "source_url", "raw_content", "published_at", "collected_at",
        F.concat(F.lit("T: "), "article_title").alias("article_title"), "source_type", "source_weight", F.concat(F.lit("p"), "duplicate_of").alias("duplicate_of"),
    )
    sources = it.select(
        F.col("source_name").alias("id"), F.concat(F.lit("Source "), "source_name").alias("name"), F.col("source_type").alias("type"), F.col("source_weight").alias("weight")
    ).distinct()
    return raw, processed, sources


AFTER = "2024-01-10 00:00:00"


@query(
    "recent_items",
    f"""WITH {s.LINKED} SELECT CASE WHEN done THEN concat('p', id) ELSE id END AS id, id AS raw_item_id, url_key AS canonical_url, sha256({s.norm('raw_content')}) AS content_hash,
      CASE WHEN done THEN concat('T: ', article_title) ELSE article_title END AS article_title, source_type, source_weight,
      CASE WHEN done THEN 'p' || duplicate_of ELSE duplicate_of END AS duplicate_of
    FROM (SELECT *, collected_at < timestamp '{SPLIT}' AS done FROM linked WHERE collected_at >= timestamp '{AFTER}')""",
)
def recent_items(spark, folder):
    raw, processed, sources = store_tables(spark, folder)
    return dd.recent_items(raw, processed, sources, dt.ntz(AFTER)).select(
        "id", "raw_item_id", "canonical_url", "content_hash", "article_title", "source_type", "source_weight", "duplicate_of"
    )


@query(
    "recent_newest",
    f"""WITH {s.LINKED}, r AS (SELECT CASE WHEN collected_at < timestamp '{SPLIT}' THEN concat('p', id) ELSE id END AS id, collected_at FROM linked WHERE collected_at >= timestamp '{AFTER}')
    SELECT id, collected_at FROM r ORDER BY collected_at DESC, id LIMIT 50""",
)
def recent_newest(spark, folder):
    return dd.recent_items(*store_tables(spark, folder), dt.ntz(AFTER), limit=50).select("id", "collected_at")


@query(
    "dup_groups",
    f"WITH {s.LINKED} SELECT id, duplicate_of, CASE WHEN duplicate_of IN (SELECT id FROM linked) THEN duplicate_of ELSE id END AS group_root FROM linked",
)
def dup_groups(spark, folder):
    return dd.duplicate_groups(linked(spark, folder)).select("id", "duplicate_of", "group_root")


@query(
    "distinct_source_links",
    f"""WITH {s.ITEMS} SELECT id, concat(source_name, '=', source_url, '|Official 2=https://official.example.com/p/', id, '?b=2&a=1') AS links,
      concat('https://official.example.com/p/', id, '?b=2&a=1|', source_url) AS preserved FROM items""",
)
def distinct_source_links(spark, folder):
    official = F.concat(F.lit("https://official.example.com/p/"), F.col("id"))
    it = items(spark, folder).withColumn(
        "official_sources",
        F.array(
            F.concat(F.regexp_replace("source_url", r"\?.*$", ""), F.lit("?utm_medium=x#end")), F.concat(official, F.lit("?b=2&a=1")),
            F.concat(official, F.lit("/?a=1&b=2#x")), F.lit("ftp://files.example.com/x"),
        ),
    )
    links = dd.distinct_links(dd.item_links(), ul.link_key)
    kept = dd.distinct_urls(F.concat(F.slice("official_sources", 2, 3), F.array("source_url")), ul.canonical_url)
    return it.select(
        "id", F.array_join(F.transform(links, lambda x: F.concat(x["label"], F.lit("="), x["url"])), "|").alias("links"), F.array_join(kept, "|").alias("preserved")
    )
