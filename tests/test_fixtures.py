"""Literal inputs with known results."""

import datetime as dtm
import json

import pytest
from pyspark.sql import functions as F

from gleaner.functions import dates as dt
from gleaner.functions import text as tx
from gleaner.functions import urls as ul
from gleaner.operators import articles as ar
from gleaner.operators import screening as sc
from gleaner.operators import selection as sl
from gleaner.operators import timeline as tl
from gleaner.sources import extract as ex
from gleaner.sources import registry as rg

NOW = "2026-05-19 08:00:00"


def values(spark, *columns):
    return list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def payload(spark, source, base, text):
    rows = spark.createDataFrame([(1, source, base, text)], "payload_id int, source_id string, base_url string, payload string")
    return rows.withColumn("collected_at", dt.ntz(NOW))


def test_urls(spark):
    got = values(
        spark,
        ul.canonical_url(F.lit("HTTPS://Example.com/Story/?utm_source=x&fbclid=1&b=2&a=1#frag")),
        ul.canonical_url(F.lit("https://example.com/Story")), ul.canonical_url(F.lit("https://example.com/story")),
        ul.canonical_url(F.lit("Not  a URL")), ul.collected_url(F.lit("manual://file.md")),
        ul.collected_url(F.lit("http://e.com:80/a/./b/../c/?q=a b&q=a+c")), ul.is_http_url(F.lit("javascript:alert(1)")),
        ul.resolved_url(F.lit("../x?b=1&a=2"), F.lit("https://e.com/p/q/r.html")),
    )
    assert got == [
        "https://example.com/Story?a=1&b=2", "https://example.com/Story", "https://example.com/story", "not a url", None,
        "http://e.com/a/c?q=a+b&q=a+c", False, "https://e.com/p/x?a=2&b=1",
    ]


def test_text(spark):
    got = values(
        spark,
        tx.normalize_title(F.lit("Exclusive: AI NPC tools launched for live ops")),
        tx.split_sentences(F.lit("第一条来了。第二条继续！Is this useful? 是的；收尾。")),
        tx.token_set(F.lit("游戏开发 an AI Agent, agent x")), tx.normalize_text(F.lit("　A \n b ")),
        tx.matches(F.lit("游戏ai大"), r"\bai\b"), tx.matches(F.lit("xaiy"), r"\bai\b"),
    )
    assert got == [
        "ai npc tools launched for live ops", ["第一条来了。", "第二条继续！", "Is this useful?", "是的；", "收尾。"],
        ["游戏", "戏开", "开发", "agent"], "a b", True, False,
    ]


def test_times(spark):
    now = dt.ntz(NOW)
    got = values(
        spark, dt.listing_time(F.lit("05月16日"), now), dt.listing_time(F.lit("10 分钟前"), now), dt.listing_time(F.lit("2026-05-19 13:56:39"), now),
        dt.feed_time(F.lit("Mon, 18 May 2026 10:00:00 GMT")), dt.iso_week_key(dt.ntz("2027-01-01")), dt.srt_time(F.lit(3723045)), dt.speech_ms(F.lit("你好 AI。"), 500, 100),
    )
    assert got == [
        dtm.datetime(2026, 5, 15, 16), dtm.datetime(2026, 5, 19, 7, 50), dtm.datetime(2026, 5, 19, 5, 56, 39), dtm.datetime(2026, 5, 18, 10),
        "2026-W53", "01:02:03,045", 1000,
    ]


def test_feed(spark):
    xml = (
        '<?xml version="1.0"?><rss><channel><item><title>Shader compiler learns to batch</title>'
        "<link>https://blog.example.org/shaders?utm_medium=feed&amp;b=2&amp;a=1#replies</link>"
        "<description><![CDATA[Compile times fall by a third.]]></description><pubDate>Mon, 18 May 2026 10:00:00 GMT</pubDate>"
        "<dc:creator>M. Osei</dc:creator></item></channel></rss>"
    )
    row = ex.feed_items(payload(spark, "rss", "https://example.com/feed", xml)).first()
    assert (row.title, row.url, row.author, row.published_at, row.raw_content) == (
        "Shader compiler learns to batch", "https://blog.example.org/shaders?a=1&b=2", "M. Osei", dtm.datetime(2026, 5, 18, 10), "Compile times fall by a third.",
    )


def test_listing_templates_and_fallback(spark):
    page = (
        '<div><a class="fn-clear" href="/article/77.html" target="_blank"><dl class="fn-left"><dd class="fn-clear"><span class="fn-left">'
        '<em>林一舟</em>05月16日</span><span class="fn-right">7条评论</span></dd><dt>独立团队上线新作</dt><dd>首周反响平稳。</dd></dl></a></div>'
    )
    templates = ex.listing_templates(spark)
    row = ex.templated_items(payload(spark, "chuapp", "https://www.chuapp.com/list/1.html", page), templates).first()
    assert (row.title, row.url, row.author, row.excerpt, row.published_at) == (
        "独立团队上线新作", "https://www.chuapp.com/article/77.html", "林一舟", "首周反响平稳。", dtm.datetime(2026, 5, 15, 16),
    )
    other = ex.templated_items(payload(spark, "chuapp", "https://www.chuapp.com/", '<a href="/a">Long title</a><a href="https://x.com/b">Other site</a>'), templates)
    assert [(r.title, r.url) for r in other.collect()] == [("Long title", "https://www.chuapp.com/a")]


def test_json_and_jsonp(spark):
    record = {"aid": 4071, "title": "工具链更新", "dis": "说明文字", "sendtime": 1779174089.775, "tags": [{"name": "引擎"}, "合作"]}
    row = ex.json_items(payload(spark, "json", "https://www.youxituoluo.com/", json.dumps({"data": {"data": [record]}}))).first()
    assert (row.title, row.url, row.excerpt, row.tags) == ("工具链更新", "https://www.youxituoluo.com/4071.html", "说明文字", ["引擎", "合作"])
    item = '<li><a class="tt" href="https://www.gamersky.com/n/9.shtml">地图编辑器</a><div class="txt">支持联机。</div><div class="time">2026-05-19 15:16</div></li>'
    row = ex.jsonp_items(payload(spark, "p", "https://www.gamersky.com/", "(" + json.dumps({"body": item}) + ");")).first()
    assert (row.title, row.excerpt, row.published_at) == ("地图编辑器", "支持联机。", dtm.datetime(2026, 5, 19, 7, 16))


def test_frontmatter_files(spark, tmp_path):
    (tmp_path / "submission.md").write_text(
        "---\nsource_url: https://press.example.org/note?utm_source=mail#top\nsource_name: Reader tip\npublished_at: 2026-05-18\ntags: tools, levels, test\n---\n"
        "# Level checks by script\n\nA reader describes scripted checks of level geometry.", encoding="utf8",
    )
    row = ex.frontmatter_docs(ex.read_text_files(spark, str(tmp_path)), dt.ntz(NOW)).first()
    assert (row.title, row.url, row.source_name, row.published_at, row.excerpt, row.tags) == (
        "Level checks by script", "https://press.example.org/note", "Reader tip", dtm.datetime(2026, 5, 18), "A reader describes scripted checks of level geometry.", ["tools", "levels", "test"],
    )


def test_responses(spark):
    good = {
        "newsValueScore": 80, "aiRelevanceScore": 90, "gameRelevanceScore": 70, "crossRelevanceScore": 75, "isTopicCandidate": True,
        "exclusionReasons": [], "aiTags": ["tooling"], "gameTags": [],
    }
    text = json.dumps(good)
    rows = [
        ("plain", text), ("fenced", f"```json\n{text}\n```"), ("prose", f"Here:\n{text}\nNote {{ignored}}"), ("wrapped", f"[{text}]"),
        ("second", f'["no"]\n{text}'), ("broken", "{not json"), ("range", text.replace("80", "101")),
    ]
    got = {r["id"]: (r["value"]["crossRelevanceScore"] if r["value"] else None, r["error"]) for r in ar.validate_responses(spark.createDataFrame(rows, "id string, raw string")).collect()}
    assert got == {
        "plain": (75, None), "fenced": (75, None), "prose": (75, None), "wrapped": (75, None), "second": (75, None),
        "broken": (None, "no_json"), "range": (None, "schema"),
    }


def scored_item(spark, **changes):
    base = {
        "id": "x", "arrival": 1, "source_url": "https://example.com/x", "source_name": "Harbor Weekly", "source_type": "ai_game_media", "source_weight": 80,
        "published_at": dtm.datetime(2026, 5, 19), "collected_at": dtm.datetime(2026, 5, 19), "duplicate_of": None, "is_topic_candidate": True, "exclusion_reason": "",
        "raw_content": "Harbor Weekly describes how a small game crew drafts quest dialogue for each NPC with an AI helper.\nMore lines here.",
        "summary": "A small crew drafts quest dialogue with an AI helper.", "intro_summary": "", "article_title": "AI helper drafts quest dialogue",
        "article_body": "Harbor Weekly describes a crew that drafts quest dialogue for each NPC.", "category": "AI x Game", "score": 90,
        "official_sources": [], "keywords": [], "ai_tags": [], "game_tags": [], "edition": dtm.date(2026, 5, 19),
    }
    return {**base, **changes}


ITEM_SCHEMA = (
    "id string, arrival int, source_url string, source_name string, source_type string, source_weight int, published_at timestamp_ntz, collected_at timestamp_ntz, "
    "duplicate_of string, is_topic_candidate boolean, exclusion_reason string, raw_content string, summary string, intro_summary string, article_title string, "
    "article_body string, category string, score int, official_sources array<string>, keywords array<string>, ai_tags array<string>, game_tags array<string>, edition date"
)


def run_selection(spark, rows, **rules):
    names = [c.split(" ")[0] for c in ITEM_SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple({**r, "arrival": i}[n] for n in names) for i, r in enumerate(rows)], ITEM_SCHEMA)
    selected, audit = sl.select_and_audit(df, dt.ntz("2026-05-19 12:00:00"), sl.Rules(**rules))
    return [r for r in selected.orderBy("rank").collect()], {(r["bucket"], r["id"]) for r in audit.collect()}


def test_selection_balances_and_fills(spark):
    rows = [
        scored_item(spark, id="ai-best", score=92), scored_item(spark, id="ai-next", score=88), scored_item(spark, id="low-trust", score=70, source_weight=20),
        scored_item(spark, id="old-engine", category="Engine", score=96, published_at=dtm.datetime(2026, 5, 10)),
    ]
    chosen, audit = run_selection(spark, rows, count=3, quotas=(("AI x Game", 1), ("Engine", 2)))
    assert [r["id"] for r in chosen] == ["ai-best", "ai-next"]
    assert {i for b, i in audit if b == "failed_verification"} == {"low-trust", "old-engine"}


def test_selection_keeps_official_links_and_falls_back(spark):
    rows = [
        scored_item(spark, id="canonical", source_url="https://media.example.com/story", score=82),
        scored_item(spark, id="dup", source_type="official", source_url="https://studio.example.com/news", duplicate_of="canonical", official_sources=["https://studio.example.com/press"]),
        scored_item(spark, id="strange", article_title="Quantum metaverse acquisition", article_body="Satellite robotics infrastructure acquired.", score=80),
    ]
    chosen, audit = run_selection(spark, rows, count=2)
    first, second = chosen
    assert first["source_url"] == "https://studio.example.com/news"
    assert first["official_sources"] == ["https://studio.example.com/news", "https://studio.example.com/press"]
    assert second["id"] == "strange" and "drafts quest dialogue" in second["article_body"]
    assert ("duplicate", "dup") in audit


def test_quota_text():
    assert sl.parse_quotas("AI x Game=3, bad, Engine=2, Empty=0") == [("AI x Game", 3), ("Engine", 2)]


def test_scores_of_known_texts(spark):
    rich = "\n".join([
        "青岚工作室发布通用游戏AI智能体 Driftwood，读取游戏画面与语音指令后生成手柄操作，单张家用显卡上可达到30Hz的实时响应。",
        "团队收集了25款游戏共6100小时的录像用于训练，无需微调即可在Steam与主机游戏中运行，面向游戏开发的代码和数据集已经开源。",
        "模型由Transformer编码器和动作解码器组成，参数规模从200M到2B，最大版本推理约35Hz，任务完成率由35%提高到72%。",
    ])
    rows = spark.createDataFrame(
        [("rich", "", rich, 90, "https://e.com/1"), ("sparse", "", "A game studio released AI-assisted NPC tools for live operations.", 90, "https://e.com/2")],
        "id string, article_title string, raw_content string, source_weight int, source_url string",
    )
    got = {r["id"]: r for r in sc.enrich_items(rows).collect()}
    assert got["rich"]["is_topic_candidate"] and got["rich"]["cross_relevance_score"] >= 60 and "AI" in got["rich"]["keywords"]
    assert not got["sparse"]["is_topic_candidate"] and "low-information item" in got["sparse"]["exclusion_reason"]
    assert values(spark, sc.source_weight_adjust(F.lit(55), F.lit(90))) == [65]


def test_one_failing_row_does_not_stop_the_others(spark):
    base = sc.dictionary_scorer()

    def scorer(df):
        return base(df).withColumn("score_error", F.when(F.col("id") == "broken", F.lit("synthetic failure")))

    rows = spark.createDataFrame(
        [(i, "t", "A studio shipped AI NPC tooling for game live operations.", 80, "https://e.com/" + i, None) for i in ("broken", "ok")],
        "id string, title string, raw_content string, source_weight int, source_url string, duplicate_of string",
    )
    audit = {r["raw_item_id"]: (r["status"], r["message"]) for r in sc.screening_audit(sc.screen_items(rows, scorer)).collect()}
    assert audit["broken"] == ("error", "synthetic failure") and audit["ok"][0] == "excluded"


def test_subtitles(spark):
    rows = spark.createDataFrame([("s", 1, 0, 1500, "字幕文本。")], "script string, segment_no int, start_ms bigint, end_ms bigint, text string")
    assert tl.srt_text(rows, "script").first()["srt"] == "1\n00:00:00,000 --> 00:00:01,500\n字幕文本。\n"


def test_payloads_go_to_the_extractor_of_their_source(spark):
    sources = spark.createDataFrame(
        [("feed", "rss"), ("page", "official_site"), ("social", "x_social"), ("hand", "manual_markdown"), ("api", "json_api")], "id string, collection_strategy string"
    )
    feed = "<rss><item><title>Good item</title><link>https://example.com/good</link></item></rss>"
    rows = payload(spark, "feed", "https://example.com/", feed)
    for source, text in (
        ("page", '<a href="/story">A long story</a>'), ("social", "x"), ("hand", "---\ntitle: Sent in\nsource_url: https://e.com/m\n---\nBody"), ("api", None), ("feed", "no items here"), ("hand", None),
    ):
        rows = rows.unionByName(payload(spark, source, "https://example.com/list", text))
    rows = rows.withColumn("payload_id", F.concat_ws("-", "source_id", F.xxhash64("payload").cast("string")))
    found, failures = ex.extract_by_route(rows, sources, ex.listing_templates(spark))
    assert {(r.source_id, r.title, r.url) for r in found.collect()} == {
        ("feed", "Good item", "https://example.com/good"), ("page", "A long story", "https://example.com/story"), ("hand", "Sent in", "https://e.com/m"),
    }
    assert sorted((r.source_id, r.error) for r in failures.collect()) == [
        ("api", "empty payload"), ("feed", "no new item found"), ("hand", "empty payload"), ("social", "no extractor for this source"),
    ]


def test_null_and_unreadable_answers_become_error_rows(spark):
    rows = spark.createDataFrame([("a", None), ("b", "{}"), ("c", "[" * 30_000), ("d", "{" * 30_000)], "id string, raw string")
    got = {r["id"]: r["error"] for r in ar.validate_responses(rows).collect()}
    assert got == {"a": "no_json", "b": "schema", "c": "no_json", "d": "no_json"}


def test_a_cap_above_the_largest_fails(spark):
    rows = spark.createDataFrame([("s", 1, 2000)], "source_name string, arrival int, source_cap int")
    with pytest.raises(Exception, match="above the largest"):
        rg.cap_per_source(rows, [F.col("arrival")]).collect()
    assert rg.cap_per_source(rows, [F.col("arrival")], most=5000).count() == 1
