"""Queries over scoring, screening, articles, selection and store lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import dates as dt
from gleaner.functions import text as tx
from gleaner.operators import articles as ar
from gleaner.operators import collection as cl
from gleaner.operators import dedupe as dd
from gleaner.operators import screening as sc
from gleaner.operators import selection as sl
from gleaner.operators import store as st
from gleaner.plans import sql as s
from gleaner.plans.dedupe_queries import SPLIT, linked, store_tables
from gleaner.plans.registry import query
from gleaner.plans.source_queries import _caps
from gleaner.plans.testbed import items, table
from gleaner.session import cut_lineage, written

# The reference-domain words do not occur in the corpus; these patterns do, and have the same kinds: bounded words,
# substrings and alternations.
SIGNALS = sc.Signals(
    ai=[("AI", r"\bai\b"), ("AIGC", r"\bder\b"), ("LLM", "leaux"), ("Agent", r"\bthem?\b"), ("人工智能", r"\bpor\b")],
    game=[("game", r"\band\b"), ("gaming", r"\bque\b"), ("studio", r"\bund\b"), ("engine", r"\bto\b"), ("Steam", "oir")],
    cross=[("AI x 游戏", r"the\s+and|of the"), ("游戏开发", "ment"), ("AI生成", "tion")],
    value=[("发布", "ble|ther"), ("融资", "license|ung"), ("announce", r"\bthan|thed|was\b")],
    tutorial=r"\b(nicht|license|thre thed)\b",
    gossip=r"\b(token|thth the|pour la)\b",
    repost="thnthes",
    screen_tutorial=r"\b(nicht|license|thble)\b",
    screen_gossip=r"\b(token|thth the|erin)\b",
    screen_repost=r"\b(thnthes|thes is|icymi)\b",
    prefilter=[
        ("ai", 14, [r"(?:^|[^a-z])the(?:[^a-z]|$)", "leaux|eux"]),
        ("game", 5, ["and|que|und|to|en"]),
        ("industry", 8, ["ment|tion", "ung|ble"]),
        ("negative", -12, ["ther|ich", "oir"]),
    ],
)


def raw_items(spark, folder):
    return linked(spark, folder).withColumn("title", F.col("article_title"))


def joined(c):
    return F.array_join(c, "|")


# --- scoring ----------------------------------------------------------------------------------------------------------
_PRE = "lower(concat(article_title, ' ', raw_content))"
_HOLDS = {name: "(" + " OR ".join(f"regexp_matches({_PRE}, {s.q(p)})" for p in patterns) + ")" for name, _, patterns in SIGNALS.prefilter}
_PRE_SCORE = " + ".join(f"CASE WHEN {_HOLDS[n]} THEN {pts} ELSE 0 END" for n, pts, _ in SIGNALS.prefilter) + f" + CASE WHEN NOT {_HOLDS['game']} THEN -15 ELSE 0 END"
_PRE_LIST = ", ".join(f"CASE WHEN {_HOLDS[n]} THEN '{n}' END" for n, _, _ in SIGNALS.prefilter) + f", CASE WHEN NOT {_HOLDS['game']} THEN 'off-topic-risk' END"


def _prefilter_input(spark, folder):
    return items(spark, folder).select(
        "id", "arrival", "published_at", F.col("source_name").alias("source_id"), F.col("article_title").alias("title"),
        F.col("raw_content").alias("excerpt"),
    )


@query(
    "prefilter_score",
    f"WITH {s.ITEMS} SELECT id, cast({_PRE_SCORE} AS int) AS prefilter_score, array_to_string(list_filter([{_PRE_LIST}], lambda x: x IS NOT NULL), '|') AS signals FROM items",
)
def prefilter_score(spark, folder):
    return sc.prefilter_score(_prefilter_input(spark, folder), SIGNALS).select("id", "prefilter_score", joined("prefilter_signals").alias("signals"))


@query(
    "prefilter_apply",
    f"""WITH {s.ITEMS}, p AS (SELECT *, source_name IN ('src3','src7','src11') AS flagged, {_PRE_SCORE} AS score FROM items),
    r AS (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY CASE WHEN flagged THEN -score ELSE 0 END,
      CASE WHEN flagged THEN -epoch_us(published_at) ELSE 0 END, arrival) AS rn FROM p WHERE NOT flagged OR score >= 8)
    SELECT id, source_name AS source_id, cast(rn AS int) AS rank_in_source FROM r WHERE rn <= 20""",
)
def prefilter_apply(spark, folder):
    kept = sc.prefilter_apply(_prefilter_input(spark, folder), 20, SIGNALS, low_trust=["src3", "src7", "src11"])
    return kept.select("id", "source_id", "rank_in_source")


LOW_TRUST, TOTAL = ["src3", "src7", "src11"], 300
_COLLECTED = f"""WITH {s.ITEMS}, f AS (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY arrival) AS pos, cast(substr(source_name,4) AS int) AS n FROM items),
    capped AS (SELECT *, source_name IN ('src3','src7','src11') AS flagged FROM f WHERE pos <= CASE WHEN n%3<>0 THEN n+5 ELSE 50 END),
    p AS (SELECT *, CASE WHEN flagged THEN cast({_PRE_SCORE} AS int) END AS prefilter_score,
      CASE WHEN flagged THEN array_to_string(list_filter([{_PRE_LIST}], lambda x: x IS NOT NULL), '|') END AS signals FROM capped),
    r AS (SELECT *, cast(row_number() OVER (PARTITION BY source_name ORDER BY CASE WHEN flagged THEN -prefilter_score END, CASE WHEN flagged THEN -epoch_us(published_at) END, pos) AS int) AS rank_in_source
      FROM p WHERE NOT flagged OR prefilter_score >= 8),
    k AS (SELECT * FROM r ORDER BY source_name, rank_in_source LIMIT {TOTAL})"""


def collected(spark, folder):
    feed = _prefilter_input(spark, folder).withColumn("source_name", F.col("source_id"))
    return cl.collect(feed.join(_caps(spark, folder), "source_name"), [F.col("arrival")], SIGNALS, LOW_TRUST, total=TOTAL)


@query("collect_items", f"{_COLLECTED} SELECT id, source_name, rank_in_source, prefilter_score, signals FROM k")
def collect_items(spark, folder):
    return collected(spark, folder)[0].select("id", "source_name", "rank_in_source", "prefilter_score", joined("prefilter_signals").alias("signals"))


@query(
    "collect_counts",
    f"""{_COLLECTED} SELECT source_name, count(*) AS fetched, count(*) - (SELECT count(*) FROM capped c WHERE c.source_name=f.source_name) AS over_cap,
      (SELECT count(*) FROM capped c WHERE c.source_name=f.source_name) - (SELECT count(*) FROM r WHERE r.source_name=f.source_name) AS filtered,
      (SELECT count(*) FROM r WHERE r.source_name=f.source_name) - (SELECT count(*) FROM k WHERE k.source_name=f.source_name) AS limited_out,
      (SELECT count(*) FROM k WHERE k.source_name=f.source_name) AS collected FROM f GROUP BY source_name""",
)
def collect_counts(spark, folder):
    return collected(spark, folder)[1]


_SCORED = f"WITH {s.LINKED}, {s.scored('linked', 'scored', SIGNALS)}"


@query("relevance_scores", f"{_SCORED} SELECT id, ai_relevance_score, game_relevance_score, cross_relevance_score FROM scored")
def relevance_scores(spark, folder):
    return sc.relevance_scores(items(spark, folder), SIGNALS).select("id", "ai_relevance_score", "game_relevance_score", "cross_relevance_score")


@query("news_value", f"{_SCORED} SELECT id, news_value_score FROM scored")
def news_value(spark, folder):
    return sc.classify(items(spark, folder), signals=SIGNALS).select("id", "news_value_score")


@query("rule_exclusion", f"{_SCORED} SELECT id, array_to_string(provider_reasons, '|') AS reasons, provider_candidate FROM scored")
def rule_exclusion(spark, folder):
    return sc.classify(items(spark, folder), signals=SIGNALS).select("id", joined("provider_reasons").alias("reasons"), "provider_candidate")


@query("keyword_labels", f"{_SCORED} SELECT id, array_to_string(keywords, '|') AS keywords FROM scored")
def keyword_labels(spark, folder):
    scored = sc.relevance_scores(items(spark, folder), SIGNALS)
    return scored.select("id", joined(sc.keyword_labels()).alias("keywords"))


@query("categorize", f"{_SCORED} SELECT id, category, array_to_string(ai_tags, '|') AS ai_tags, array_to_string(game_tags, '|') AS game_tags FROM scored")
def categorize(spark, folder):
    scored = sc.classify(items(spark, folder), signals=SIGNALS).withColumn("category", sc.category())
    return scored.select("id", "category", joined("ai_tags").alias("ai_tags"), joined("game_tags").alias("game_tags"))


@query("summary_fields", f"{_SCORED} SELECT id, article_title, summary, intro_summary, article_body FROM scored")
def summary_fields(spark, folder):
    return sc.dictionary_scorer(signals=SIGNALS)(items(spark, folder)).select("id", "article_title", "summary", "intro_summary", "article_body")


@query("source_weight_adjust", f"{_SCORED} SELECT id, {s.weighted('cross_relevance_score')} AS cross_score, {s.weighted('news_value_score')} AS value_score FROM scored")
def source_weight_adjust(spark, folder):
    scored = sc.classify(items(spark, folder), signals=SIGNALS)
    return scored.select(
        "id", sc.source_weight_adjust(F.col("cross_relevance_score"), F.col("source_weight")).alias("cross_score"),
        sc.source_weight_adjust(F.col("news_value_score"), F.col("source_weight")).alias("value_score"),
    )


# the screener sees the provider's reasons after normalisation; the scorer's own reasons map to themselves, except
# that "low-information item" matches no rule and stays
_SCREENED = f"""{_SCORED}, txt AS (SELECT *, lower(concat(linked_title, ' ', raw_content)) AS _st,
    {s.weighted('cross_relevance_score')} AS wc, {s.weighted('news_value_score')} AS wv FROM (SELECT scored.*, linked.article_title AS linked_title FROM scored JOIN linked USING (id))),
  why AS (SELECT *, {s.distinct_in_order(f"list_concat(provider_reasons, list_filter([CASE WHEN duplicate_of IS NOT NULL THEN 'duplicate' END, CASE WHEN ai_relevance_score<50 THEN {s.q(fv.REASON_NON_AI)} END, CASE WHEN game_relevance_score<50 THEN {s.q(fv.REASON_NO_GAME)} END, CASE WHEN ai_relevance_score<50 AND game_relevance_score<50 THEN {s.q(fv.REASON_UNRELATED)} END, CASE WHEN regexp_matches(_st, {s.q(SIGNALS.screen_tutorial)}) AND news_value_score<70 THEN {s.q(fv.REASON_TUTORIAL)} END, CASE WHEN regexp_matches(_st, {s.q(SIGNALS.screen_gossip)}) THEN {s.q(fv.REASON_GOSSIP)} END, CASE WHEN regexp_matches(_st, {s.q(SIGNALS.screen_repost)}) OR length({s.strip('raw_content')})<50 THEN {s.q(fv.REASON_REPOST)} END, CASE WHEN wc<60 THEN {s.q(fv.REASON_CROSS_BELOW)} END, CASE WHEN wv<55 THEN {s.q(fv.REASON_VALUE_BELOW)} END], lambda x: x IS NOT NULL))")} AS reasons FROM txt),
  screened AS (SELECT *, len(reasons)=0 AS is_topic_candidate, cast({s.half_up('wc*0.6e0 + wv*0.4e0')} AS int) AS score,
    CASE WHEN len(reasons)=0 THEN 'processed' ELSE 'excluded' END AS status FROM why)"""


def screened(spark, folder):
    return sc.screen_items(raw_items(spark, folder), signals=SIGNALS)


@query("exclusion_reasons", f"{_SCREENED} SELECT id, array_to_string(reasons, '|') AS reasons FROM screened")
def exclusion_reasons(spark, folder):
    return screened(spark, folder).select("id", joined("exclusion_reasons").alias("reasons"))


@query(
    "screen_items",
    f"{_SCREENED} SELECT id, score, is_topic_candidate, is_topic_candidate AND duplicate_of IS NULL AS selected, category, news_value_score, status FROM screened",
)
def screen_items(spark, folder):
    return screened(spark, folder).select("id", "score", "is_topic_candidate", "selected", "category", "news_value_score", "status")


@query("screen_totals", f"{_SCREENED} SELECT status, count(*) AS n FROM screened GROUP BY status")
def screen_totals(spark, folder):
    return screened(spark, folder).groupBy("status").agg(F.count("*").alias("n"))


@query(
    "processing_audit",
    f"""{_SCREENED} SELECT id AS raw_item_id, id AS processed_item_id, 'screening' AS stage, status,
    CASE WHEN status='processed' THEN 'Item passed automated screening.' ELSE array_to_string(reasons, '; ') END AS message,
    wv AS effective_news_value_score, wc AS effective_cross_relevance_score FROM screened""",
)
def processing_audit(spark, folder):
    return sc.screening_audit(screened(spark, folder)).select(
        "raw_item_id", "processed_item_id", "stage", "status", "message", "effective_news_value_score", "effective_cross_relevance_score"
    )


@query(
    "audit_log_scan",
    f"""{_SCREENED}, log AS (SELECT id AS raw_item_id, status, collected_at AS created_at FROM screened)
    SELECT raw_item_id, status, created_at FROM log WHERE raw_item_id = (SELECT max(raw_item_id) FROM log)""",
)
def audit_log_scan(spark, folder):
    log = screened(spark, folder).select(F.col("id").alias("raw_item_id"), "status", F.col("collected_at").alias("created_at"))
    wanted = items(spark, folder).agg(F.max("id")).scalar()
    return st.audit_log_scan(log, wanted)


@query(
    "label_agreement",
    f"""{_SCREENED} SELECT quality, is_topic_candidate, count(*) AS n FROM screened LEFT JOIN labels ON labels.doc_id = screened.doc_id GROUP BY ALL""",
)
def label_agreement(spark, folder):
    verdict = screened(spark, folder).select("doc_id", "is_topic_candidate")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return verdict.join(labels, "doc_id", "left").groupBy("quality", "is_topic_candidate").agg(F.count("*").alias("n"))


_ENRICHED = f"""{_SCORED}, enriched AS (SELECT *, cross_relevance_score AS score, provider_candidate AS is_topic_candidate,
    array_to_string(provider_reasons, '; ') AS exclusion_reason, cast(date_trunc('day', published_at) AS date) + 1 AS edition FROM scored)"""


def enriched(spark, folder, base=None):
    rows = sc.enrich_items(linked(spark, folder) if base is None else base, signals=SIGNALS)
    return rows.withColumn("edition", F.date_add(F.to_date("published_at"), 1))


def ranked(spark, folder):
    """Items with the columns of :func:`enriched` that groups and links depend on. A generator gives all its columns or none, so
    news value, flags and texts would be worked out for every item and dropped."""
    rows = sc.relevance_scores(linked(spark, folder), SIGNALS)
    return rows.withColumns(
        {"score": F.col("cross_relevance_score"), "official_sources": F.array("source_url"), "edition": F.date_add(F.to_date("published_at"), 1)}
    )


@query(
    "enrich_items",
    f"""{_ENRICHED} SELECT id, edition, category, score, is_topic_candidate, is_topic_candidate AND duplicate_of IS NULL AS selected, exclusion_reason,
    concat(article_title, '. ', intro_summary) AS script FROM enriched""",
)
def enrich_items(spark, folder):
    return enriched(spark, folder).select(
        "id", "edition", "category", "score", "is_topic_candidate", "selected", "exclusion_reason", F.get("script_segments", F.lit(0)).alias("script")
    )


@query(
    "enrich_failures",
    f"""{_ENRICHED} SELECT id, CASE WHEN bad THEN 'Excluded' ELSE category END AS category, CASE WHEN bad THEN 0 ELSE score END AS score, NOT bad AND is_topic_candidate AS is_topic_candidate,
    CASE WHEN bad THEN concat('ai enrichment failed: no answer for ', id) ELSE exclusion_reason END AS exclusion_reason FROM (SELECT *, doc_id % 7 = 3 AS bad FROM enriched)""",
)
def enrich_failures(spark, folder):
    """A scorer of one's own, which has no answer for some items: they stay, excluded, and the others are scored."""

    def scorer(rows):
        failed = F.when(F.col("doc_id") % 7 == 3, F.concat(F.lit("no answer for "), F.col("id")))
        return sc.dictionary_scorer(signals=SIGNALS)(rows).withColumn("score_error", failed)

    return sc.enrich_items(linked(spark, folder), scorer).select("id", "category", "score", "is_topic_candidate", "exclusion_reason")


@query(
    "quota_rules",
    """WITH t AS (SELECT doc_id, concat('AI x Game=', doc_id % 4, ', ', source, ' = ', n_chars, ',none, =3, ', source, '=x,', lang, '=0', doc_id % 3, 'b') AS rules FROM documents),
    c AS (SELECT doc_id, i, trim(split_part(x, '=', 1)) AS name, try_cast(regexp_extract(trim(split_part(x, '=', 2)), '^[0-9]+') AS BIGINT) AS quota
      FROM (SELECT doc_id, unnest(string_split(rules, ',')) AS x, unnest(range(len(string_split(rules, ',')))) AS i FROM t) WHERE contains(x, '='))
    SELECT doc_id, name, arg_max(quota, i) AS quota, cast(row_number() OVER (PARTITION BY doc_id ORDER BY min(i)) - 1 AS INTEGER) AS place FROM c WHERE name <> '' AND quota > 0 GROUP BY doc_id, name""",
)
def quota_rules(spark, folder):
    docs = table(spark, folder, "documents")
    text = F.concat(
        F.lit("AI x Game="), F.col("doc_id") % 4, F.lit(", "), "source", F.lit(" = "), "n_chars", F.lit(",none, =3, "), "source", F.lit("=x,"), "lang", F.lit("=0"), F.col("doc_id") % 3, F.lit("b")
    )
    return sl.quota_rows(docs.select("doc_id", text.alias("rules")), "doc_id", "rules")


@query(
    "claim_trace",
    f"""WITH c AS (SELECT doc_id, {s.claim_tokens('b.text', fv.SELECTION_STOP_WORDS)} AS claim, list_distinct({s.evidence_tokens('d.text', fv.SELECTION_STOP_WORDS)}) AS ev
      FROM documents d JOIN benchmark b ON d.doc_id % (SELECT count(*) FROM benchmark) = b.item_id),
    r AS (SELECT doc_id, len(list_filter(claim, lambda t: list_contains(ev, t)))::double / nullif(len(claim), 0) AS share FROM c)
    SELECT doc_id, round(share, 9) AS share, coalesce(share >= 0.5, false) AS traced FROM r""",
)
def claim_trace(spark, folder):
    claims = table(spark, folder, "benchmark").select("item_id", F.col("text").alias("claim"))
    n = claims.agg(F.count("*")).scalar()
    rows = table(spark, folder, "documents").select("doc_id", "text", (F.col("doc_id") % n).alias("item_id")).join(claims, "item_id")
    share = sl.traced_share(
        tx.claim_tokens(F.col("claim"), fv.SELECTION_STOP_WORDS), tx.without(tx.stem_tokens(F.col("text")), fv.SELECTION_STOP_WORDS)
    )
    return rows.select("doc_id", F.round(share, 9).alias("share")).withColumn("traced", F.coalesce(F.col("share") >= 0.5, F.lit(False)))


@query(
    "validate_responses",
    """WITH r AS (SELECT doc_id, cast((doc_id*7)%110 AS int) AS v, doc_id%8 AS form FROM documents)
    SELECT doc_id AS id, CASE WHEN doc_id%9=4 OR form IN (5,7) OR v>100 THEN NULL ELSE v END AS value_score,
      CASE WHEN doc_id%9=4 OR form IN (5,7) OR v>100 THEN NULL ELSE v%2=0 END AS candidate,
      CASE WHEN doc_id%9=4 OR form=5 THEN 'no_json' WHEN form=7 OR v>100 THEN 'schema' END AS error FROM r""",
)
def validate_responses(spark, folder):
    v = (F.col("doc_id") * 7 % 110).cast("int")
    none = F.array().cast("array<string>")
    body = F.to_json(
        F.struct(
            v.alias("newsValueScore"), F.lit(50).alias("aiRelevanceScore"), F.lit(60).alias("gameRelevanceScore"), F.lit(70).alias("crossRelevanceScore"),
            (v % 2 == 0).alias("isTopicCandidate"), none.alias("exclusionReasons"), F.array("source").alias("aiTags"),
            F.array("text").alias("gameTags"),
        )
    )
    form = F.col("doc_id") % 8
    raw = (
        F.when(F.col("doc_id") % 9 == 4, F.lit(None))
        .when(form == 0, body)
        .when(form == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(form == 2, F.concat(F.lit("Here it is:\n"), body, F.lit("\nNote {ignored}")))
        .when(form == 3, F.concat(F.lit("["), body, F.lit("]")))
        .when(form == 4, F.concat(F.lit('["no", "schema"]\n'), body))
        .when(form == 5, F.concat(F.lit("{broken"), F.substring(body, 2, 20)))
        .when(form == 6, F.concat(F.lit("  "), body, F.lit(" ")))
        .otherwise(F.lit('{"newsValueScore": 5}'))
    )
    answers = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), raw.alias("raw"))
    return ar.validate_responses(answers).select(
        "id", F.col("value.newsValueScore").alias("value_score"), F.col("value.isTopicCandidate").alias("candidate"), "error"
    )


# --- selection ------------------------------------------------------------------------------------------------------------
RULES = sl.Rules(count=5, quotas=(("AI x Game", 2), ("Game Industry", 1)), freshness_hours=20)


def generated():
    return F.col("edition").cast("timestamp_ntz")


_GEN = "cast(edition AS timestamp)"
_RANK = f"score DESC, source_weight DESC, abs(epoch_us({_GEN})-epoch_us(published_at)), arrival"
_EV = (
    "concat_ws(' ', raw_content, summary, intro_summary, source_name, category, source_url, array_to_string(official_sources,' '), "
    "array_to_string(keywords,' '), array_to_string(ai_tags,' '), array_to_string(game_tags,' '))"
)


def _verify_sql(src: str, name: str) -> str:
    claim = s.claim_tokens("concat(article_title, ' ', article_body)", fv.SELECTION_STOP_WORDS)
    han = "regexp_extract_all(concat(article_title, ' ', article_body), '[\\x{4e00}-\\x{9fff}]+')"
    pairs = f"flatten(list_transform({han}, lambda r: CASE WHEN length(r)=1 THEN [r] ELSE list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) END))"
    ev_han = f"regexp_extract_all({_EV}, '[\\x{{4e00}}-\\x{{9fff}}]+')"
    ev_pairs = f"flatten(list_transform({ev_han}, lambda r: CASE WHEN length(r)=1 THEN [r] ELSE list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) END))"
    return f"""{name}_a AS (SELECT *, list_concat({pairs}, {claim}) AS _claim, list_distinct(list_concat({ev_pairs}, {s.evidence_tokens(_EV, fv.SELECTION_STOP_WORDS)})) AS _ev FROM {src}),
{name}_b AS (SELECT *, coalesce(len(list_filter(_claim, lambda t: list_contains(_ev, t)))::double / nullif(len(_claim),0) >= 0.5, false) AS _traced,
   (epoch_us({_GEN})-epoch_us(published_at))/3600000000e0 AS _age FROM {name}_a),
{name} AS (SELECT *, list_filter([
   CASE WHEN NOT regexp_matches(source_url, '^https?://') AND collected_at IS NULL THEN {s.q(fv.VERIFY_BAD_URL)} END,
   CASE WHEN {s.strip('article_title')}='' THEN {s.q(fv.VERIFY_NO_TITLE)} END,
   CASE WHEN {s.strip('article_body')}='' THEN {s.q(fv.VERIFY_NO_BODY)} END,
   CASE WHEN NOT (_age >= -6 AND _age <= {RULES.freshness_hours}) THEN {s.q(fv.VERIFY_BAD_DATE)} END,
   CASE WHEN source_weight<40 AND score<85 THEN {s.q(fv.VERIFY_LOW_TRUST)} END,
   CASE WHEN duplicate_of IS NOT NULL THEN {s.q(fv.VERIFY_DUPLICATE)} END,
   CASE WHEN NOT _traced THEN {s.q(fv.VERIFY_NO_TRACE)} END], lambda x: x IS NOT NULL) AS reasons FROM {name}_b)"""


@query("verify_items", f"{_ENRICHED}, {_verify_sql('enriched', 'verified')} SELECT id, array_to_string(reasons, '|') AS reasons FROM verified")
def verify_items(spark, folder):
    return sl.with_verification(enriched(spark, folder), generated(), RULES).select("id", joined("reasons").alias("reasons"))


def _garbled(rows):
    """Every third article claims words its item never had."""
    strange = F.lit("Quantum holographic satellites acquired orbital advertising infrastructure")
    third = F.col("doc_id") % 3 == 0
    return rows.withColumns(
        {"article_title": F.when(third, strange).otherwise(F.col("article_title")), "article_body": F.when(third, strange).otherwise(F.col("article_body"))}
    )


_STRANGE = "'Quantum holographic satellites acquired orbital advertising infrastructure'"
_GARBLED = (
    f"garbled AS (SELECT * REPLACE (CASE WHEN doc_id%3=0 THEN {_STRANGE} ELSE article_title END AS article_title, "
    f"CASE WHEN doc_id%3=0 THEN {_STRANGE} ELSE article_body END AS article_body) FROM enriched)"
)


def _fallback_sql(src: str, name: str, note, mark: str, tidy: bool, when: str) -> str:
    line = s.first_line("raw_content")
    summary = f"coalesce(nullif(summary,''), nullif({line},''), article_title)"
    title = f"coalesce(nullif({line},''), nullif(article_title,''), nullif(summary,''), {s.q(fv.FALLBACK_TITLE)})"
    detail = f"coalesce(nullif({s.rest_lines('raw_content')},''), _summary)"
    return f"""{name}_a AS (SELECT *, {when} AS fell_back, {summary} AS _summary, {title} AS _newtitle FROM {src}),
{name} AS (SELECT * REPLACE (CASE WHEN fell_back THEN {s.clamp('_newtitle', 80, mark, tidy)} ELSE article_title END AS article_title,
   CASE WHEN fell_back THEN {s.clamp('_summary', 80, mark, tidy)} ELSE intro_summary END AS intro_summary,
   CASE WHEN fell_back THEN concat('1. ', {s.clamp('_summary', 180, mark, tidy)}, chr(10), '2. ', {s.clamp(detail, 180, mark, tidy)}, chr(10), {s.q(note[0])}, source_name, {s.q(note[1])})
     ELSE article_body END AS article_body) FROM {name}_a)"""


_ONLY_TRACE = f"(is_topic_candidate AND reasons = [{s.q(fv.VERIFY_NO_TRACE)}])"


@query(
    "evidence_fallback",
    f"{_ENRICHED}, {_GARBLED}, {_verify_sql('garbled', 'verified')}, {_fallback_sql('verified', 'fixed', fv.SELECTION_FALLBACK_NOTE, '…', False, _ONLY_TRACE)} "
    "SELECT id, fell_back, article_title, intro_summary, article_body FROM fixed",
)
def evidence_fallback(spark, folder):
    verified = sl.with_verification(_garbled(enriched(spark, folder)), generated(), RULES)
    return sl.evidence_fallback(verified).select("id", "fell_back", "article_title", "intro_summary", "article_body")


_GROUPED = f"""{_ENRICHED}, {_GARBLED}, grouped AS (SELECT g.*, CASE WHEN EXISTS (SELECT 1 FROM enriched p WHERE p.edition=g.edition AND p.id=g.duplicate_of)
     THEN g.duplicate_of ELSE g.id END AS group_root FROM garbled g),
  winners AS (SELECT edition, group_root, id AS winner_id FROM (SELECT *, row_number() OVER (PARTITION BY edition, group_root ORDER BY (duplicate_of IS NOT NULL),
     CASE WHEN duplicate_of IS NULL THEN arrival END, score DESC, source_weight DESC, abs(epoch_us(collected_at)-epoch_us(published_at)), arrival) AS rn FROM grouped) WHERE rn=1)"""


def grouped(spark, folder):
    """Items with their group, without texts; scored once."""
    rows = ranked(spark, folder).select("edition", "id", "duplicate_of", "arrival", "score", "source_weight", "published_at", "collected_at")
    return dd.duplicate_groups(written(rows), ["edition"])


@query("group_winner", f"{_GROUPED} SELECT edition, group_root, winner_id FROM winners")
def group_winner(spark, folder):
    return sl.group_winners(grouped(spark, folder), ["edition"])


_LINKS = """links AS (SELECT edition, winner_id, list(url ORDER BY other, arrival, pos) AS alternatives FROM (
    SELECT edition, winner_id, url, other, arrival, pos, row_number() OVER (PARTITION BY edition, winner_id, url ORDER BY other, arrival, pos) AS rn FROM (
      SELECT edition, winner_id, id<>winner_id AS other, arrival, unnest(urls) AS url, unnest(range(0, len(urls))) AS pos FROM (
        SELECT g.*, w.winner_id, list_concat(CASE WHEN source_type='official' THEN [source_url] ELSE [] END, official_sources) AS urls
        FROM grouped g JOIN winners w ON g.edition=w.edition AND g.group_root=w.group_root))) WHERE rn=1 GROUP BY edition, winner_id),
  candidates AS (SELECT g.* REPLACE (coalesce(alternatives, [source_url]) AS official_sources,
      CASE WHEN source_type='official' THEN source_url ELSE coalesce(alternatives[1], source_url) END AS source_url)
    FROM grouped g JOIN winners w ON g.edition=w.edition AND g.group_root=w.group_root AND g.id=w.winner_id LEFT JOIN links l ON l.edition=w.edition AND l.winner_id=w.winner_id)"""


@query("official_sources", f"{_GROUPED}, {_LINKS} SELECT id, array_to_string(official_sources, '|') AS official_sources, source_url FROM candidates")
def official_sources(spark, folder):
    rows = ranked(spark, folder).select(
        "edition", "id", "duplicate_of", "arrival", "score", "source_weight", "published_at", "collected_at", "source_type", "source_url", "official_sources"
    )
    rows = sl.group_candidates(written(rows), ["edition"])
    return rows.select("id", joined("official_sources").alias("official_sources"), "source_url")


_QUOTA = "CASE category " + " ".join(f"WHEN {s.q(n)} THEN {k}" for n, k in RULES.quotas) + " ELSE 0 END"
_QINDEX = "CASE category " + " ".join(f"WHEN {s.q(n)} THEN {i}" for i, (n, _) in enumerate(RULES.quotas)) + " END"


def _topk_sql(src: str, name: str) -> str:
    return f"""{name}_a AS (SELECT *, row_number() OVER (PARTITION BY edition, category ORDER BY {_RANK}) AS _in_cat FROM {src}),
{name}_b AS (SELECT *, CASE WHEN _in_cat <= {_QUOTA} THEN 0 ELSE 1 END AS _ph, row_number() OVER (PARTITION BY edition ORDER BY CASE WHEN _in_cat <= {_QUOTA} THEN 0 ELSE 1 END,
   CASE WHEN _in_cat <= {_QUOTA} THEN {_QINDEX} ELSE 0 END, {_RANK}) AS _taken FROM {name}_a),
{name} AS (SELECT *, CASE WHEN _ph=0 THEN 'quota' ELSE 'fill' END AS phase, cast(row_number() OVER (PARTITION BY edition ORDER BY {_RANK}) AS int) AS rank FROM {name}_b WHERE _taken <= {RULES.count})"""


@query("balanced_topk", f"{_ENRICHED}, {_topk_sql('(SELECT * FROM enriched WHERE is_topic_candidate AND duplicate_of IS NULL)', 'top')} SELECT edition, id, phase, rank, score FROM top")
def balanced_topk(spark, folder):
    rows = enriched(spark, folder).filter("is_topic_candidate and duplicate_of is null")
    return sl.balanced_topk(rows, generated(), RULES).select("edition", "id", "phase", "rank", "score")


def _audit_sql(prefix: str) -> str:
    """CTEs ``judged``, ``top``, ``audit`` on top of ``garbled``-like CTE chains."""
    return f"""{prefix}, {_verify_sql('candidates', 'verified')}, {_fallback_sql('verified', 'judged0', fv.SELECTION_FALLBACK_NOTE, '…', False, _ONLY_TRACE)},
  judged AS (SELECT *, (len(reasons)=0 OR fell_back) AND is_topic_candidate AS eligible FROM judged0),
  {_topk_sql('(SELECT * FROM judged WHERE eligible)', 'top')},
  audit AS (
    SELECT edition, 'selected' AS bucket, id, article_title AS title, category, source_name, source_url, ['selected'] AS reasons, score, source_weight, published_at, official_sources, coalesce(duplicate_of, id) AS duplicate_group FROM top
    UNION ALL SELECT edition, CASE WHEN eligible OR len(reasons)=0 THEN 'rejected' ELSE 'failed_verification' END, id, article_title, category, source_name, source_url,
      CASE WHEN eligible THEN [{s.q(fv.AUDIT_OVER_COUNT)}] WHEN len(reasons)=0 THEN [coalesce(nullif(exclusion_reason,''), {s.q(fv.AUDIT_NOT_CANDIDATE)})] ELSE reasons END,
      score, source_weight, published_at, official_sources, coalesce(duplicate_of, id) FROM judged WHERE id NOT IN (SELECT id FROM top)
    UNION ALL SELECT edition, 'duplicate', id, article_title, category, source_name, source_url, [{s.q(fv.AUDIT_DUPLICATE)}], score, source_weight, published_at, official_sources, coalesce(duplicate_of, id)
      FROM garbled WHERE id NOT IN (SELECT winner_id FROM winners) OR duplicate_of IS NOT NULL)"""


_AUDIT = _audit_sql(f"{_GROUPED}, {_LINKS}")
_AUDIT_OUT = f"""edition, bucket, id, title, category, source_name, source_url, array_to_string(reasons, '|') AS reasons, score, source_weight,
  {s.freshness(_GEN, 'published_at')} AS freshness_hours, array_to_string(official_sources, '|') AS official_sources, duplicate_group"""


def audit_of(rows):
    return sl.select_and_audit(rows, generated(), RULES)


def flat(audit):
    return audit.withColumns({"reasons": joined("reasons"), "official_sources": joined("official_sources")})


@query("selection_audit", f"{_AUDIT} SELECT {_AUDIT_OUT} FROM audit")
def selection_audit(spark, folder):
    return flat(audit_of(_garbled(enriched(spark, folder)))[1])


_FULL_ENRICHED = f"""WITH RECURSIVE {s.MARKED}, {s.scored('marked', 'scored', SIGNALS)}, garbled AS (SELECT *, cross_relevance_score AS score, provider_candidate AS is_topic_candidate,
    array_to_string(provider_reasons, '; ') AS exclusion_reason, cast(date_trunc('day', published_at) AS date) + 1 AS edition FROM scored),
  enriched AS (SELECT * FROM garbled)"""
_FULL = _FULL_ENRICHED + _GROUPED[_GROUPED.index(", grouped AS") :] + ", " + _LINKS


def curated(spark, folder):
    """The whole daily job: mark duplicates, score, select with audit, all editions at once."""
    return audit_of(enriched(spark, folder, dd.mark_duplicates(items(spark, folder))))


@query("curated_editions", f"{_audit_sql(_FULL)} SELECT {_AUDIT_OUT} FROM audit")
def curated_editions(spark, folder):
    return flat(curated(spark, folder)[1])


_STORED_ORDER = "score DESC, source_weight DESC, published_at DESC, arrival"


@query("topic_candidates", f"{_ENRICHED} SELECT id, score FROM enriched WHERE is_topic_candidate AND cross_relevance_score >= 60 ORDER BY {_STORED_ORDER} LIMIT 500")
def topic_candidates(spark, folder):
    return sl.topic_candidates(enriched(spark, folder), 500, 60).select("id", "score")


@query(
    "selected_candidates",
    f"{_ENRICHED} SELECT id, score FROM enriched WHERE is_topic_candidate AND duplicate_of IS NULL AND cross_relevance_score >= 60 ORDER BY {_STORED_ORDER} LIMIT 5",
)
def selected_candidates(spark, folder):
    return sl.selected_candidates(enriched(spark, folder), 5, 60).select("id", "score")


@query("run_totals", f"{_AUDIT} SELECT edition, bucket, count(*) AS n FROM audit GROUP BY ALL")
def run_totals(spark, folder):
    from gleaner.operators.rollup import run_totals as totals

    return totals(audit_of(_garbled(enriched(spark, folder)))[1], ["edition"], "bucket")


# --- articles -----------------------------------------------------------------------------------------------------------------
_TOP = f"{_ENRICHED}, {_topk_sql('(SELECT * FROM enriched WHERE is_topic_candidate AND duplicate_of IS NULL)', 'top')}"


def top(spark, folder):
    """The few selected rows of every edition; texts that are built of them read them several times. Selection needs no text, so only
    selected rows are described."""
    scored = sc.classify(linked(spark, folder), signals=SIGNALS).filter("provider_candidate and duplicate_of is null")
    columns = {"score": F.col("cross_relevance_score"), "category": sc.category(), "edition": F.date_add(F.to_date("published_at"), 1)}
    chosen = sl.balanced_topk(scored.withColumns(columns), generated(), RULES)
    return cut_lineage(sc.enrich_items(chosen, scorer=sc.describe))


@query(
    "group_by_category",
    f"""{_TOP} SELECT edition, category, min(rank) AS category_place, count(*) AS n_items, array_to_string(list(id ORDER BY rank), '|') AS item_ids FROM top GROUP BY edition, category""",
)
def group_by_category(spark, folder):
    return ar.group_by_category(top(spark, folder), ["edition"]).withColumn("item_ids", joined("item_ids"))


HAN_INTRO = "智能工具进了产线，这波变化值得关注！"
TWO_PART_INTRO = "点评：产线变化很快；后续值得关注。第二句。"


def generated_entries(rows):
    """Entries for all but every eleventh item, in several qualities."""
    n = F.col("doc_id")
    points = F.concat(
        F.lit("1. "), tx.collapse(F.col("raw_content")), F.lit("\n\n2. "), F.col("article_title"), F.lit(" again\r\n3. short")
    )
    body = (
        F.when(n % 5 == 0, F.lit("Quantum holographic satellites acquired orbital advertising infrastructure"))
        .when(n % 5 == 1, F.concat(points, F.lit(" but long enough to count"))).when(n % 5 == 2, F.lit(""))
        .otherwise(points)
    )
    intro = (
        F.when(n % 4 == 0, F.lit(HAN_INTRO)).when(n % 4 == 1, F.col("article_title")).when(n % 4 == 2, F.lit("")).otherwise(F.lit(TWO_PART_INTRO))
    )
    links = F.when(n % 6 == 0, F.array(F.lit("https://elsewhere.example.com/x"))).otherwise(F.array(F.concat("source_url", F.lit("#top"))))
    return rows.filter(n % 11 != 7).select(
        "id", F.when(n % 13 == 0, F.lit(" ")).otherwise(F.col("article_title")).alias("gen_title"), body.alias("gen_body"), intro.alias("gen_intro"), links.alias("gen_links")
    )


_POINTS = f"concat('1. ', {s.collapse('raw_content')}, chr(10), '2. ', article_title, ' again', chr(10), '3. short')"
_BODY_LINES = f"""CASE doc_id%5 WHEN 0 THEN {_STRANGE} WHEN 1 THEN concat({_POINTS}, ' but long enough to count') WHEN 2 THEN '' ELSE {_POINTS} END"""
_NORM_LINES = r"array_to_string(list_filter(list_transform(string_split(_gb, chr(10)), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')), lambda l: l <> ''), chr(10))"
_ARTICLES = f"""{_ENRICHED}, e0 AS (SELECT *, doc_id%11<>7 AS has_entry, CASE WHEN doc_id%13=0 THEN ' ' ELSE article_title END AS gt, {_BODY_LINES} AS _gb FROM enriched),
e1 AS (SELECT *, {s.clamp(_NORM_LINES, 500)} AS gb, CASE WHEN doc_id%4=0 THEN {s.q(HAN_INTRO)} WHEN doc_id%4=3 THEN '产线变化很快，后续值得关注。' ELSE '' END AS gi, doc_id%6<>0 AS kept FROM e0),
e2 AS (SELECT *, concat_ws(' ', gt, gb, gi) AS _t, list_filter(list_transform(string_split(gb, chr(10)), lambda l: regexp_replace(l, '^\\s+|\\s+$', '', 'g')), lambda l: regexp_matches(l, '^[0-9]+\\.\\s+')) AS pts FROM e1),
e3 AS (SELECT *, {s.claim_tokens('_t', fv.ARTICLE_STOP_WORDS)} AS cl, list_distinct({s.evidence_tokens(_EV, fv.ARTICLE_STOP_WORDS)}) AS ev FROM e2),
checked AS (SELECT *, CASE WHEN NOT has_entry THEN [{s.q(fv.ARTICLE_MISSING)}] ELSE list_filter([
  CASE WHEN trim(gt)='' THEN {s.q(fv.VERIFY_NO_TITLE)} END, CASE WHEN gi='' THEN {s.q(fv.ARTICLE_NO_INTRO)} END,
  CASE WHEN doc_id%4 IN (1,2) THEN {s.q(fv.ARTICLE_INTRO_SCRIPT)} END, CASE WHEN gb='' THEN {s.q(fv.VERIFY_NO_BODY)} END,
  CASE WHEN NOT kept THEN {s.q(fv.ARTICLE_NO_LINK)} END, CASE WHEN len(pts)<>3 THEN {s.q(fv.ARTICLE_POINT_COUNT)} END,
  CASE WHEN len(list_filter(pts, lambda p: length(p)<12))>0 THEN {s.q(fv.ARTICLE_SHORT_POINTS)} END,
  CASE WHEN doc_id%4=1 AND doc_id%13<>0 AND regexp_replace(article_title, '[“”"''‘’《》【】（）():：，,。.!！？?、~\\-—_\\s]', '', 'g')<>'' THEN {s.q(fv.ARTICLE_INTRO_IS_TITLE)} END,
  CASE WHEN NOT (CASE WHEN gi<>'' AND kept THEN true ELSE coalesce(len(list_filter(cl, lambda t: list_contains(ev, t)))::double/nullif(len(cl),0) >= 0.25, false) END) THEN {s.q(fv.VERIFY_NO_TRACE)} END
  ], lambda x: x IS NOT NULL) END AS reasons FROM e3)"""


@query("validate_articles", f"{_ARTICLES} SELECT id, array_to_string(reasons, '|') AS reasons, CASE WHEN has_entry THEN gi ELSE '' END AS norm_intro, CASE WHEN has_entry THEN gb ELSE '' END AS norm_body FROM checked")
def validate_articles(spark, folder):
    rows = written(enriched(spark, folder))
    return ar.validate_articles(rows, generated_entries(rows)).select("id", joined("reasons").alias("reasons"), "norm_intro", "norm_body")


@query(
    "article_outcomes",
    f"""{_ARTICLES}, {_fallback_sql('checked', 'done', fv.ARTICLE_FALLBACK_NOTE, '...', True, 'len(reasons) > 0')}
    SELECT id, CASE WHEN fell_back THEN 'fallback' ELSE 'generated' END AS outcome, CASE WHEN fell_back THEN article_title ELSE {s.strip('gt')} END AS article_title,
      CASE WHEN fell_back THEN article_body ELSE gb END AS article_body, CASE WHEN fell_back THEN intro_summary ELSE gi END AS intro_summary,
      CASE WHEN fell_back THEN source_url ELSE concat(source_url, '#top') END AS links FROM done""",
)
def article_outcomes(spark, folder):
    rows = written(enriched(spark, folder))
    done = ar.article_outcomes(ar.validate_articles(rows, generated_entries(rows)))
    return done.select("id", "outcome", "article_title", "article_body", "intro_summary", joined("official_sources").alias("links"))


# --- store lookups --------------------------------------------------------------------------------------------------------------
@query("items_with_source", f"WITH {s.LINKED} SELECT id, concat('Source ', source_name) AS source_name, source_type, source_weight FROM linked")
def items_with_source(spark, folder):
    raw, _, sources = store_tables(spark, folder)
    return st.items_with_source(raw, sources).select("id", "source_name", "source_type", "source_weight")


@query("pending_items", f"WITH {s.LINKED} SELECT id, concat('Source ', source_name) AS source_name, collected_at FROM linked WHERE collected_at >= timestamp '{SPLIT}'")
def pending_items(spark, folder):
    raw, processed, sources = store_tables(spark, folder)
    return st.pending_items(raw, processed, sources).select("id", "source_name", "collected_at")


@query(
    "map_dup_ids",
    f"""WITH {s.LINKED} SELECT a.id, a.duplicate_of, 'p' || b.id AS processed_duplicate_of FROM linked a LEFT JOIN linked b
    ON b.id = a.duplicate_of AND b.collected_at < timestamp '{SPLIT}' WHERE a.duplicate_of IS NOT NULL""",
)
def map_dup_ids(spark, folder):
    raw, processed, _ = store_tables(spark, folder)
    return st.map_duplicate_ids(raw, processed)
