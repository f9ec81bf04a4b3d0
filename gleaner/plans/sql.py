"""SQL fragments the check queries are put together from (DuckDB dialect)."""

from __future__ import annotations

from gleaner import fixed_values as fv
from gleaner.operators.screening import Signals

ITEMS = r"""items AS (
  SELECT cast(doc_id AS varchar) AS id, doc_id,
    ((doc_id*37)%43200)*1000000000 + doc_id AS arrival,
    coalesce(list_filter(regexp_split_to_array(text,'\r?\n+'), lambda x: trim(x) <> '')[1],'') AS article_title,
    text AS raw_content, source AS source_name,
    (['ai_media','game_media','ai_game_media','official','community'])[cast(substr(source,4) AS int)%5+1] AS source_type,
    cast(30 + (cast(substr(source,4) AS int)*7)%66 AS int) AS source_weight,
    timestamp '2024-01-01 00:00:00' + to_minutes(cast((doc_id*37)%43200 AS int)) AS published_at,
    timestamp '2024-01-01 01:00:00' + to_minutes(cast((doc_id*37)%43200 AS int)) AS collected_at,
    concat('https://news.example.com/a/', cast(doc_id - CASE WHEN doc_id%10=1 THEN 1 ELSE 0 END AS varchar),
           CASE WHEN doc_id%10=1 THEN '?utm_source=feed' ELSE '' END) AS source_url,
    concat('https://news.example.com/a/', cast(doc_id - CASE WHEN doc_id%10=1 THEN 1 ELSE 0 END AS varchar)) AS url_key
  FROM documents)"""


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def norm(x: str) -> str:
    return f"lower({collapse(x)})"


def norm_title(x: str) -> str:
    cleaned = rf"regexp_replace({norm(x)}, '[^\p{{L}}\p{{N}}\s]', ' ', 'g')"
    return collapse(rf"regexp_replace({cleaned}, '\b({'|'.join(fv.TITLE_NOISE_WORDS)})\b', ' ', 'g')")


def tokens(x: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({x}), '[a-z0-9]{{3,}}'))"


def stems(x: str) -> str:
    return f"list_transform(regexp_extract_all(lower({x}), '[a-z0-9]+'), lambda w: regexp_replace(w, '(?:ing|ed|es|s)$', ''))"


def stop_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def claim_tokens(x: str, words) -> str:
    return f"list_filter({stems(x)}, lambda t: not list_contains({stop_list(words)}, t) and length(t) > 3)"


def evidence_tokens(x: str, words) -> str:
    return f"list_filter({stems(x)}, lambda t: not list_contains({stop_list(words)}, t))"


def jaccard(a: str, b: str) -> str:
    common = f"len(list_intersect({a},{b}))"
    return f"(CASE WHEN len({a})=0 OR len({b})=0 THEN 0e0 ELSE {common}::double/(len({a})+len({b})-{common}) END)"


def half_up(x: str) -> str:
    return f"floor(({x})+0.5e0)"


def clamp_score(x: str) -> str:
    return f"cast(greatest(0, least(100, {x})) AS int)"


def weighted(score: str, weight: str = "source_weight") -> str:
    return clamp_score(half_up(f"{score} + ({weight}-50)*0.25e0"))


def low_information(x: str) -> str:
    compact = collapse(x)
    parts = rf"list_filter(regexp_split_to_array({compact}, '[。！？.!?]\s*|\n+'), lambda p: {strip('p')} <> '')"
    return f"(length({compact}) < 160 OR len({parts}) < 3)"


def hits(text: str, signals) -> str:
    return "(" + " + ".join(f"cast(regexp_matches({text}, {q(p)}) AS int)" for _, p in signals) + ")"


def clamp(x: str, n: int, mark: str = "...", tidy: bool = True) -> str:
    s = strip(x)
    head = f"substr({s}, 1, {n - len(mark)})"
    if tidy:
        head = rf"regexp_replace({head}, '\s+$', '')"
    return f"(CASE WHEN length({s}) <= {n} THEN {s} ELSE concat({head}, {q(mark)}) END)"


def first_line(x: str) -> str:
    return rf"coalesce(list_filter(list_transform(regexp_split_to_array({x}, '\r?\n+'), lambda l: {strip('l')}), lambda l: l <> '')[1], '')"


def rest_lines(x: str) -> str:
    return rf"array_to_string(list_filter(list_transform(regexp_split_to_array({x}, '\r?\n+'), lambda l: {strip('l')}), lambda l: l <> '')[2:], ' ')"


def canonical(u: str, dropped=tuple(fv.TRACKING_PARAMS), prefix: str | None = None) -> str:
    extra = f" AND NOT starts_with(lower(split_part(p,'=',1)), '{prefix}')" if prefix else ""
    query = (
        f"list_sort(list_filter(string_split(regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1), '&'), "
        f"lambda p: p <> '' AND NOT list_contains({stop_list(dropped)}, lower(split_part(p,'=',1))){extra}))"
    )
    head = f"lower(regexp_extract({u}, '^(https?://[^/?#]*)', 1))"
    path = f"regexp_replace(coalesce(nullif(regexp_extract({u}, '^https?://[^/?#]*([^?#]*)', 1), ''), '/'), '(.)/$', '\\1')"
    return f"regexp_replace(concat({head}, {path}, CASE WHEN len({query})>0 THEN concat('?', array_to_string({query}, '&')) ELSE '' END), '/$', '')"


def html_text(x: str) -> str:
    s = rf"regexp_replace({x}, '(?is)<script\b.*?</script>', ' ', 'g')"
    s = rf"regexp_replace({s}, '(?is)<style\b.*?</style>', ' ', 'g')"
    s = f"regexp_replace({s}, '<[^>]+>', ' ', 'g')"
    return collapse(entities(s))


def entities(s: str) -> str:
    for a, b in [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''")]:
        s = f"replace({s}, '{a}', '{b}')"
    return s


def sentences(x: str) -> str:
    return f"list_filter(list_transform(regexp_extract_all({collapse(x)}, '[^。！？!?；;.\\n]+(?:[。！？!?；;.]|$)'), lambda s: {strip('s')}), lambda s: s <> '')"


def speech_ms(x: str) -> str:
    return rf"cast(least(12000, greatest(900, 500 + 80*length(regexp_replace({x}, '\s+', '', 'g')))) AS bigint)"


def srt_time(ms: str) -> str:
    return (
        f"printf('%02d:%02d:%02d,%03d', cast({ms} AS bigint)//3600000, (cast({ms} AS bigint)//60000)%60, "
        f"(cast({ms} AS bigint)//1000)%60, cast({ms} AS bigint)%1000)"
    )


def slug(x: str) -> str:
    s = rf"regexp_replace(regexp_replace({strip(f'lower({x})')}, '[^a-z0-9\x{{4e00}}-\x{{9fff}}]+', '-', 'g'), '^-+|-+$', '', 'g')"
    return f"coalesce(nullif({s}, ''), 'section')"


def escape_md(x: str) -> str:
    return rf"regexp_replace({collapse(x)}, '([\\`*_{{}}\[\]()#+\-.!|>])', '\\\1', 'g')"


def freshness(gen: str, pub: str) -> str:
    return f"floor((epoch_us({gen})-epoch_us({pub}))/3600000000e0*100 + 0.5e0)/100"


# --- scoring ----------------------------------------------------------------------------------------------------------
def scored(src: str, name: str, sig: Signals, title: str = "article_title", min_cross: int = fv.MIN_CROSS_SCORE) -> str:
    """CTEs that add all scorer columns to ``src`` under ``name``."""
    t = "_text"
    return f"""
{name}_1 AS (SELECT *, lower(concat({title}, chr(10), raw_content)) AS _text FROM {src}),
{name}_2 AS (SELECT *, {hits(t, sig.ai)} AS _ai, {hits(t, sig.game)} AS _game, {hits(t, sig.cross)} AS _cross,
   {low_information('raw_content')} AS _low, regexp_matches(_text, {q(sig.repost)}) AS _repost FROM {name}_1),
{name}_3 AS (SELECT *, {clamp_score('CASE WHEN _ai=0 THEN 12 ELSE 25+_ai*20+_cross*6 END')} AS ai_relevance_score,
   {clamp_score('CASE WHEN _game=0 THEN 20 ELSE 30+_game*14+_cross*6 END')} AS game_relevance_score FROM {name}_2),
{name}_4 AS (SELECT *, {clamp_score(
    'CASE WHEN _ai=0 OR _game=0 THEN ' + half_up('ai_relevance_score*0.35e0+game_relevance_score*0.25e0') + ' ELSE '
    + half_up('ai_relevance_score*0.45e0+game_relevance_score*0.35e0+_cross*8+(source_weight-50)*0.08e0') + ' END')} AS cross_relevance_score FROM {name}_3),
{name}_5 AS (SELECT *, CASE WHEN _repost OR _low THEN 35 ELSE {clamp_score(half_up(f'cross_relevance_score*0.55e0+source_weight*0.2e0+{hits(t, sig.value)}*6+20'))} END AS news_value_score FROM {name}_4),
{name}_6 AS (SELECT *, CASE WHEN regexp_matches(_text, {q(sig.tutorial)}) THEN {q(fv.REASON_TUTORIAL)}
     WHEN regexp_matches(_text, {q(sig.gossip)}) THEN {q(fv.REASON_GOSSIP)}
     WHEN _repost OR length(_text)<50 THEN {q(fv.REASON_REPOST)}
     WHEN ai_relevance_score<40 AND game_relevance_score>=45 THEN {q(fv.REASON_NON_AI)}
     WHEN cross_relevance_score<{min_cross} THEN {q(fv.REASON_LOW_CROSS)}
     WHEN news_value_score<55 THEN {q(fv.REASON_LOW_VALUE)} END AS _rule FROM {name}_5),
{name}_7 AS (SELECT *, list_filter([CASE WHEN _low THEN {q(fv.REASON_LOW_INFORMATION)} END, _rule], lambda x: x IS NOT NULL) AS provider_reasons,
   {strip(title)} AS _title, {collapse('raw_content')} AS _content FROM {name}_6),
{name} AS (SELECT * REPLACE (
     coalesce(nullif(_title,''), nullif(substr(_content,1,40),''), CASE WHEN cross_relevance_score>=60 THEN 'AI x game update' ELSE 'Game industry update' END) AS {title}),
   len(provider_reasons)=0 AS provider_candidate,
   CASE WHEN ai_relevance_score>50 THEN ['tooling','workflow'] ELSE [] END AS ai_tags,
   CASE WHEN game_relevance_score>50 THEN ['development','operations'] ELSE [] END AS game_tags,
   CASE WHEN cross_relevance_score>=65 THEN 'AI x Game' WHEN ai_relevance_score>=game_relevance_score THEN 'AI' ELSE 'Game Industry' END AS category,
   {clamp("concat(_title, CASE WHEN _title<>'' AND _content<>'' THEN '：' ELSE '' END, _content)", 140)} AS summary,
   concat(coalesce(nullif(_title,''), nullif(substr(_content,1,40),''), {q(fv.INTRO_NO_SUBJECT)}),
     CASE WHEN cross_relevance_score>=70 THEN {q(fv.INTRO_CROSS)} WHEN ai_relevance_score>=60 THEN {q(fv.INTRO_AI)} ELSE {q(fv.INTRO_GAME)} END) AS intro_summary,
   {keywords(sig)} AS keywords,
   CASE WHEN cross_relevance_score>=60 THEN concat(
        CASE WHEN coalesce(nullif(_title,''), substr(_content,1,40))<>'' THEN concat(coalesce(nullif(_title,''), substr(_content,1,40)), '。') ELSE '' END,
        CASE WHEN length(_content)>220 THEN concat(regexp_replace(substr(_content,1,220), '\\s+$', ''), '...') ELSE _content END)
     ELSE concat({q(fv.BELOW_THRESHOLD_BODY)}, substr(_content,1,140), CASE WHEN length(_content)>140 THEN '...' ELSE '' END) END AS article_body,
   [source_url] AS official_sources
   FROM {name}_7)"""


def keywords(sig: Signals) -> str:
    parts = ", ".join(f"CASE WHEN regexp_matches(_text, {q(p)}) THEN {q(label)} END" for label, p in [*sig.ai, *sig.game, *sig.cross])
    parts += f", CASE WHEN cross_relevance_score>=70 THEN {q(fv.CROSS_LABEL)} END"
    return distinct_in_order(f"list_filter([{parts}], lambda x: x IS NOT NULL)") + "[1:8]"


def distinct_in_order(expr: str) -> str:
    """First occurrences of a list, order kept."""
    return f"list_transform(list_filter(list_zip({expr}, range(1, len({expr})+1)), lambda z: list_position({expr}, z[1]) = z[2]), lambda z: z[1])"


# --- duplicates ---------------------------------------------------------------------------------------------------------
TOKS = f"""toks AS MATERIALIZED (
  SELECT id, arrival, url_key, CASE WHEN {norm('raw_content')} <> '' THEN sha256({norm('raw_content')}) END AS hash_key,
    {tokens(norm_title('article_title'))} AS tset, {tokens('raw_content')} AS bset FROM items)"""


def best_match(where: str = "true") -> str:
    """CTE ``best``: id, parent, score, reason; ``where`` restricts pairs (aliases a: item, b: earlier item)."""
    return f"""
words AS (SELECT id, arrival, unnest(tset) AS w FROM toks),
shared AS (SELECT a.id AS aid, b.id AS bid, count(*) AS c FROM words a JOIN words b ON a.w = b.w AND b.arrival < a.arrival WHERE {where} GROUP BY 1, 2),
near AS (SELECT aid, bid FROM shared JOIN toks a ON a.id=aid JOIN toks b ON b.id=bid WHERE c > 0.47*(len(a.tset)+len(b.tset)-c)),
same AS (SELECT a.id AS aid, b.id AS bid FROM toks a JOIN toks b ON a.url_key=b.url_key AND b.arrival < a.arrival WHERE {where}
  UNION SELECT a.id, b.id FROM toks a JOIN toks b ON a.hash_key=b.hash_key AND b.arrival < a.arrival WHERE {where}),
cand AS (SELECT a.id, b.id AS pid, b.arrival AS parr, a.url_key=b.url_key AS eu, coalesce(a.hash_key=b.hash_key, false) AS eh,
   {jaccard('a.tset', 'b.tset')} AS t, a.bset AS ab, b.bset AS bb FROM (SELECT * FROM near UNION SELECT * FROM same) p JOIN toks a ON a.id=p.aid JOIN toks b ON b.id=p.bid),
rated AS (SELECT id, pid, parr, eu, eh, CASE WHEN eu OR eh THEN 1e0 ELSE greatest(0.65e0*t + 0.35e0*{jaccard('ab', 'bb')}, CASE WHEN t=1 THEN 0.78e0 ELSE 0e0 END) END AS score
   FROM cand WHERE eu OR eh OR t > 0.47),
best AS MATERIALIZED (SELECT id, pid AS parent, score, CASE WHEN eu THEN 'exact_url' WHEN eh THEN 'exact_content' ELSE 'near_duplicate' END AS reason FROM (
   SELECT *, row_number() OVER (PARTITION BY id ORDER BY (eu OR eh) DESC, CASE WHEN eu OR eh THEN parr END, score DESC, parr) AS rn FROM rated WHERE score >= 0.66e0) WHERE rn=1)"""


PREFERENCE = "CASE WHEN source_type='official' THEN 0 ELSE 1 END, published_at, source_weight DESC, collected_at, arrival"

MARKED = f"""{ITEMS}, {TOKS}, {best_match()},
root AS (SELECT id, id AS root FROM items WHERE id NOT IN (SELECT id FROM best)
  UNION ALL SELECT b.id, r.root FROM best b JOIN root r ON b.parent = r.id),
canon AS (SELECT root, id AS canonical FROM (SELECT root.root, items.id, row_number() OVER (PARTITION BY root.root ORDER BY {PREFERENCE}) AS rn
  FROM items JOIN root ON root.id = items.id) WHERE rn=1),
marked AS (SELECT items.*, CASE WHEN canonical <> items.id THEN canonical END AS duplicate_of
  FROM items JOIN root ON root.id=items.id JOIN canon ON canon.root=root.root)"""

# a cheap duplicate relation for the operators behind duplicate marking: every tenth document repeats the URL before it
LINKED = f"{ITEMS}, linked AS (SELECT *, CASE WHEN doc_id%10=1 THEN cast(doc_id-1 AS varchar) END AS duplicate_of FROM items)"
