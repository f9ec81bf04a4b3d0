"""Checks on generated articles, fallback texts, outcomes, and responses of a text model."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import text as tx
from gleaner.functions import urls as ul
from gleaner.operators.dedupe import distinct_urls
from gleaner.operators.selection import fallback_fields, traced


def category_or_default() -> Column:
    return F.coalesce(tx.null_if_blank(tx.strip(F.coalesce("category", F.lit("")))), F.lit("Uncategorized"))


def group_by_category(selected: DataFrame, scope: list[str], place: str = "rank") -> DataFrame:
    """Per edition and category: item ids in order, and the category's place. Editions are small by selection."""
    groups = selected.groupBy(*scope, category_or_default().alias("category")).agg(
        F.min(place).alias("category_place"),
        F.count("*").alias("n_items"),
        F.transform(F.sort_array(F.collect_list(F.struct(place, "id"))), lambda x: x["id"]).alias("item_ids"),
    )
    return groups


# --- texts -------------------------------------------------------------------------------------------------------------
def compact_intro(c: Column) -> Column:
    c = F.regexp_replace(c, r"\r?\n+", " ")
    c = F.regexp_replace(c, r"(?U)^点评[:：]\s*", "")
    return tx.strip(F.regexp_replace(c, "[；;]+", "，"))


def simplify(c: Column) -> Column:
    return tx.strip(F.regexp_replace(F.lower(c), "(?U)" + fv.COMPARISON_PUNCTUATION_CLASS, ""))


def too_similar(title: Column, intro: Column) -> Column:
    """Intro says the same as the title: equal, one starts with the other, or nearly all chunks shared."""
    t, s = simplify(title), simplify(intro)

    def alike(x: Column) -> Column:
        a, b = x["t"], x["s"]
        same = b.startswith(a) | (a.startswith(b) & (F.length(b) >= 12)) | (tx.overlap_ratio(a, b) >= 0.85)
        return (a != "") & (b != "") & same

    return tx.let(F.struct(t.alias("t"), s.alias("s")), alike)


def normalized_intro(intro: Column, title: Column) -> Column:
    """First sentence, clamped; blank when it has no Han text or repeats the title."""
    first = tx.strip(F.regexp_extract(compact_intro(intro), "([^。！？.!?]+[。！？!?]?)", 1))
    short = tx.let(first, lambda x: F.when(tx.has_han(x), tx.clamp(x, 60)).otherwise(tx.clamp(x, 120)))
    return tx.let(short, lambda x: F.when(tx.has_han(x) & ~too_similar(title, x), x).otherwise(F.lit("")))


def normalized_body(body: Column) -> Column:
    """Trimmed non-blank lines; the one paragraph they form is clamped to 500 characters."""
    lines = F.filter(F.transform(F.split(F.replace(tx.head(body, 600), F.lit("\r\n"), F.lit("\n")), "\n"), tx.strip), lambda x: x != "")
    return tx.clamp(F.array_join(lines, "\n"), 500)


def kept_links() -> Column:
    """Links of the item itself: official ones, then its own."""
    return F.concat("official_sources", F.array("source_url"))


def preserved_links(proposed: Column) -> Column:
    return distinct_urls(F.concat(proposed, kept_links()), ul.canonical_url)


def validate_articles(items: DataFrame, entries: DataFrame) -> DataFrame:
    """Selected items with their generated entry's ``reasons`` (empty: valid) and normalised texts.

    ``entries``: id, gen_title, gen_body, gen_intro, gen_links. Items without an entry get the missing-entry reason.
    """
    df = items.join(entries, "id", "left")
    none = F.array().cast("array<string>")
    df = tx.settle(
        df,
        {
            "_has": F.col("gen_title").isNotNull(),
            "gen_title": F.coalesce("gen_title", F.lit("")),
            "gen_links": F.coalesce("gen_links", none),
            "_raw_intro": compact_intro(F.coalesce("gen_intro", F.lit(""))),
            "_body": normalized_body(F.coalesce("gen_body", F.lit(""))),
        },
    )
    df = tx.settle(df, {"_intro": normalized_intro(F.coalesce("gen_intro", F.lit("")), F.col("gen_title"))})
    allowed = F.transform(F.filter(kept_links(), ul.is_http_url), ul.canonical_url)
    offered = F.transform(F.filter("gen_links", ul.is_http_url), ul.canonical_url)
    text = F.concat_ws(" ", "gen_title", "_body", "_intro")
    claims = tx.claim_tokens(text, fv.ARTICLE_STOP_WORDS, keep_han=False)
    points = F.filter(F.transform(F.split("_body", "\n"), tx.strip), lambda x: x.rlike(r"(?U)^[0-9]+\.\s+"))
    df = tx.settle(df, {"_kept": F.arrays_overlap(allowed, offered), "_points": points})
    df = tx.settle(df, {"_traced": (tx.has_han(text) & F.col("_kept")) | traced(claims, 0.25)})
    checks = [
        (tx.strip(F.col("gen_title")) == "", fv.VERIFY_NO_TITLE),
        (F.col("_intro") == "", fv.ARTICLE_NO_INTRO),
        (~tx.has_han(F.col("_raw_intro")), fv.ARTICLE_INTRO_SCRIPT),
        (F.col("_body") == "", fv.VERIFY_NO_BODY),
        (~F.col("_kept"), fv.ARTICLE_NO_LINK),
        (F.exists(F.split("_body", r"\n{2,}"), lambda p: F.length(tx.strip(p)) > 500), fv.ARTICLE_LONG_PARAGRAPH),
        (F.size("_points") != 3, fv.ARTICLE_POINT_COUNT),
        (F.exists("_points", lambda p: F.length(p) < 12), fv.ARTICLE_SHORT_POINTS),
        (too_similar(F.col("gen_title"), F.col("_raw_intro")) | too_similar(F.col("gen_title"), F.col("_intro")), fv.ARTICLE_INTRO_IS_TITLE),
        (tx.looks_like_mojibake(F.concat_ws(" ", "gen_title", "_intro", "_body")), fv.ARTICLE_MOJIBAKE),
        (~F.col("_traced"), fv.VERIFY_NO_TRACE),
    ]
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(r)) for bad, r in checks]))
    df = tx.settle(
        df,
        {
            "reasons": F.when(F.col("_has"), reasons).otherwise(F.array(F.lit(fv.ARTICLE_MISSING))),
            "norm_intro": F.col("_intro"),
            "norm_body": F.col("_body"),
        },
    )
    return df.drop("_has", "_raw_intro", "_body", "_intro", "_kept", "_points", "_traced")


def article_outcomes(validated: DataFrame) -> DataFrame:
    """Final texts per item and the ``outcome``: generated, or fallback built from the item's evidence."""
    good = F.size("reasons") == 0
    held, rebuilt = fallback_fields(validated, ~good, fv.ARTICLE_FALLBACK_NOTE, "...", tidy=True)
    none = F.array().cast("array<string>")
    return held.withColumns(
        {
            "outcome": F.when(good, F.lit("generated")).otherwise(F.lit("fallback")),
            "article_title": F.when(good, tx.strip(F.col("gen_title"))).otherwise(rebuilt["article_title"]),
            "article_body": F.when(good, F.col("norm_body")).otherwise(rebuilt["article_body"]),
            "intro_summary": F.when(good, F.col("norm_intro")).otherwise(rebuilt["intro_summary"]),
            "official_sources": preserved_links(F.when(good, F.col("gen_links")).otherwise(none)),
        }
    ).drop("gen_title", "gen_body", "gen_intro", "gen_links", "norm_intro", "norm_body", "_lines", "_line", "_rest")


# --- responses ------------------------------------------------------------------------------------------------------------
CLASSIFICATION_FIELDS = {
    "newsValueScore": "score", "aiRelevanceScore": "score", "gameRelevanceScore": "score", "crossRelevanceScore": "score",
    "isTopicCandidate": "bool", "exclusionReasons": "texts", "aiTags": "texts", "gameTags": "texts",
}
SUMMARY_FIELDS = {"summary": "text", "introSummary": "text"}
ARTICLE_FIELDS = {"id": "text", "articleTitle": "text", "articleBody": "text", "introSummary": "text", "sourceLinks": "texts"}

_DDL = {"score": "int", "bool": "boolean", "texts": "array<string>", "text": "string"}


def _fits(value: object, kind: str) -> bool:
    if kind == "score":
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        return number and float(value).is_integer() and 0 <= value <= 100
    if kind == "bool":
        return isinstance(value, bool)
    if kind == "texts":
        return isinstance(value, list) and all(isinstance(v, str) for v in value)
    return isinstance(value, str) and value != ""


def _openings(raw: str) -> Iterator[str]:
    """Complete top-level JSON texts of a mixed answer, left to right."""
    first = next((i for i, c in enumerate(raw) if c in "{["), len(raw))
    opened: dict[str, list[int]] = {"}": [], "]": []}
    closed: dict[int, int] = {}
    for part in re.finditer(r'"(?:\\.|[^"\\])*(?:"|$)|[{}\[\]]', raw[first:], re.S):
        mark, place = part.group(), first + part.start()
        if mark == "{":
            opened["}"].append(place)
        elif mark == "[":
            opened["]"].append(place)
        elif opened.get(mark):
            closed[opened[mark].pop()] = place + 1
    at = 0
    for start in sorted(closed):
        if start >= at:
            at = closed[start]
            yield raw[start:at]


def _read_answer(raw: str | None, fields: dict[str, str]) -> tuple[dict | None, str | None]:
    if not isinstance(raw, str):
        return None, "no_json"
    fence = re.fullmatch(r"```(?:json)?\s*(.*?)\s*```", raw.strip(), re.S | re.I)
    texts = [fence.group(1).strip()] if fence and fence.group(1) else list(_openings(raw.strip()))
    if not texts:
        return None, "no_json"
    error = "invalid_json"
    for text in texts:
        try:
            value = json.loads(text)
        except (ValueError, RecursionError):
            continue
        options = [value, *value] if isinstance(value, list) else [value]
        for option in options:
            if isinstance(option, dict) and all(k in option and _fits(option[k], kind) for k, kind in fields.items()):
                return {k: option[k] for k in fields}, None
            error = "schema"
    return None, error


def validate_responses(responses: DataFrame, fields: dict[str, str] = CLASSIFICATION_FIELDS) -> DataFrame:
    """``id, value, error`` for answers ``id, raw``: the first JSON text (or array element) that satisfies the fields.

    Answers that are one JSON object, bare or fenced, are read natively. Only the others (mixed prose, arrays,
    broken texts) go to Python, in Arrow batches.
    """
    ddl = ", ".join(f"{k}: {_DDL[kind]}" for k, kind in fields.items())
    fence = F.regexp_extract(tx.strip(F.col("raw")), r"(?is)^```(?:json)?\s*(.*?)\s*```$", 1)
    plain = F.coalesce(tx.null_if_blank(tx.strip(fence)), tx.strip(F.col("raw")))
    df = tx.settle(tx.settle(responses, {"_text": plain}), {"_v": F.try_parse_json("_text"), "_text": F.col("_text")})
    ok = F.lit(True)
    for name, kind in fields.items():
        typed = F.try_variant_get("_v", f"$.{name}", _DDL["text"] if kind == "text" else _DDL[kind])
        shape = F.schema_of_variant(F.try_variant_get("_v", f"$.{name}", "variant"))
        if kind == "score":
            good = shape.startswith("BIGINT") & typed.between(0, 100)
        elif kind == "bool":
            good = shape == "BOOLEAN"
        elif kind == "texts":
            good = shape.isin("ARRAY<STRING>", "ARRAY<VOID>")
        else:
            good = (shape == "STRING") & (typed != "")
        ok = ok & F.coalesce(good, F.lit(False))
    df = tx.settle(df, {"_ok": F.col("_text").startswith("{") & ok})
    value = F.from_json("_text", f"struct<{ddl}>")
    native = df.filter("_ok").select("id", value.alias("value"), F.lit(None).cast("string").alias("error"))
    id_type = responses.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [_read_answer(raw, fields) for raw in batch["raw"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "json": [json.dumps(v, ensure_ascii=False) if v is not None else None for v, _ in answers],
                    "error": [e for _, e in answers],
                }
            )

    slow = df.filter("not _ok").select("id", "raw").mapInPandas(read, f"id {id_type}, json string, error string")
    slow = slow.select("id", F.from_json("json", f"struct<{ddl}>").alias("value"), "error")
    return native.unionByName(slow)
