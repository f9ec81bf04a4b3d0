"""Texts are scored once per query, and only as far as a result can depend on them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import text as tx
from gleaner.operators import selection as sl
from gleaner.plans import catalog  # noqa: F401
from gleaner.plans import curation_queries as cq
from gleaner.plans.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
ODD = [
    "", " \t\n", "plain text of words", "a\r\n\r\nb \r\n  c\x0b　d", " ﻿lead  and  tail \n\n", "x" * 700, "ab " * 700, "one line " * 90 + "\r\nrest  of\tit " * 90,
    "\n \n" * 400 + "late\n" + "y　" * 700, "😀 é" * 500, "产线变化很快。" * 200, " \r" * 50 + "z",
]


@pytest.mark.parametrize("name", ["official_sources", "group_winner", "article_outcomes", "validate_articles", "weekly_digest", "platform_packages", "weekly_markdown"])
def test_documents_are_scored_once(spark, name):
    """``leaux`` is one of the patterns that scoring looks for."""
    assert "leaux" not in QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["selection_audit", "run_totals"])
def test_audit_branches_read_columns(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan


def test_sentences_are_found_once(spark):
    df = QUERIES["spans_by_position"](spark, SMALL)
    assert "regexp_extract_all" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_heads_settle_what_clamped_texts_need(spark):
    c = F.col("c")
    lines = tx.content_lines(tx.line_head(c, 300))
    rows = spark.createDataFrame([(t,) for t in [*ODD, None]], "c string").select(
        F.substring(tx.collapse(c), 1, 250).alias("a1"), F.substring(tx.collapse(tx.head(c, 300)), 1, 250).alias("a2"),
        (F.length(tx.collapse(c)) > 220).alias("b1"), (F.length(tx.collapse(tx.head(c, 300))) > 220).alias("b2"),
        tx.first_line(c).alias("c1"), F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit("")).alias("c2"),
        tx.clamp(tx.rest_lines(c), 180).alias("d1"), tx.clamp(F.array_join(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), " "), 180).alias("d2"),
    )
    for row in rows.collect():
        assert [row.a1, row.b1, row.c1, row.d1] == [row.a2, row.b2, row.c2, row.d2]


def test_trace_in_parts_is_the_trace_of_the_whole(spark):
    """Words cut by the first part, letters that become ASCII when lower-cased, words that are a suffix, claims proved at the very end."""
    edge = "w " * (sl.EVIDENCE_HEAD // 2 - 2)
    texts = [edge + "Kelvins dogs", edge + "processing", "e" * 3000 + " processing", "processing " + edge, edge * 3 + "late processing", "s ed es ing", *ODD, "变化" + edge]
    claims = ["kelvin process", "k process", "Processing dogs process process", "late ghost", "ghosts", "产线变化", ""]
    frame = spark.createDataFrame([(t, q) for t in texts for q in claims], "raw_content string, claim string")
    blank = {n: F.lit("") for n in ("summary", "intro_summary", "source_name", "category", "source_url")}
    frame = frame.withColumns({**blank, **{n: F.array().cast("array<string>") for n in ("official_sources", "keywords", "ai_tags", "game_tags")}})
    claim = tx.claim_tokens(F.col("claim"), fv.SELECTION_STOP_WORDS)
    known = F.array_distinct(tx.without(tx.stem_tokens(sl.evidence_text()), fv.SELECTION_STOP_WORDS))
    whole = F.coalesce(F.size(F.filter(claim, lambda t: F.array_contains(known, t))) / F.nullif(F.size(claim), F.lit(0)) >= 0.5, F.lit(False))
    rows = frame.select("claim", "raw_content", whole.alias("whole"), sl.claims_trace(F.col("claim")).alias("parts")).collect()
    assert {r.whole for r in rows} == {True, False}
    assert [r for r in rows if r.whole != r.parts] == []


@pytest.mark.parametrize("name", ["official_sources", "group_winner"])
def test_groups_are_scored_without_what_they_drop(spark, monkeypatch, name):
    """``license`` is looked for in news values, ``_low`` is a flag of classified items, ``keywords`` a text of described ones."""
    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    monkeypatch.setattr(cq, "written", watched)
    QUERIES[name](spark, SMALL)
    assert plans and "leaux" in plans[0] and not [x for x in ("license", "_low", "keywords") if x in plans[0]]


def test_only_selected_rows_are_described(spark, monkeypatch):
    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    monkeypatch.setattr(cq, "cut_lineage", watched)
    cq.top(spark, SMALL)
    lines = plans[0].splitlines()  # from the last step to the first
    described = [i for i, line in enumerate(lines) if "Generate" in line and "struct(summary," in line]
    assert described and max(described) < min(i for i, line in enumerate(lines) if "Window " in line)
