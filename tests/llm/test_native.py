"""Mixing, exact dedup and line dedup."""

import collections
import hashlib
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from gleaner.llm import mixing
from gleaner.llm.common import scratch
from gleaner.llm.exact_dedup import DigestIndex
from gleaner.llm.line_dedup import drop_repeated_lines
from gleaner.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = collections.Counter(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())
    assert collections.Counter(tuple(r[c] for c in columns) for r in df.collect()) == want


def test_native_plans_hold_no_python(spark):
    for name in ("op1_mix_sources", "op9_line_dedup"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


def index(spark):
    return DigestIndex(spark, scratch(spark, "test-index"), buckets=4)


def test_exact_dedup_odd_rows(spark, odd_docs, no_docs):
    rows = index(spark).dedup(odd_docs, "one").collect()
    assert len(rows) == odd_docs.count()
    same = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"alpha beta gamma delta").hexdigest()]
    assert {r["keep_id"] for r in same} == {2} and {r["group_size"] for r in same} == {4}
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["kept"]) for r in same) == [(False, 1, False), (False, 2, True), (False, 2, True), (True, 0, False)]
    blank = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert {r["keep_id"] for r in blank} == {4} and len(blank) == 3
    kept = index(spark).drop_copies(odd_docs, "one")
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert index(spark).dedup(no_docs, "one").count() == 0


def test_exact_dedup_later_batches(spark):
    held = index(spark)
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    held.dedup(make([(1, "a"), (2, "b"), (5, "a")]), "one").collect()
    second = {r["doc_id"]: r for r in held.dedup(make([(9, "a"), (10, "c"), (11, "c")]), "two").collect()}
    assert (second[9]["keep_id"], second[9]["kept"]) == (5, False)
    assert (second[10]["kept"], second[11]["kept"], second[10]["keep_id"]) == (False, True, 11)
    assert held.rows().count() == 3
    again = {r["doc_id"]: r for r in held.dedup(make([(9, "a"), (10, "c"), (11, "c")]), "two").collect()}
    assert again == second and held.rows().count() == 3
    reopened = DigestIndex(spark, held_path(spark, held), buckets=4)
    assert reopened.rows().count() == 3


def held_path(spark, held):
    location = spark.sql(f"DESCRIBE FORMATTED {held.table}").where("col_name = 'Location'").first()["data_type"]
    return location.rsplit("/digests-", 1)[0]


def test_anti_join_reads_the_index_unshuffled(spark):
    held = index(spark)
    held.dedup(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "one").collect()
    other = spark.createDataFrame([(1, "a")], "doc_id long, text string").select(F.unhex(F.sha2("text", 256)).alias("digest")).groupBy("digest").count()
    plan = other.join(held.rows().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan


def line_dedup_by_hand(docs):
    seen, out = set(), {}
    for doc, text in sorted(docs):
        lines = text.split("\n")
        spans = [tuple(lines[i : i + 3]) for i in range(len(lines) - 2)]
        covered = set()
        for i, s in enumerate(spans):
            if s in seen:
                covered |= {i, i + 1, i + 2}
            seen.add(s)
        out[doc] = ("\n".join(x for i, x in enumerate(lines) if i not in covered), len(lines), len(covered))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_line_dedup_against_a_loop(spark, seed):
    rng = random.Random(seed)
    docs = [(i, "\n".join(rng.choice("abc") if rng.random() < 0.7 else str(rng.random()) for _ in range(rng.randint(1, 25)))) for i in range(60)]
    got = drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in got} == line_dedup_by_hand(docs)


def test_line_dedup_odd_rows(spark, odd_docs, no_docs):
    df = drop_repeated_lines(odd_docs)
    assert df.columns == [*odd_docs.columns, "n_lines_", "n_removed"]
    rows = df.collect()
    assert len(rows) == odd_docs.count()
    text = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] not in (None, 2, 9)}
    assert text[3] is None and text[4] == "" and text[8] == "one\ntwo\nthree\nfour" and text[6] == ""
    assert [r["text"] for r in rows if r["doc_id"] == 9 and r["text"].startswith("zero")] == ["zero"]
    assert text[5].count("\n") == 1  # the blank window first starts at line 1; its repeats cover lines 2 to 50
    assert drop_repeated_lines(no_docs).count() == 0


def test_mixing_counts_follow_the_inverse(spark):
    docs = spark.createDataFrame([(i, "x" * 10, "s") for i in range(3000)], "doc_id long, text string, source string")
    for rate in (0.3, 2.5, 40.0):
        rows = mixing.mix(docs, total=rate * 30_000).groupBy("doc_id").count().collect()
        n = {r["doc_id"]: r["count"] for r in rows}
        parts = max(1, math.ceil(rate / mixing.PART))

        def draw(i, parts=parts, rate=rate):
            total = 0
            for j in range(1, parts + 1):
                u = int(hashlib.md5(f"17:{i}:{j}".encode()).hexdigest()[:13], 16) / 2**52
                p = cdf = math.exp(-rate / parts)
                k = 0
                while cdf <= u:
                    k += 1
                    p *= rate / parts / k
                    cdf += p
                total += k
            return total

        assert {i: draw(i) for i in range(3000) if draw(i)} == n
        assert abs(sum(n.values()) / 3000 - rate) < 5 * math.sqrt(rate / 3000)


def test_mixing_reaches_weights(spark):
    docs = spark.createDataFrame([(i, "y" * 20, "big" if i % 10 else "small") for i in range(6000)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("big", 1.0), ("small", 1.0), ("absent", 2.0)], "source string, weight double")
    out = mixing.mix(docs, weights, total=120_000.0).groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()
    assert {r["source"] for r in out} == {"big", "small"} and all(abs(r["n"] - 60_000) < 6000 for r in out)


def test_mixing_odd_rows(spark, odd_docs, no_docs):
    df = mixing.mix(odd_docs, total=10_000_000.0)
    assert df.columns == [*odd_docs.columns, "copy_"]
    counts = {(r["doc_id"], r["text"]): r["count"] for r in df.groupBy("doc_id", "text").count().collect()}
    assert (5, odd_docs.where("doc_id = 5").first()["text"]) in counts  # the null source is a source
    assert not any(k[0] == 7 and k[1] == "" for k in counts)
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mix(odd_docs, spark.createDataFrame([("a", None), ("b", -1.0)], "source string, weight double")).count() == 0
