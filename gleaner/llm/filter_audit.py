"""Interaction of filters: what each removes under every order they can be applied in.

One pass over the texts gives each document a mask, one bit per filter that it fails. Documents that share a part and a mask are alike,
so they are counted into cells. A recursive query then extends prefixes of filters, from the empty one, by each letter not used yet; it
joins the cells' masks and carries the bits applied so far, and each level of the recursion emits what its step does to every mask:
removed, kept, or failing but removed before. Which masks there are is bounded by the filters (32 for five), so the recursion has the
same size for any table and any number of parts; its steps meet the counts of the cells in one join, which goes to all tasks.

A copy is a text with a smaller id of the same text anywhere; texts are compared by their SHA-256 digest, reduced to one row per
digest before anything is joined.

Defined cases: a null text counts as empty; a null source is the part of the empty string; a null id counts as smaller than all others
and has no labels; rows repeated with the same id and text each count and are no copies of each other; of several labels of an id one
that applies is enough; null labels do not apply; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import documents, id_key, settle, whole_text

LETTERS = "ABCDE"
BLANKS = r"[\x20\x09-\x0D]+"


def text_failures(text: Column) -> Column:
    """Bits of filters A to D: few words, repeated words, capitals, odd characters."""
    words = F.filter(F.split(text, BLANKS, -1), lambda w: w != "")
    n = F.size(words)
    failures = [n < 50, 100 * F.size(F.array_distinct(words)) < 65 * n, 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failures)), F.lit(0))


def failure_masks(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """One row per document: part, mask, good, toxic."""
    marks = settle(
        docs.select(
            id_key(F.col(id_column).cast("bigint")).alias("doc_id"), F.coalesce(F.col(part_column), F.lit("")).alias("part"),
            text_failures(whole_text(text_column)).alias("mask"), F.unhex(F.sha2(whole_text(text_column), 256)).alias("digest"),
        ),
        "filter-marks",
    )
    least, most = F.min("doc_id"), F.max("doc_id")
    shared = marks.groupBy("digest").agg(least.alias("first"), most.alias("last")).where("first < last").select("digest", "first")
    shared = settle(shared, "filter-shared")  # one digest may hold a third of the rows: two plain scans, which adaptive execution splits
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return marks.join(shared, "digest", "left").join(known.where("good OR toxic"), "doc_id", "left").select(
        "part", (F.col("mask") + F.when(copy, 1 << LETTERS.index("E")).otherwise(0)).alias("mask"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def mask_cells(masks: DataFrame) -> DataFrame:
    """Documents counted by part and mask: n, good, toxic."""
    return masks.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def prefix_steps(spark: SparkSession, letters: str = LETTERS) -> DataFrame:
    """Every prefix of filters and every mask: prefix, letter, step, mask, and whether the step removes such documents (removed),
    keeps them (kept), or finds them failing but gone (redundant)."""
    bits = ", ".join(f"('{c}', {1 << i})" for i, c in enumerate(letters))
    return spark.sql(f"""
        WITH RECURSIVE
        filters (letter, bit) AS (VALUES {bits}),
        masks (mask) AS (SELECT CAST(id AS INT) FROM range({1 << len(letters)})),
        steps (prefix, letter, step, applied, mask, removed, kept, redundant) AS (
            SELECT '', '', 0, 0, mask, false, true, false FROM masks
            UNION ALL
            SELECT concat(s.prefix, f.letter), f.letter, s.step + 1, s.applied | f.bit, s.mask,
                   s.kept AND (s.mask & f.bit) <> 0, s.kept AND (s.mask & f.bit) = 0, NOT s.kept AND (s.mask & f.bit) <> 0
            FROM steps s JOIN filters f ON (s.applied & f.bit) = 0
        )
        SELECT prefix, letter, step, mask, removed, kept, redundant FROM steps WHERE step > 0
    """)


def audit_orders(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step; see the module for the columns."""
    spark = cells.sparkSession
    steps = settle(prefix_steps(spark, letters), "filter-steps")
    n, bit = F.col("n"), F.expr(" ".join(["CASE letter", *(f"WHEN '{c}' THEN {1 << i}" for i, c in enumerate(letters)), "END"]))
    total = lambda when, what=n: F.sum(F.when(when, what).otherwise(0))
    # The steps are bounded by the filters (325 prefixes times 32 masks for five), whatever the tables hold.
    measured = cells.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "letter", "step").agg(
        total(F.col("kept")).alias("kept"), total(F.col("removed")).alias("removed"), total(F.col("redundant")).alias("redundant"),
        total(F.col("mask") == bit).alias("unique_fails"),
        total(F.col("removed"), F.col("good")).alias("good_lost"), total(F.col("removed"), F.col("toxic")).alias("toxic_lost"),
    )
    # A prefix of k letters begins (letters - k)! orders; what it removes counts in each of them.
    orders = steps.where(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
    at = F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("at")
    members = orders.select("filter_order", at).select("filter_order", F.expr("substring(filter_order, 1, at)").alias("prefix"))
    begun = members.groupBy("prefix").agg(F.count("*").alias("orders"))
    shares = measured.join(F.broadcast(begun), "prefix").groupBy("part", "letter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    return measured.join(shares, ["part", "letter"]).join(F.broadcast(members), "prefix").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    masks = failure_masks(documents(spark, folder).select("doc_id", "text", "source"), spark.read.parquet(f"{folder}/labels.parquet"))
    return audit_orders(settle(mask_cells(masks), "mask-cells"))


OP13_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents),
y AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS g, max(coalesce(toxic = 1, false)) AS x FROM labels GROUP BY doc_id),
m AS (SELECT part, [len(l) < 50, 100 * len(list_distinct(l)) < 65 * len(l), 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t),
             regexp_matches(t, '[#$%&*|]'), w.doc_id > min(w.doc_id) OVER (PARTITION BY t)] AS f,
             coalesce(g, false) AS g, coalesce(x, false) AS x FROM w LEFT JOIN y ON w.doc_id = y.doc_id),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (g) AS g, count(*) FILTER (x) AS x FROM m GROUP BY part, f),
d AS (SELECT i, chr(CAST(64 + i AS INTEGER)) AS letter FROM range(1, 6) AS r(i)),
o AS (SELECT a.letter || b.letter || p.letter || q.letter || e.letter AS filter_order, [a.i, b.i, p.i, q.i, e.i] AS s
      FROM d a, d b, d p, d q, d e WHERE len(list_distinct([a.i, b.i, p.i, q.i, e.i])) = 5),
k AS (SELECT part, filter_order, step, s[step] AS i, n, g, x, f[s[step]] AS fails, len(list_filter(f, lambda v: v)) AS failures,
             coalesce(list_max([CASE WHEN f[j] THEN 1 ELSE 0 END FOR j IN s[1:step - 1]]), 0) = 1 AS gone
      FROM c, o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) z),
r AS (SELECT part, filter_order, step, i, sum(CASE WHEN gone OR fails THEN 0 ELSE n END) AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails AND failures = 1 THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fails AND NOT gone THEN g ELSE 0 END) AS good_lost, sum(CASE WHEN fails AND NOT gone THEN x ELSE 0 END) AS toxic_lost
      FROM k GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, i) AS BIGINT) AS shapley
FROM r
"""
