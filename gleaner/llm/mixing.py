"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

A source with weight w (of 1) that holds s characters is repeated at rate total * w / s. Each document's number of copies inverts a
Poisson distribution of that mean at a uniform number made from a hash of seed and id; documents are exploded by it and shuffled
globally by a hash. Means above ``PART`` are drawn as sums of equal independent parts, so any rate is exact and no table of
probabilities grows with the rate.

Defined cases: a null source is a source of its own; a source without characters, without a weight or with a null or negative one is
left out; a null id hashes as empty text; repeated rows (same id) get equal counts; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import documents, fresh, settle, whole_text

PART = 16.0
#: Terms kept of a distribution of mean PART or less; what is left beyond them is below 1e-40.
TERMS = 96


def source_rates(docs: DataFrame, weights: DataFrame | None, total: float | None, exponent: float, source: str, text: str) -> DataFrame:
    """One row per source: source, rate, parts, and the cumulative probabilities of Poisson(rate / parts)."""
    sizes = settle(docs.groupBy(F.col(source).alias("source")).agg(F.sum(F.length(whole_text(text))).cast("double").alias("size")), "source-sizes")
    if weights is None:
        sized = sizes.withColumn("weight", F.pow("size", F.lit(exponent)))
    else:
        given = weights.select(F.col("source").alias("given"), F.col("weight").cast("double").alias("weight"))
        sized = sizes.join(given, F.col("source").eqNullSafe(F.col("given"))).drop("given")
    sized = settle(sized.where("size > 0 AND weight > 0"), "source-weights")
    sums = sized.agg(F.sum("weight").alias("weight"))
    goal = F.lit(float(total)) if total is not None else sizes.agg(F.sum("size").alias("size")).scalar()
    rates = sized.select("source", (goal * (F.col("weight") / sums.scalar()) / F.col("size")).alias("rate"))
    rates = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART).cast("int")))
    mean, none = F.col("rate") / F.col("parts"), F.exp(-F.col("rate") / F.col("parts"))
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(none.alias("p"), none.alias("sum"), F.array(none).alias("cdf")),
        lambda a, k: F.struct(
            (a["p"] * mean / k).alias("p"), (a["sum"] + a["p"] * mean / k).alias("sum"), F.concat(a["cdf"], F.array(a["sum"] + a["p"] * mean / k)).alias("cdf")
        ),
    )
    return settle(rates.select("source", "rate", "parts", steps["cdf"].alias("cdf")), "source-rates")


def uniform(seed: int, id_column: Column, part: Column) -> Column:
    """A number in [0, 1) of 52 bits from the MD5 of "seed:id:part"."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_column.cast("string"), F.lit("")), part.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)


def mix(
    docs: DataFrame, weights: DataFrame | None = None, total: float | None = None, exponent: float = 0.5, seed: int = 17,
    id_column: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """Documents repeated by their drawn counts, in global random order, with the number of the copy (from 1) in ``copy``.

    ``weights`` (source, weight) need not add up to one; without it a source weighs its characters to the power of ``exponent``.
    ``total`` characters are aimed at, by default as many as there are.
    """
    columns = docs.columns
    copy, order = fresh(columns, "copy"), fresh(columns, "__order")
    name, parts, cdf, n = (fresh(columns, c) for c in ("__source", "__parts", "__cdf", "__n"))
    rates = source_rates(docs, weights, total, exponent, source, text).select(F.col("source").alias(name), F.col("parts").alias(parts), F.col("cdf").alias(cdf))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col(parts)), F.lit(0),
        lambda acc, j: acc + F.size(F.filter(F.col(cdf), lambda c: c <= uniform(seed, F.col(id_column), j))),
    )
    counted = docs.join(rates, F.col(source).eqNullSafe(F.col(name))).withColumn(n, drawn).where(F.col(n) > 0)
    copies = counted.select(*[F.col(f"`{c}`") for c in columns], F.explode(F.sequence(F.lit(1), F.col(n))).alias(copy))
    copies = copies.withColumn(order, F.xxhash64(F.lit(seed), F.col(id_column), F.col(copy), F.col(text)))
    return copies.repartition(order).sortWithinPartitions(order).drop(order)


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang", "source")
    return mix(docs)


OP1_SQL = f"""
WITH RECURSIVE s AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS size FROM documents GROUP BY source),
r AS (SELECT source, (SELECT sum(size) FROM s) * (sqrt(size) / (SELECT sum(sqrt(size)) FROM s WHERE size > 0)) / size AS rate FROM s WHERE size > 0),
q AS (SELECT source, rate, greatest(1, ceil(rate / {PART}))::INT AS parts FROM r),
c AS (SELECT source, 0 AS k, rate / parts AS mean, exp(-rate / parts) AS p, exp(-rate / parts) AS cdf FROM q
      UNION ALL SELECT source, k + 1, mean, p * mean / (k + 1), cdf + p * mean / (k + 1) FROM c WHERE k < {TERMS}),
u AS (SELECT doc_id, text, lang, d.source, ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || j), 1, 13))::BIGINT::DOUBLE / {2**52}::DOUBLE AS u,
             d.rowid AS row
      FROM (SELECT *, row_number() OVER () AS rowid FROM documents) d JOIN q ON d.source IS NOT DISTINCT FROM q.source, unnest(generate_series(1, parts)) AS t(j)),
n AS (SELECT row, any_value(doc_id) AS doc_id, any_value(text) AS text, any_value(lang) AS lang, any_value(source) AS source,
             sum((SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND c.cdf <= u.u)) AS n FROM u GROUP BY row)
SELECT doc_id, text, lang, source, copy::INT AS copy FROM n, unnest(generate_series(1, n::BIGINT)) AS t(copy)
"""
