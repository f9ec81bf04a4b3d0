"""Optimal length buckets and token-budget batches.

The global histogram of lengths (one row per distinct length, exact at every size) goes to the driver, where dynamic programming places
the bucket boundaries at the least total padding. It cannot grow without bound: d distinct lengths need at least d * d / 2 tokens, so
20 trillion tokens have at most 6.4 million of them, 24 bytes each. The cost satisfies the quadrangle inequality, so the best
previous boundary never moves back; each level of the programme is solved for all lengths of one stride at a time, between the answers
of the stride above. Documents of a bucket are numbered by a hash, shard by shard with running offsets, and every
``budget // bucket length`` of them form a batch.

Defined cases: a null text has length 1 (its end mark); a document longer than the budget is a batch of its own; with fewer distinct
lengths than buckets each length is a bucket; repeated rows are packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import documents, settle, whole_text

SHARD_ROWS = 50_000
BUCKETS = 16
BUDGET = 65_536


def words_and_end(column: str = "text") -> Column:
    """Words separated by ASCII white space, and one end mark."""
    return F.regexp_count(whole_text(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint") + 1


def length_histogram(lengths: DataFrame) -> DataFrame:
    """length, n, total: one row per distinct length."""
    return lengths.groupBy("length").agg(F.count("*").alias("n"), F.sum("length").alias("total"))


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of the ranges, end to end, and where each range starts. No range is empty."""
    sizes = last - first + 1
    starts = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(first - starts, sizes), starts


def _one_more(best: np.ndarray, level: int, cost: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Least cost with one bucket more than ``best`` for every last length, and the last length of the bucket before."""
    n = len(best)
    following, choice = np.full(n, np.inf), np.full(n, level - 1, dtype=np.int32)
    stride = 1 << (n.bit_length() - 1)
    while stride:
        at = np.arange(stride - 1, n, 2 * stride)
        at = at[at >= level]
        if len(at):
            first = np.where(at >= stride, choice[np.maximum(at - stride, 0)], level - 1).astype(np.int64)
            above = np.where(at + stride < n, choice[np.minimum(at + stride, n - 1)], n - 2)
            last = np.maximum(np.minimum(above, at - 1), first)
            tries, starts = _ranges(first, last)
            costs = best[tries] + cost(tries, np.repeat(at, last - first + 1))
            least = np.minimum.reduceat(costs, starts)
            hits = np.flatnonzero(costs == np.repeat(least, last - first + 1))
            following[at] = least
            choice[at] = tries[hits[np.searchsorted(hits, starts)]]
        stride //= 2
    return following, choice


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int) -> list[int]:
    """Ascending bucket lengths, at most ``buckets``, with the least padding. Inputs are ascending by length."""
    n = len(lengths)
    if n <= buckets:
        return [int(x) for x in lengths]
    c, s = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64), np.concatenate([[0], np.cumsum(totals)]).astype(np.float64)
    top = lengths.astype(np.float64)
    best, choices = top * c[1:] - s[1:], []
    for level in range(1, buckets):
        best, choice = _one_more(best, level, lambda i, j: top[j] * (c[j + 1] - c[i + 1]) - (s[j + 1] - s[i + 1]))
        choices.append(choice)
    bounds, at = [n - 1], n - 1
    for choice in reversed(choices):
        at = int(choice[at])
        bounds.append(at)
    return [int(lengths[i]) for i in reversed(bounds)]


def pack(
    docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, length: Column | None = None, seed: int = 23,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket (from 0), bucket_length, batch (in its bucket), slot (in its batch), padding."""
    # Text is read once; everything after works on this narrow table. The text's hash deals out rows that share an id, or have none.
    narrow = [F.col(id_column).alias("doc_id"), (words_and_end(text_column) if length is None else length).alias("length"), F.xxhash64(text_column).alias("text_hash")]
    lengths = settle(docs.select(*narrow), "lengths")
    table = length_histogram(lengths).orderBy("length").toArrow()
    histogram = np.stack([table.column(name).to_numpy() for name in ("length", "n", "total")], axis=1).astype(np.int64)
    bounds = optimal_bounds(histogram[:, 0], histogram[:, 1], histogram[:, 2], buckets)
    shards = 1 + int(histogram[:, 1].sum()) // SHARD_ROWS
    bucket = sum(((F.col("length") > b).cast("int") for b in bounds[:-1]), F.lit(0))
    dealt = lengths.select("*", bucket.alias("bucket"), F.xxhash64(F.lit(seed), "doc_id", "length", "text_hash").alias("h")).withColumn("shard", F.pmod("h", F.lit(shards)))
    sizes = dealt.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(sizes.select("bucket", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    place = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("h", "doc_id", "length"))
    numbered = dealt.withColumn("place", place).join(offsets, ["bucket", "shard"]).withColumn("at", F.col("offset") + F.col("place") - 1)
    bound = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in bounds or [1]]), F.col("bucket") + 1)
    capacity = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(budget) / F.col("bucket_length")))
    return numbered.withColumn("bucket_length", bound).select(
        "doc_id", F.col("length").alias("n_tokens"), "bucket", "bucket_length", F.floor(F.col("at") / capacity).alias("batch"),
        (F.col("at") % capacity).alias("slot"), (F.col("bucket_length") - F.col("length")).alias("padding"),
    )


def op4_pack(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder).select("doc_id", "text"))
