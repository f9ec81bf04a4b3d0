"""Exact set-similarity self-join on Jaccard, by prefix and position filters and sketches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import settle
from gleaner.session import cut_lineage, written


#: A token that more sets have among their rarest ones is frequent.
FREQUENT = 20_000
#: Numbers of 64 bits in the sketch of a set and of the other set it stands for, and pairs that a task looks at together.
SKETCH, OTHER, TOGETHER = 4, 2, 1_000_000


def sketch(tokens: Column, words: int) -> Column:
    """``words`` numbers of 64 bits; each token turns one bit over. Two sets differ in at least as many tokens as their sketches in bits."""
    bits = F.transform(tokens, lambda x: F.pmod(F.xxhash64(x), F.lit(64 * words)).cast("int"))

    def turned(word: int) -> Column:
        def turn(held: Column, bit: Column) -> Column:
            own = (bit >= 64 * word) & (bit < 64 * (word + 1))
            return F.when(own, held.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))).otherwise(held)

        return F.aggregate(bits, F.lit(0).cast("bigint"), turn)

    return F.array(*[turned(word) for word in range(words)])


def most_common(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """No more tokens than these can be common to sets of n and m tokens with the sketches a and b."""
    apart = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return np.minimum((n + m - apart) // 2, np.minimum(n, m))


def whole_groups(batches: Iterator[pa.RecordBatch], on: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches of rows that are sorted by ``on``, cut anew so that no group is divided; with them the number of each row's group."""

    def numbered(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        for name in on:
            column = table[name].combine_chunks()
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        return np.cumsum(new)

    held, rows, limit = [], 0, 1
    for batch in batches:
        held, rows = [*held, batch], rows + batch.num_rows
        if rows < limit:
            continue
        table = pa.Table.from_batches(held)
        groups = numbered(table)
        cut = int(np.searchsorted(groups, groups[-1])) if rows else 0
        if cut:
            yield table.slice(0, cut).combine_chunks(), groups[:cut]
        held, rows = table.slice(cut).to_batches(), rows - cut
        # a group over many batches is not looked through again for each of them
        limit = 2 * rows if not cut else rows + 1
    if rows:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, numbered(table)


def _words(column: pa.ChunkedArray, words: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, words)


def _meet(threshold: float, on: list[str], least: Callable[[np.ndarray], np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of posts of one token, sorted by size, that may reach the threshold as far as sizes, places and sketches tell."""
    shape = pa.schema([("k", pa.int64()), ("k2", pa.int64())])

    def compare(table: pa.Table, groups: np.ndarray) -> Iterator[pa.RecordBatch]:
        k, n, p, size = (table[name].to_numpy().astype(np.int64) for name in ("k", "n", "p", "size"))
        asks, bits = table["asks"].to_numpy(zero_copy_only=False), _words(table["bits"], SKETCH)
        other = _words(table["other"], OTHER)
        at = groups * 2**32 + n
        end = np.searchsorted(at, groups * 2**32 + np.floor(n / threshold + 1e-9).astype(np.int64), side="right")
        partners = np.maximum(end - np.arange(len(k)) - 1, 0)
        total = np.concatenate([[0], np.cumsum(partners)])
        start = 0
        while start < len(k):
            stop = max(start + 1, int(np.searchsorted(total, total[start] + TOGETHER, side="right")) - 1)
            some = partners[start:stop]
            i = np.repeat(np.arange(start, stop), some)
            j = np.arange(len(i)) - np.repeat(total[start:stop] - total[start], some) + i + 1
            start = stop
            left = np.minimum(n[i] - p[i], n[j] - p[j])
            fit = (left >= np.ceil(threshold / (1 + threshold) * (n[i] + n[j]) - 1e-9)) & (k[i] != k[j]) & (asks[i] | asks[j])
            i, j, left = i[fit], j[fit], left[fit]
            common = np.minimum(left, most_common(bits[i], bits[j], n[i], n[j]))
            similarity = common / (n[i] + n[j] - common)
            fit = similarity >= threshold
            i, j, similarity = i[fit], j[fit], similarity[fit]
            common = most_common(other[i], other[j], size[i], size[j])
            beside = np.where((size[i] < 0) | (size[j] < 0), 1.0, common / np.maximum(size[i] + size[j] - common, 1))
            fit = beside >= least(similarity)
            a, b = k[i[fit]], k[j[fit]]
            if len(a):
                yield pa.record_batch([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], schema=shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, groups in whole_groups(batches, on):
            yield from compare(table, groups)

    return run


def ordered_tokens(rows: DataFrame, frequency: DataFrame) -> DataFrame:
    """``k, n, p, token`` of rows ``k, s``: places from the rarest token on, for tokens that ``frequency`` (token, f) knows.

    Unknown ones keep their places in front, but meet nothing.
    """
    ordered = (
        rows.select("k", F.explode("s").alias("token")).join(frequency, "token", "left").groupBy("k")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "token"))).alias("s"))
    )
    return ordered.select("k", F.size("s").alias("n"), F.posexplode("s").alias("p", "x")).filter("x.f > 0").select("k", "n", "p", F.col("x.token").alias("token"), F.col("x.f").alias("f"))


def prefix_length(n: Column, threshold: Column | float) -> Column:
    """Of two sets that reach the threshold, each has a common token among so many of its rarest."""
    return n - F.ceil(n * threshold - 1e-9).cast("int") + 1


def narrowed(posts: DataFrame, also: DataFrame) -> DataFrame:
    """Posts (k, n, p, ...), one for each token ``also`` of their set that can matter. ``also``: k, token, least.

    A pair is told by its first common token. Two sets that first meet at place p of n tokens have n - p common ones at most, so their
    similarity is (n - p) / n at most: the further back a token stands, the fewer of the other tokens it is met with.
    """
    also = also.select("k", F.col("token").alias("also"), "least")
    return posts.join(also, "k").filter((F.col("n") - F.col("p")) / F.col("n") >= F.col("least") - 1e-9).drop("least")


def similar_sets(
    sets: DataFrame, threshold: float, least: Callable[[np.ndarray], np.ndarray] = np.zeros_like, split: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Pairs of *distinct* sets that may reach the Jaccard ``threshold`` and matter: ``(left, right)``, each pair once.

    ``sets``: k (a number, unique), s (tokens without repeats), asks, size, other. Pairs of which neither set asks do not matter. A set that
    stands for one other set has its size and sketch here (else -1): a pair matters only if these can have the similarity that ``least``
    gives for an upper bound of the pair's own. Such pairs are left out where sketches tell so; none that matters is.

    With tokens ordered from the rarest, two sets that reach the threshold share a token among the first ``n - ceil(t * n) + 1`` of each. A
    set posts only those, once each, with its sketches and without its tokens: what is moved grows with the sets' sizes. Where two
    sets first meet, at places p and q, at most ``1 + min(n - p - 1, m - q - 1)`` tokens can be common. The posts of a token meet in one task,
    which gives the few pairs that sizes, places and sketches leave. No set is fetched: see :func:`compared`.

    ``split`` names something else that two sets must share to matter: it gets the keys ``k`` of sets that post a token which more than
    ``FREQUENT`` sets post, and gives ``k, token, least``, where ``least`` is the similarity from which sets that share the token matter. Such
    tokens are then met only together with one of those, so sets from one template do not all meet; pairs that share none may be missing.
    """
    spark = sets.sparkSession
    rows = sets.filter(F.size("s") > 0)
    words = rows.select("k", F.explode("s").alias("token"))
    frequency = cut_lineage(words.groupBy("token").agg(F.count("*").alias("f")).filter("f > 1").withColumn("t", F.monotonically_increasing_id()))
    # a token of one set alone meets nothing and comes first in the order, so the others' places are counted from the end
    ordered = words.join(frequency, "token").groupBy("k").agg(F.sort_array(F.collect_list(F.struct("f", "t"))).alias("x"))
    sizes = rows.select("k", F.size("s").alias("n"), "asks", "size", "other", sketch(F.col("s"), SKETCH).alias("bits"))
    sizes = written(sizes)
    first = F.col("n") - F.size("x")
    posted = prefix_length(F.col("n"), threshold) - first
    ordered = ordered.join(sizes.select("k", "n"), "k").filter(posted > 0)
    ordered = ordered.select("k", first.alias("first"), F.posexplode(F.slice("x", 1, posted)).alias("at", "x"))
    posts = written(ordered.select("k", (F.col("first") + F.col("at")).alias("p"), F.col("x.t").alias("token")), "zstd")
    frequent = posts.groupBy("token").agg(F.count("*").alias("c")).filter(F.col("c") > FREQUENT).select("token")
    on = ["token"]
    if split is not None and not (frequent := cut_lineage(frequent)).isEmpty():
        often = posts.join(frequent, "token").join(sizes.select("k", "n"), "k")
        often = narrowed(often, split(often.select("k").distinct())).drop("n")
        posts, on = posts.join(frequent, "token", "left_anti").withColumn("also", F.lit("")).unionByName(often), ["token", "also"]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # few bytes, much work: a plain shuffle would be merged into one task
    met = posts.join(sizes, "k").repartition(width, *on).sortWithinPartitions(*on, "n")
    near = met.mapInArrow(_meet(threshold, on, least), "k bigint, k2 bigint").distinct()
    return near.select(F.col("k").alias("left"), F.col("k2").alias("right"))


def compared(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs ``left, right`` that reach the threshold, with their ``similarity``. Both sets travel with each pair."""
    left, right = (sets.select(F.col("k").alias(side), F.col("s").alias(f"{side}_set")) for side in ("left", "right"))
    both = settle(pairs.join(left, "left").join(right, "right"), {"common": F.size(F.array_intersect("left_set", "right_set"))})
    sizes = F.size("left_set") + F.size("right_set")
    return both.select("left", "right", (F.col("common") / (sizes - F.col("common"))).alias("similarity")).filter(F.col("similarity") >= threshold)
