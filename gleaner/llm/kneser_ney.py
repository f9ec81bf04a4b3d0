"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

The model is fitted on whole texts of labelled documents of quality 1, the half of them whose id hashes to an even number; the other
half sets the thresholds. The query and the pipeline fit it on all of that half; ``classify`` takes at most ``train_docs`` of it if told
to. All its counts, discounts and probabilities are DataFrame aggregates and joins over words coded by a 64-bit hash. An interpolated model can be
written as a sum: log P(text) is the sum of one weight per word, per word pair and per word triple that the model holds (what a seen
n-gram adds to its back-off). So scoring is a join of each text's n-grams, each hashed to 63 bits, with the weights. The ``HOT`` most frequent n-grams travel to the
tasks, a Bloom filter of fixed size keeps back n-grams that the model does not hold, and the rest meets the weights in a join
sharded by n-gram. The counts of triples move once, to the shard of their middle word: sums over a pair's first or second place, and
over the words beside it, are then taken, and joined, where they are.

A document is kept when its perplexity is at most the threshold of its language: the median of the language's trusted documents
outside the sample, times a spread. The spread is that of the language's own ``QUANTILE`` over its median, drawn towards the spread
over all languages (each document relative to its language's median) by the weight of ``PRIOR`` documents, so that it changes
smoothly with their number. Only languages without such documents use the quantile over all languages.

Words are split at ASCII white space and keep their case. All words of the sample count, of any number and length; only words that it
lacks share one symbol. (With a ``vocabulary``, words beyond it share that symbol too, and its probability is divided among them.)

Defined cases: a null or blank text is one end symbol; a null language is a language of its own; a null id never counts as labelled;
a document labelled more than once is trusted if one label says so; repeated rows are judged alike; without trusted documents
everything is kept with a null threshold; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.class_lm import frequent_words, word_counts
from gleaner.llm.common import documents, fresh, id_key, settle, whole_text

TRAIN_DOCS, HOT = 6000, 1_000_000
BLOOM_BITS = 1 << 26
#: The spread over all languages counts as much as so many documents of a language.
QUANTILE, PRIOR = 0.99, 50
START, END, UNKNOWN = 0, 1, 2


def cased_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()


def word_codes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words)).view(np.int64)


def coded(texts: list[str | None], known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Two starts, the words and an end of every text, one after the other; and how many codes each text has. Words outside ``known``
    (sorted codes; None: all words are known) are UNKNOWN."""
    words = [cased_words(text) for text in texts]
    sizes = np.array([len(w) + 3 for w in words], dtype=np.int64)
    x = np.full(int(sizes.sum()), START, dtype=np.int64)
    ends = np.cumsum(sizes) - 1
    inner = np.ones(len(x), dtype=bool)
    inner[ends] = inner[ends - sizes + 1] = inner[ends - sizes + 2] = False
    codes = np.concatenate([np.zeros(0, dtype=np.int64), *(word_codes(w) for w in words)])
    x[inner] = codes if known is None else np.where(np.isin(codes, known), codes, UNKNOWN)
    x[ends] = END
    return x, sizes


def _hashed(x: np.ndarray, before: np.ndarray | int = 42) -> np.ndarray:
    """Spark's xxhash64 of a column of longs, continued from the hash of the columns before it."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda v, k: (v << np.uint64(k)) | (v >> np.uint64(64 - k))
    h = np.asarray(before, dtype=np.uint64) + (p5 + np.uint64(8)) ^ turn(x.view(np.uint64) * p2, 31) * p1
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def gram_keys(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the single codes, the pairs and the triples, by their first code."""
    one = _hashed(x)
    two = _hashed(x[1:], one[:-1])
    three = _hashed(x[2:], two[:-1])
    return tuple((h & np.uint64(2**63 - 1)).view(np.int64) for h in (one, two, three))


def gram_key(*columns: str) -> Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit(2**63 - 1)).alias("g")


def bucketed(df: DataFrame, shards: int, *columns: str) -> tuple[str, DataFrame]:
    """A table bucketed by the first column, and its name; what groups or joins it by that column and others shuffles nothing."""
    name = f"kneser_ney_{uuid.uuid4().hex}"
    df.write.bucketBy(shards, columns[0]).sortBy(*columns).option("compression", "zstd").saveAsTable(name)
    return name, df.sparkSession.table(name)


def trigram_counts(docs: DataFrame, known: np.ndarray | None, shards: int) -> DataFrame:
    """(a, b, c, n): triples of codes that do not end in a start, so each lies in one text; dealt out by b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                x, _ = coded(batch.column(0).slice(at, 500).to_pylist(), known)
                inside = np.flatnonzero(x[2:] != START)
                _, first, n = np.unique(gram_keys(x)[2][inside], return_index=True, return_counts=True)
                first = inside[first]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (x[first], x[first + 1], x[first + 2], n)], ["a", "b", "c", "n"])

    found = docs.select("text").mapInArrow(run, "a long, b long, c long, n long")
    return found.repartition(shards, "b").groupBy("a", "b", "c").agg(F.sum("n").alias("n"))


def discounts(table: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from the counts of counts."""
    held = {int(r["n"]): r["k"] for r in table.where("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
    n1, n2, n3, n4 = (held.get(i, 0) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]


def _discount(n: Column, d: list[float]) -> Column:
    return F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def _spared(d: list[float]) -> Column:
    return F.sum(_discount(F.col("n"), d))


def fit(docs: DataFrame, vocabulary: int | None = None) -> tuple[np.ndarray | None, tuple[float, float], DataFrame]:
    """The known codes (None: all words of the sample), the weights (log10) of a text's beginning and of an unknown word, and the table
    (g, weight, n) of single words, pairs and triples. A word's weight is what it has beyond an unknown one."""
    known, unseen = None, 1
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if vocabulary is not None:
        counts = settle(word_counts(docs, split=cased_words), "trusted-words")
        words = [w for w, _ in frequent_words(counts, vocabulary)]
        known, unseen = np.sort(word_codes(words)), max(0, counts.count() - 1 - len(words)) + 1
    three_table, three = bucketed(trigram_counts(docs, known, shards), shards, "b", "c", "a")
    # How many different words stand before a pair; a pair at a text's beginning has none and counts its occurrences.
    two = three.groupBy("b", "c").agg(F.count("*").alias("k"), F.sum("n").alias("s"))
    two_table, two = bucketed(two.select("b", "c", F.when(F.col("b") == START, F.col("s")).otherwise(F.col("k")).alias("n")), shards, "b", "c")
    one = settle(two.groupBy("c").agg(F.count("*").alias("n")), "singles")
    d1, d2, d3 = discounts(one), discounts(two), discounts(three)
    sums = one.agg(F.sum("n").alias("total"), _spared(d1).alias("spared"), F.count(F.when(~F.col("c").isin(END, UNKNOWN), 1)).alias("words")).first()
    total = sums["total"] or 1
    share = (sums["spared"] / total if sums["total"] else 1.0) / ((sums["words"] if known is None else len(known)) + 2)
    p1 = (F.col("n") - _discount(F.col("n"), d1)) / F.lit(float(total)) + F.lit(share)
    one = one.select("c", "n", p1.alias("p1"))
    seen_1 = two.groupBy("b").agg(F.sum("n").alias("sum"), _spared(d2).alias("spared"))
    seen_1 = seen_1.select("b", "sum", (F.col("spared") / F.col("sum")).alias("gamma"))
    pairs = two.join(one.select("c", "p1"), "c").repartition(shards, "b").join(seen_1, "b")
    p2 = (F.col("n") - _discount(F.col("n"), d2)) / F.col("sum") + F.col("gamma") * F.col("p1")
    pairs = pairs.select("b", "c", "n", p2.alias("p2"), (F.log10(p2) - F.log10("gamma") - F.log10("p1")).alias("gain"))
    pairs_table, pairs = bucketed(pairs, shards, "b", "c")
    seen_2 = three.groupBy("a", "b").agg(F.sum("n").alias("sum"), _spared(d3).alias("spared"))
    seen_2 = seen_2.select("a", "b", "sum", (F.col("spared") / F.col("sum")).alias("gamma"))
    p3 = (F.col("n") - _discount(F.col("n"), d3)) / F.col("sum") + F.col("gamma") * F.col("p2")
    triples = three.join(seen_2, ["a", "b"]).join(pairs.select("b", "c", "p2"), ["b", "c"])
    triples = triples.select(gram_key("a", "b", "c"), (F.log10(p3) - F.log10("gamma") - F.log10("p2")).alias("weight"), "n")
    # A pair's weight: what it gains as seen pair, and its back-off as context of the next word.
    as_context = seen_2.select(gram_key("a", "b"), F.log10("gamma").alias("weight"), F.col("sum").alias("n"))
    both = pairs.select(gram_key("b", "c"), F.col("gain").alias("weight"), "n").unionByName(as_context)
    pair_weights = both.groupBy("g").agg(F.sum("weight").alias("weight"), F.max("n").alias("n"))
    special = {r["b"]: r["gamma"] for r in seen_1.where(F.col("b").isin(START, UNKNOWN)).collect()}
    rare = one.where(F.col("c") == UNKNOWN).first()
    unknown = float(np.log10(rare["p1"] if rare else share) + np.log10(special.get(UNKNOWN, 1.0)) - np.log10(unseen))
    backs = seen_1.select(F.col("b").alias("c"), F.log10("gamma").alias("back"))
    single_weights = one.where(F.col("c") != UNKNOWN).join(backs, "c", "left")
    single_weights = single_weights.select(gram_key("c"), (F.log10("p1") + F.coalesce("back", F.lit(0.0)) - unknown).alias("weight"), "n")
    weights = settle(triples.unionByName(pair_weights).unionByName(single_weights), "ngram-weights")
    for name in (three_table, two_table, pairs_table):
        spark.sql(f"DROP TABLE {name}")
    return known, (float(np.log10(special.get(START, 1.0))), unknown), weights


def _mixed(g: np.ndarray, k: int) -> np.ndarray:
    x = g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - 26)).astype(np.int64)


def bloom_of(grams: DataFrame) -> np.ndarray:
    """Bits of a Bloom filter of fixed size over (g); tasks send their own bits, in blocks that are joined by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BLOOM_BITS, dtype=bool)
        for batch in batches:
            for k in range(3):
                bits[_mixed(batch.column(0).to_numpy(), k)] = True
        packed = np.packbits(bits).reshape(64, -1)
        full = [i for i in range(64) if packed[i].any()]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([packed[i].tobytes() for i in full], pa.binary())], ["key", "data"])

    def join(table: pa.Table) -> pa.Table:
        total = np.bitwise_or.reduce([np.frombuffer(x.as_py(), dtype=np.uint8) for x in table.column("data")])
        return pa.table([table.column("key")[:1], pa.array([total.tobytes()], pa.binary())], names=["key", "data"])

    found = np.zeros((64, BLOOM_BITS // 512), dtype=np.uint8)
    for r in grams.select("g").mapInArrow(run, "key int, data binary").groupBy("key").applyInArrow(join, "key int, data binary").collect():
        found[r["key"]] = np.frombuffer(r["data"], dtype=np.uint8)
    return found.ravel()


def hottest(weights: DataFrame, most: int) -> int:
    """The smallest count above which at most ``most`` n-grams lie."""
    levels = weights.groupBy(F.least("n", F.lit(1000)).alias("n")).agg(F.count("*").alias("k")).orderBy(F.desc("n")).collect()
    total, cut = 0, 1001
    for r in levels:
        total += r["k"]
        if total > most:
            break
        cut = r["n"]
    return cut


def perplexities(docs: DataFrame, known: np.ndarray | None, fixed: tuple[float, float], weights: DataFrame, keep: list[str], text_column: str = "text", hot: int = HOT) -> DataFrame:
    """``keep`` columns (doc_id among them), n_tokens (with the end) and perplexity of every row."""
    cut = hottest(weights, hot)
    top = weights.where(F.col("n") >= cut).select("g", "weight").toArrow().sort_by("g")
    hot_g, hot_w = top["g"].to_numpy(), top["weight"].to_numpy()
    rest = weights.where(F.col("n") < cut).select("g", "weight")
    context = weights.sparkSession.sparkContext
    shared = context.broadcast((known, fixed, hot_g, hot_w, bloom_of(rest)))  # at most HOT n-grams and BLOOM_BITS / 8 bytes
    key, mark = id_key(F.col("doc_id").cast("bigint")).alias("__key"), F.xxhash64(whole_text(text_column)).alias("__mark")
    names = ["__key", "__mark", "g", "n_tokens", "known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys, marks = np.asarray(part.column(0)), np.asarray(part.column(1))
                n_tokens, sums, tails = score(part.column(2).to_pylist(), *model)
                # A text's own row has a negative g, which is no n-gram and different for each text.
                own = (marks ^ keys) | np.int64(-(2**63))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, marks, own, n_tokens, sums)], names)
                whose = np.repeat(np.arange(len(keys)), [len(t) for t in tails])
                grams = np.concatenate(tails)
                yield pa.RecordBatch.from_arrays([pa.array(keys[whose]), pa.array(marks[whose]), pa.array(grams), pa.nulls(len(grams), pa.int64()), pa.nulls(len(grams), pa.float64())], names)

    parts = docs.select(key, mark, F.col(text_column).alias("__text")).mapInArrow(run, "`__key` long, `__mark` long, g long, n_tokens long, known double")
    # Rows repeating id and text give equal parts: their sum is divided by their number.
    sums = parts.join(rest, "g", "left").groupBy("__key", "__mark").agg(
        F.count("n_tokens").alias("__rows"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.coalesce("known", "weight", F.lit(0.0))).alias("__log")
    )
    scored = settle(
        sums.select("__key", "__mark", (F.col("n_tokens") / F.col("__rows")).cast("long").alias("n_tokens"), F.pow(10.0, -F.col("__log") / F.col("n_tokens")).alias("perplexity")),
        "scored-texts",
    )
    return docs.select(*keep, key, mark).join(scored, ["__key", "__mark"]).select(*keep, "n_tokens", "perplexity")


def score(texts, known, fixed, hot_g, hot_w, bloom) -> tuple[np.ndarray, np.ndarray, list]:
    """Per text: tokens, the sum of weights known here, and the n-grams that the sharded join must look up."""
    x, sizes = coded(texts, known)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    begin, unknown = fixed
    sums = begin + (sizes - 2) * unknown
    one, two, three = gram_keys(x)
    grams = np.concatenate([one, two, three])
    whose = np.concatenate([owner, owner[:-1], owner[2:]])
    valid = np.concatenate([x != START, owner[:-1] == owner[1:], x[2:] != START])
    grams, whose = grams[valid], whose[valid]
    if len(hot_g):
        at = np.minimum(np.searchsorted(hot_g, grams), len(hot_g) - 1)
        hit = hot_g[at] == grams
        sums += np.bincount(whose[hit], weights=hot_w[at[hit]], minlength=len(sizes))
        grams, whose = grams[~hit], whose[~hit]
    for k in range(3):
        place = _mixed(grams, k)
        maybe = (bloom[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
        grams, whose = grams[maybe], whose[maybe]
    order = np.argsort(whose, kind="stable")
    bounds = np.searchsorted(whose[order], np.arange(len(sizes) + 1))
    grams = grams[order]
    return sizes - 2, sums, [grams[bounds[i] : bounds[i + 1]] for i in range(len(sizes))]


def thresholds(judges: DataFrame, quantile: float = QUANTILE) -> tuple[DataFrame, Column]:
    """(of, own) for every language that has a row in ``judges`` (lang, perplexity); and the quantile over all languages."""
    cut = F.percentile_approx("perplexity", quantile, 10_000)
    own = settle(judges.groupBy("lang").agg(cut.alias("high"), F.percentile_approx("perplexity", 0.5, 10_000).alias("middle"), F.count("*").alias("n")), "own-quantiles")
    # One row per language.
    relative = judges.join(own.select(F.col("lang").alias("of"), "middle"), F.col("lang").eqNullSafe(F.col("of")))
    spread = relative.agg(F.percentile_approx(F.col("perplexity") / F.col("middle"), quantile, 10_000).alias("t")).scalar()
    weight = F.col("n") / (F.col("n") + PRIOR)
    own = own.select(F.col("lang").alias("of"), (F.col("middle") * F.pow(F.col("high") / F.col("middle"), weight) * F.pow(spread, 1 - weight)).alias("own"))
    return settle(own, "limits"), judges.agg(cut.alias("t")).scalar()


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, train_docs: int | None = TRAIN_DOCS, vocabulary: int | None = None) -> DataFrame:
    """doc_id, lang, mark (hash of the text), n_tokens, perplexity, threshold and kept for every row of ``docs`` (doc_id, text, lang).
    The model is fitted on at most ``train_docs`` trusted documents (None: on all of its half)."""
    trusted = settle(trusted_ids(labels).join(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct(), "doc_id", "left_semi"), "trusted-ids")
    side = F.xxhash64(F.lit(29), "doc_id")
    sample = trusted.where(side % 2 == 0)
    sample = settle(sample if train_docs is None else sample.orderBy(side, "doc_id").limit(train_docs), "sample-ids")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.xxhash64(whole_text()).alias("mark"), "text")
    if sample.isEmpty():
        return rows.select("doc_id", "lang", "mark", F.lit(None).cast("long").alias("n_tokens"), F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("kept"))
    texts = rows.join(sample, "doc_id", "left_semi").select("text")
    found = settle(perplexities(rows, *fit(texts, vocabulary), keep=["doc_id", "lang", "mark"]), "perplexities")
    judges = found.join(trusted.join(sample, "doc_id", "left_anti"), "doc_id", "left_semi").select("lang", "perplexity")
    limits, overall = thresholds(settle(judges, "judges"), quantile)
    judged = found.join(limits, F.col("lang").eqNullSafe(F.col("of")), "left").withColumn("threshold", F.coalesce("own", overall))
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return judged.select("doc_id", "lang", "mark", "n_tokens", "perplexity", "threshold", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    key, mark = fresh(docs.columns, "__key"), fresh(docs.columns, "__mark")
    kept = classify(docs, labels, **options).where("kept").select(id_key("doc_id").alias(key), F.col("mark").alias(mark)).distinct()
    rows = docs.withColumns({key: id_key(F.col("doc_id").cast("bigint")), mark: F.xxhash64(whole_text())})
    return rows.join(kept, [key, mark], "left_semi").select(*docs.columns)


def op10_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return classify(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"), train_docs=None).drop("mark")
