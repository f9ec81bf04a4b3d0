"""Spelling variants of words, found through pivotal grams.

Two words are near when one inserted, deleted or replaced code point turns one into the other. A word has its bigrams ordered from the
rarest in the vocabulary on; its prefix is the first three (one edit spoils two at most). Dynamic programming over the prefix picks two
bigrams that do not overlap and are rarest together, the pivots. One edit spoils one pivot at most, so of two near words, the one whose
prefix ends earlier in the order has a pivot that the other holds in its prefix, at a position that the edit can have moved by one.

Position limits say more at one edit: it lies behind the first pivot, and the words agree from their start to that pivot's end, or before
the second one, and they agree from there to their end (or both). Pivots and prefixes are therefore matched by bigram, side, position
counted from that side and everything on that side, and by lengths that differ by one at most. Every match is verified by its edit
distance.

Bigrams come from 90 letters (26 and 64), so their table has 8,100 rows at most and goes to every task. Words are counted
inside the tasks first; from then on only the distinct words move.

Defined cases: a null text has no words; a null id counts as empty text in the checksum; repeated rows count as often as they occur;
words without near ones have n_near 0, null form and form_n, and are their own root; an empty table gives an empty result; very long
words take part like others (of a bigram that repeats in a prefix's last place, the first five occurrences are indexed, which is all that
an edit can bring into line).
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import ascii_lower, documents, settle

RUN = re.compile("[a-zÀ-ÿ]+")
SLIPS = 199
LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
#: Bigrams in a prefix, pivots in it, and occurrences kept of a bigram that repeats at its end.
PREFIX, TIED = 3, 5
#: Distinct words that a task holds before it passes their counts on.
HELD = 200_000


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n) of all runs of letters, after the slips that the checksum of id and run asks for."""
    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("doc_id"), F.col(text_column).alias("text"))

    def batch_of(counts: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if len(w) >= LEAST_LETTERS]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                start = zlib.crc32(f"{doc.as_py()}:".encode())
                for word, n in Counter(RUN.findall(ascii_lower(text.as_py()).decode("utf-8", "surrogatepass"))).items():
                    h = zlib.crc32(word.encode(), start)
                    if not h % SLIPS:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    counts[word] += n
                if len(counts) > HELD:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How many bigrams of distinct words are which; at most one row per pair of letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                counts.update(map(str.__add__, word, word[1:]))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"])

    found = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {r["gram"]: r["n"] for r in found}


def prefix_grams(word: str, rank: dict[str, int]) -> tuple[list[int], list[int], int]:
    """Positions of the prefix; the same with repeats of its last bigram; the rank at which it ends."""
    places = ((rank[word[i : i + 2]], i) for i in range(len(word) - 1))
    first = heapq.nsmallest(PREFIX, places)
    end = first[-1][0]
    last = word[first[-1][1] :][:2]
    tied = [i for i in range(len(word) - 1) if word.startswith(last, i)][:TIED]
    return sorted(i for _, i in first), sorted({i for r, i in first if r < end} | set(tied)), end


def pivots(word: str, places: list[int], counts: dict[str, int]) -> list[int]:
    """Two of the places at least two apart whose bigrams are rarest together (the leftmost such pair)."""
    single: list[tuple[int, int]] = []  # least count of one bigram among the places so far, and where
    best = (float("inf"), -1, -1)
    for at, i in enumerate(places):
        own = counts[word[i : i + 2]]
        apart = at - 1 if at and places[at - 1] < i - 1 else at - 2
        if apart >= 0:
            best = min(best, (single[apart][0] + own, single[apart][1], i))
        single.append(min(single[-1], (own, i)) if single else (own, i))
    return list(best[1:])


def _side_key(word: str, i: int, behind: bool) -> tuple[int, int]:
    """The position from the side on which the words agree, and a hash of all letters there, the bigram's included."""
    agreed = word[i:] if behind else word[: i + 2]
    return len(agreed), xxhash.xxh64_intdigest(agreed.encode(), behind) - (1 << 63)


def postings(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pivots (one row for each length the other word can have) and prefixes, as rows of gram, behind, position, agreed, length,
    word, ends (the rank at which the prefix ends)."""
    counts = gram_counts(words)
    rank = {g: i for i, (g, _) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0])))}
    schema = "gram string, behind boolean, position int, agreed long, length int, word string, ends int, pivot boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word in batch.column(0).to_pylist():
                prefix, places, ends = prefix_grams(word, rank)
                first, second = pivots(word, prefix, counts)
                for i in places:
                    for behind in (False, True):
                        row = (word[i : i + 2], behind, *_side_key(word, i, behind))
                        out.append((*row, len(word), word, ends, False))
                        if i == (second if behind else first):
                            out += [(*row, n, word, ends, True) for n in range(len(word) - 1, len(word) + 2)]
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["gram", "behind", "position", "agreed", "length", "word", "ends", "pivot"]
    types = [pa.string(), pa.bool_(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.bool_()]
    rows = settle(words.select("word").mapInArrow(run, schema), "spelling-postings")
    return rows.where("pivot").drop("pivot"), rows.where("NOT pivot").drop("pivot")


def near_words(words: DataFrame) -> DataFrame:
    """(a, b) for every word a and each word b near it."""
    keys = ["gram", "behind", "position", "agreed", "length"]
    pivot, prefix = postings(words)
    probes = pivot.select(*keys, F.col("word").alias("a"), F.col("ends").alias("a_ends"))
    held = prefix.select(*keys, F.col("word").alias("b"), F.col("ends").alias("b_ends"))
    met = probes.join(held, keys).where("a_ends <= b_ends AND a <> b").where(F.levenshtein("a", "b", 1) == 1)
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return settle(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "near-words")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form. A form occurs five times as often, so chains are short; each round doubles the step."""
    step = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        following = settle(step.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not following.where("moved").limit(1).count():
            return step
        step = following.select("word", "root")


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", times: int = TIMES) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = settle(word_counts(docs, id_column, text_column).where(F.col("n") >= LEAST_COUNT), "words")
    named = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    # Most frequent first, then the smallest in code-point order, which is the order of UTF-8 bytes.
    best = F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word"))).alias("best")
    near = near_words(words).join(named, "b").groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best)
    rows = words.join(near, "word", "left").withColumn("frequent", -F.col("best.n") >= F.lit(times) * F.col("n"))
    rows = settle(
        rows.select(
            "word", F.when(F.col("frequent"), F.col("best.word")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(F.col("frequent"), -F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(rows.where("form IS NOT NULL"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(documents(spark, folder).select("doc_id", "text"))
