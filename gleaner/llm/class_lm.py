"""Brown class-based n-grams: exchange clustering of words into classes, then smoothed perplexity of whole texts.

Counts come from every training document, and every training word that occurs ``LEAST`` times is clustered by its own contexts, so the
clustered vocabulary grows with the text. The ``WORDS`` most frequent words are moved one by one on the driver, round by round: each
round gathers, over all training text, how often a word stands before and after each class, and every word moves to the class that
raises the likelihood of class bigrams most. Every further word is then moved in the tasks, by the same gain, all of them against one
table of class pairs (as in distributed exchange clustering, where words are moved in parallel); their context rows are sharded by
word, and only class-pair sums reach the driver. Until they are moved, they stand in the class of their last three bytes
(``SUFFIXES`` hashed endings), which is also the class of words that are unseen or occur fewer times.

A text's probability is the product over its tokens (words, then one end) of P(class | two classes before) * P(word | class).
Transitions are trigrams smoothed by bigrams and unigrams; emission adds one half to each word's count, and each class has one place
for unseen words. Texts are coded once; the counts and classes of words outside the frequent ones meet them in a join sharded by word.

Defined cases: a null or blank text is one end token; a null id is in the fold of the empty text; rows repeating an id are scored
each; without training documents all words are unseen; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import common
from gleaner.llm.common import LOWER_ASCII, documents, fold

WORDS, SUFFIXES, CLASSES, ROUNDS = 32767, 512, 48, 6
#: Words that occur fewer times in the training text have no class of their own.
LEAST = 5
#: Longer words are never among the frequent ones, which bounds what is sent to tasks.
WORD_BYTES = 64
HELD_WORDS = 300_000
BLOCK = 512
#: Partial sums of a block, so that no task takes one block from every other task at once.
SALTS = 64
END = 0
SMOOTH = 5.0
MOST = 2**31 - 1


def settle(df: DataFrame, name: str) -> DataFrame:
    """Coded texts are the largest tables and hold words, which zstd packs better."""
    return common.settle(df, name, codec="zstd")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER_ASCII).split()


def suffix_code(word: bytes, first: int, suffixes: int) -> int:
    return first + zlib.crc32(word[-3:]) % suffixes


def word_counts(docs: DataFrame, text_column: str = "text", split: Callable[[str | None], list[bytes]] = words_of) -> DataFrame:
    """(word, n) over whole texts; the empty word stands for the end of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            counts[b""] += batch.num_rows
            for text in batch.column(0):
                counts.update(split(text.as_py()))
                if len(counts) >= HELD_WORDS:
                    yield rows()
                    counts.clear()
        yield rows()

    return docs.select(F.col(text_column).alias("text")).mapInArrow(run, "word binary, n long").where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, words: int = WORDS) -> list[tuple[bytes, int]]:
    rows = counts.where((F.octet_length("word") > 0) & (F.octet_length("word") <= WORD_BYTES)).orderBy(F.desc("n"), "word").limit(words).collect()
    return [(bytes(r["word"]), r["n"]) for r in rows]


class Coding:
    """Codes: 0 is the end, 1 to len(words) the frequent words, then one code for each hashed ending."""

    def __init__(self, words: list[tuple[bytes, int]], ends: int, suffixes: int = SUFFIXES):
        self.codes = {w: i for i, (w, _) in enumerate(words, 1)}
        self.first_suffix, self.suffixes = len(words) + 1, suffixes
        self.size = self.first_suffix + suffixes
        self.logs = np.log10(np.array([ends, *[n for _, n in words]], dtype=np.float64) + 0.5)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, dict[bytes, int], np.ndarray]:
        """Codes, the words that are not frequent with their counts, and for each such token its word's number in them."""
        get = self.codes.get
        codes = [get(w, -1) for w in words]
        rare = [w for w, c in zip(words, codes, strict=True) if c < 0]
        found = np.array([*codes, END], dtype=np.int32)
        counted = Counter(rare)
        number = {w: i for i, w in enumerate(counted)}
        if rare:
            ends = np.array([suffix_code(w, self.first_suffix, self.suffixes) for w in counted])
            numbers = np.array([number[w] for w in rare])
            found[:-1][found[:-1] < 0] = ends[numbers]
        else:
            numbers = np.zeros(0, dtype=np.int64)
        return found, counted, numbers.astype(_number_type(len(counted)))


def _number_type(words: int) -> type:
    return np.uint16 if words <= 2**16 else np.uint32


CODED = "row long, doc_id long, held_out boolean, codes binary, numbers binary, n_tokens long, n_frequent long, log_frequent double, rare array<struct<word: binary, n: int>>"


def code_texts(docs: DataFrame, coding: Coding) -> DataFrame:
    """One row per document (row, doc_id, held_out, text in): 16-bit codes, and the words that are not frequent with their counts."""
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), rare_type]
    names = [c.split()[0] for c in CODED.split(", ")[:9]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for text in part.column(3):
                    found, rare, numbers = coding.encode(words_of(text.as_py()))
                    common = found[found < coding.first_suffix]
                    known = len(common) if coding.logs[END] > -0.3 else len(common) - 1
                    rows.append((found.astype(np.uint16).tobytes(), numbers.tobytes(), len(found), known, float(coding.logs[common].sum()), [{"word": w, "n": n} for w, n in rare.items()]))
                columns = [part.column(0), part.column(1), part.column(2)] + [pa.array([r[i] for r in rows], types[3 + i]) for i in range(6)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("row", F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", "text").mapInArrow(run, CODED)


def _flat(batch: pa.RecordBatch, i: int = 0, kind: type = np.uint16) -> np.ndarray:
    """Codes of all texts of a batch, an end before the first; each text ends in an end, which is what the next one's words follow."""
    return np.concatenate([np.zeros(1, dtype=kind), *[np.frombuffer(x.as_buffer(), dtype=kind) for x in batch.column(i)]])


def _entries(numbers: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """For every token that is not frequent, the place of its word among those of all texts of a batch (``sizes`` of each text)."""
    before = np.cumsum(sizes) - sizes
    found = [np.frombuffer(x.as_buffer(), dtype=_number_type(n)).astype(np.int64) + at for x, n, at in zip(numbers, sizes, before, strict=True)]
    return np.concatenate([np.zeros(0, dtype=np.int64), *found])


def _sizes(lists: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)


def _summed(rows: DataFrame, schema: str) -> list:
    """Blocks of counts (key, data) summed by key in tasks, then brought to the driver; blocks are of fixed number and size.

    Sums are taken in two levels, and each reads its blocks one after the other, so no worker holds a block of every task.
    """

    def adder(kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, salt, total = None, None, None
            for batch in batches:
                for x in batch.column("data"):
                    part = np.frombuffer(zlib.decompress(x.as_py()), dtype=kind)
                    total = part.astype(np.int64) if total is None else total + part
                key, salt = batch.column("key")[:1], batch.column("salt")[:1]
            yield pa.RecordBatch.from_arrays([key, salt, pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["key", "salt", "data"])

        return add

    salted = f"{schema}, salt int".replace("data binary, salt int", "salt int, data binary")
    dealt = rows.select("key", (F.spark_partition_id() % SALTS).alias("salt"), "data")
    partial = dealt.groupBy("key", "salt").applyInArrow(adder(np.int32), salted)
    return partial.groupBy("key").applyInArrow(adder(np.int64), salted).collect()


BLOCKS = "key int, data binary"


def context_counts(coded: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """For every code, counts of the class before it and of the class after it (codes x 2 x classes), over all training text."""
    size = len(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size * n_classes), dtype=np.int64)
        for batch in batches:
            codes = _flat(batch)
            own = classes[codes].astype(np.int64)
            wide = codes.astype(np.int64) * n_classes
            total[0] += np.bincount(wide[1:] + own[:-1], minlength=size * n_classes)
            total[1] += np.bincount(wide[:-1] + own[1:], minlength=size * n_classes)
        sides = total.reshape(2, size, n_classes).transpose(1, 0, 2)
        for at in range(0, size, BLOCK):
            part = sides[at : at + BLOCK]
            for k in range(int(part.max()) // MOST + 1):  # counts beyond 31 bits go in pieces
                piece = np.clip(part - k * MOST, 0, MOST).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([zlib.compress(np.ascontiguousarray(piece).tobytes(), 1)])], ["key", "data"])

    found = np.zeros((size, 2, n_classes), dtype=np.int64)
    for r in _summed(coded.select("codes").mapInArrow(run, BLOCKS), BLOCKS):
        part = np.frombuffer(zlib.decompress(r["data"]), dtype=np.int64).reshape(-1, 2, n_classes)
        found[r["key"] : r["key"] + len(part)] = part
    return found


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(counts: np.ndarray, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """One round: each code, the most frequent first, leaves its class and joins the one with the highest class-bigram likelihood.
    The end keeps class 0, and no other code joins it."""
    classes = classes.copy()
    pairs = np.zeros((n_classes, n_classes))
    np.add.at(pairs, classes, counts[:, 1].astype(np.float64))
    before, after = counts[:, 0].astype(np.float64), counts[:, 1].astype(np.float64)
    order = np.argsort(-counts[:, 0].sum(axis=1), kind="stable")
    for w in order:
        left, right = before[w], after[w]
        if w == END or not left.any():
            continue
        own = classes[w]
        pairs[own] = np.maximum(pairs[own] - right, 0)
        pairs[:, own] = np.maximum(pairs[:, own] - left, 0)
        rows, columns = pairs.sum(axis=1), pairs.sum(axis=0)
        met, meets = np.flatnonzero(left), np.flatnonzero(right)  # most words stand beside few classes; the others change nothing
        after_it, before_it = pairs[:, meets], pairs[met]
        gain = (_xlogx(after_it + right[meets]) - _xlogx(after_it)).sum(axis=1) + (_xlogx(before_it + left[met, None]) - _xlogx(before_it)).sum(axis=0)
        gain -= _xlogx(rows + right.sum()) - _xlogx(rows) + _xlogx(columns + left.sum()) - _xlogx(columns)
        gain[0] = -np.inf
        best = int(np.argmax(gain))
        classes[w] = best
        pairs[best] += right
        pairs[:, best] += left
    return classes


def cluster(coded: DataFrame, coding: Coding, n_classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """A class for every code: the most frequent words begin alone, the others anywhere."""
    codes = np.arange(coding.size)
    classes = np.where(codes < n_classes, codes, 1 + (codes * 7919) % (n_classes - 1)).astype(np.uint8)
    for _ in range(rounds):
        moved = exchange(context_counts(coded, classes, n_classes), classes, n_classes)
        if (moved == classes).all():
            break
        classes = moved
    return classes


def transition_counts(texts: DataFrame, n_classes: int, classes: np.ndarray | None = None) -> np.ndarray:
    """Class trigrams of all training text; what stands before a text counts as two ends. ``texts``: one column of codes, or, without
    ``classes``, of the classes themselves."""
    cells = n_classes**3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype=np.int64)
        for batch in batches:
            own = _flat(batch, kind=np.uint8) if classes is None else classes[_flat(batch)]
            total += np.bincount(_trigrams(own.astype(np.int64), n_classes), minlength=cells)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["cell", "n"])

    counts = np.zeros(cells, dtype=np.float64)
    for r in texts.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    return counts.reshape(n_classes, n_classes, n_classes)


def rare_contexts(coded: DataFrame, classes: np.ndarray, first_suffix: int, n_classes: int) -> DataFrame:
    """word, cells: for every word that is not frequent, how often it follows each class (cell) and precedes it (``n_classes`` + cell).

    A task sums each batch by word before the shuffle, each sum packed with its cell in one number; a word then meets its sums in one
    task, which keeps 2 * ``n_classes`` of them.
    """
    kinds = 2 * n_classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = _flat(batch)
            own, at = classes[flat].astype(np.int64), np.flatnonzero(flat >= first_suffix)
            if not len(at):
                continue
            words = batch.column(2).flatten().field("word").dictionary_encode()
            word = np.asarray(words.indices).astype(np.int64)[_entries(batch.column(1), _sizes(batch.column(2)))] * kinds
            keys, n = np.unique(np.concatenate([word + own[at - 1], word + n_classes + own[at + 1]]), return_counts=True)
            ids, starts = np.unique(keys // kinds, return_index=True)
            lists = pa.ListArray.from_arrays(pa.array([*starts, len(keys)], pa.int32()), pa.array(n * kinds + keys % kinds, pa.int64()))
            yield pa.RecordBatch.from_arrays([words.dictionary.take(pa.array(ids)), lists], ["word", "cells"])

    found = coded.select("codes", "numbers", "rare").mapInArrow(run, "word binary, cells array<long>")
    each = found.repartition("word").select("word", F.explode("cells").alias("x"))
    sums = each.select("word", (F.col("x") % kinds).cast("int").alias("cell"), F.floor(F.col("x") / kinds).alias("n")).groupBy("word", "cell").agg(F.sum("n").alias("n"))
    return sums.groupBy("word").agg(F.collect_list(F.struct("cell", "n")).alias("cells"))


def best_classes(own: np.ndarray, cells: np.ndarray, n: np.ndarray, starts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The class of highest likelihood for each of many words, each moved as if alone. ``own``: where they stand; ``cells``, ``n``:
    their contexts, those of a word from its ``starts``; ``pairs``: class bigrams."""
    n_classes, words = len(pairs), np.arange(len(own))
    word = np.repeat(words, np.diff([*starts, len(cells)]))
    after, other = cells >= n_classes, cells % n_classes

    def gains(beside: np.ndarray, amount: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Change of x log x where an amount joins each class; in the class where it stands it is taken out first."""
        rows, place = np.arange(len(beside)), own[at]
        beside = beside.copy()
        beside[rows, place] = np.maximum(beside[rows, place] - amount, 0)
        return _xlogx(beside + amount[:, None]) - _xlogx(beside)

    n = n.astype(np.float64)
    gain = np.add.reduceat(gains(np.where(after[:, None], pairs.T[other], pairs[other]), n, word), starts, axis=0)
    left, right = np.bincount(word, n * ~after, len(own)), np.bincount(word, n * after, len(own))
    gain -= gains(np.broadcast_to(pairs.sum(axis=1), gain.shape), right, words) + gains(np.broadcast_to(pairs.sum(axis=0), gain.shape), left, words)
    gain[:, 0] = -np.inf
    return gain.argmax(axis=1)


def move_rare(contexts: DataFrame, counts: DataFrame, classes: np.ndarray, coding: Coding, pairs: np.ndarray, least: int = LEAST) -> DataFrame:
    """word, ending (the class it stood in), class: every word that is not frequent but occurs ``least`` times, moved once."""
    first, suffixes = coding.first_suffix, coding.suffixes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                lists, sizes = batch.column(1), _sizes(batch.column(1))
                own = classes[[suffix_code(w.as_py(), first, suffixes) for w in batch.column(0)]].astype(np.int64)
                cells, n = (np.asarray(lists.flatten().field(name)) for name in ("cell", "n"))
                best = best_classes(own, cells, n, np.cumsum(sizes) - sizes, pairs)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int32()), pa.array(best, pa.int32())], ["word", "ending", "class"])

    return contexts.join(counts.where(F.col("n") >= least).select("word"), "word").select("word", "cells").mapInArrow(run, "word binary, ending int, class int")


def _trigrams(own: np.ndarray, n_classes: int) -> np.ndarray:
    """Cell of (two before, before, own) for every token but the leading end."""
    before = own[:-1]
    second = np.concatenate([own[:1], own[:-2]])
    return (np.where(before == 0, 0, second) * n_classes + before) * n_classes + own[1:]


def words_by_code(counts: DataFrame, coding: Coding) -> np.ndarray:
    """Distinct training words behind each code."""
    first, suffixes, size, known = coding.first_suffix, coding.suffixes, coding.size, coding.codes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            codes = [END if not w else known.get(w, -1) if len(w) <= WORD_BYTES else -1 for w in (x.as_py() for x in batch.column(0))]
            rare = [suffix_code(batch.column(0)[i].as_py(), first, suffixes) for i, c in enumerate(codes) if c < 0]
            total += np.bincount([c for c in codes if c >= 0] + rare, minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["cell", "n"])

    out = np.zeros(size, dtype=np.float64)
    for r in counts.select("word").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out


def token_scores(trigrams: np.ndarray, words_per_class: np.ndarray) -> np.ndarray:
    """log10 of P(class | two before) / (class count + half of its words and of its unseen place), for every class trigram."""
    n_classes = len(trigrams)
    bigrams = trigrams.sum(axis=0)
    unigrams = bigrams.sum(axis=0)
    one = (unigrams + 0.5) / (unigrams.sum() + 0.5 * n_classes)
    two = (bigrams + SMOOTH * one) / (bigrams.sum(axis=1, keepdims=True) + SMOOTH)
    three = (trigrams + SMOOTH * two[None]) / (trigrams.sum(axis=2, keepdims=True) + SMOOTH)
    return np.log10(three) - np.log10(unigrams + 0.5 * (words_per_class + 1))


#: Class number of a word without a class of its own, in the rows that bring classes back to the texts.
BY_ENDING = 255
CLASSED = "doc_id long, held_out boolean, n_known long, log_words double, n_tokens long, own binary"


def class_texts(coded: DataFrame, lookup: DataFrame, classes: np.ndarray, first_suffix: int) -> DataFrame:
    """Texts as classes, with the sums over their words. ``lookup``: word, n, class (null: by its ending)."""
    rare = coded.select("row", F.posexplode("rare").alias("number", "entry")).select("row", "number", "entry.word", F.col("entry.n").alias("tf"))
    place = F.col("number").cast("bigint") * 256 + F.coalesce("class", F.lit(BY_ENDING))
    met = rare.join(lookup, "word", "left").select("row", place.alias("place"), "tf", F.coalesce("n", F.lit(0)).alias("n")).repartition("row").groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(F.col("n") + 0.5)).alias("log_rare"), F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("n_rare"),
        F.collect_list("place").alias("places"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = _flat(batch, 5), _sizes(batch.column(7))
            places = np.asarray(batch.column(7).flatten()).astype(np.int64)
            found = np.empty(len(places), dtype=np.int64)
            found[np.repeat(np.cumsum(sizes) - sizes, sizes) + places // 256] = places % 256
            own, at = classes[flat].copy(), np.flatnonzero(flat >= first_suffix)
            of_word = found[_entries(batch.column(6), sizes)]
            own[at] = np.where(of_word == BY_ENDING, own[at], of_word)
            cuts = np.concatenate([[0], np.cumsum(np.asarray(batch.column(4)))]) + 1
            texts = pa.array([own[i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], texts], [c.split()[0] for c in CLASSED.split(", ")])

    known = F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))
    log_words = F.col("log_frequent") + F.coalesce("log_rare", F.lit(0.0))
    return coded.join(met, "row", "left").select(
        "doc_id", "held_out", known.cast("bigint").alias("n_known"), log_words.alias("log_words"), "n_tokens", "codes", "numbers", "places"
    ).mapInArrow(run, CLASSED)


def score_texts(docs: DataFrame, held_out, words: int = WORDS, suffixes: int = SUFFIXES, n_classes: int = CLASSES, rounds: int = ROUNDS,
                id_column: str = "doc_id", text_column: str = "text", least: int = LEAST) -> DataFrame:
    """Learn from the rows where ``held_out`` is false and score all: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10), perplexity."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), held_out.alias("held_out"))
    counts = settle(word_counts(rows.where(~F.col("held_out"))), "word-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum(F.when(F.octet_length("word") == 0, F.col("n"))), F.lit(0)).alias("ends")).first()
    coding = Coding(frequent_words(counts, words), total["ends"], suffixes)
    # The row number is fixed once it is written.
    coded = settle(code_texts(rows.withColumn("row", F.monotonically_increasing_id()), coding), "coded-texts")
    training = coded.where(~F.col("held_out"))
    classes = cluster(training, coding, n_classes, rounds)
    pairs = transition_counts(training.select("codes"), n_classes, classes).sum(axis=0)
    moved = settle(move_rare(rare_contexts(training, classes, coding.first_suffix, n_classes), counts, classes, coding, pairs, least), "word-classes")
    per_class = np.bincount(classes, weights=words_by_code(counts, coding), minlength=n_classes)
    for r in moved.groupBy("ending", "class").agg(F.count("*").alias("n")).collect():
        per_class[r["ending"]] -= r["n"]
        per_class[r["class"]] += r["n"]
    lookup = counts.join(moved.select("word", "class"), "word", "left")
    classed = settle(class_texts(coded, lookup, classes, coding.first_suffix), "classed-texts")
    table = token_scores(transition_counts(classed.where(~F.col("held_out")).select("own"), n_classes), per_class).ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(4))
            each = table[_trigrams(_flat(batch, 5, np.uint8).astype(np.int64), n_classes)]
            sums = np.add.reduceat(each, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sums)], [*batch.schema.names[:5], "structure"])

    scored = classed.mapInArrow(run, CLASSED.replace("own binary", "structure double"))
    mass = float(np.log10(total["n"] + 0.5 * (total["v"] + 1)))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total["n"]).cast("long").alias("train_tokens"),
        (F.col("log_words") - F.col("n_tokens") * mass).alias("base_score"), (F.col("log_words") + F.col("structure")).alias("score"),
    ).withColumn("perplexity", F.pow(10.0, -F.col("score") / F.col("n_tokens")))


def op3_class_lm(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(documents(spark, folder).select("doc_id", "text"), fold("doc_id", 5) == 1)
