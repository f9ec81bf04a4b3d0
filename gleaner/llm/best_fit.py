"""Best-fit packing with large-item matching.

Documents become token ids and one end id; only those longer than a sequence are cut, into pieces of the sequence's capacity. Where a
piece goes depends on its length alone, so the plan is made from the histogram of lengths: at most one row per length up to the
capacity, however many documents there are.

* Pieces above a third of the capacity meet at most twice in a sequence. From the longest down, each is matched with the longest
  large piece that still fits, which gives the most pairs there can be.
* Smaller pieces, again from the longest down, go where the least space is left over (best fit); new sequences open when none has room.

Equal sequences are planned together, as a run of numbers with a count, so a plan has a few thousand rows and at most about 12 for
each change of a run. A piece's rank among those of its length (its place in its block of rows, after the blocks before) then names its
sequence and offset. No task or driver holds the pieces of a length.

Words repeat, so their ids are remembered (``KNOWN`` at a time, a cache and no limit); words never share a token.

Defined cases: a null text counts as empty and is one piece of one id; a null id stays null; repeated rows are packed once each; a
document that fills pieces exactly has no short piece; an empty table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import bisect
import json
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleaner.llm.common import documents, settle

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a worker remembers, how long they may be, and how many characters are split at once.
KNOWN, KNOWN_CHARS, TEXT_AT_ONCE = 1_000_000, 40, 1_000_000
BLANKS = re.compile("[ \t\n\r]+")
# --- fixed values of this kind of tokenizer
SPLITTING = [
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    None,
]
#: Characters on which the splitting above is plain: blanks, ASCII without what begins a special token, and letters of Latin-1.
PLAIN = re.compile("[ \t\n\r!-;=-~À-ÖØ-öø-ÿ]*")
WORDS = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^ \t\n\ra-z0-9ß-öø-ÿ]+")
#: Byte-level tokenizers write a byte as its character if it is visible, or as the next character from 256 on.
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in VISIBLE)}
PLAN = ["length", "first", "copies", "bins", "base", "offset"]


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, the same as the tokenizer gives for the whole text.

    A tokenizer of the kind of ``word_bpe_49k.json`` splits at white space and between kinds of characters before it looks anything up.
    Where a text has only ``PLAIN`` characters, on which that is certain, it is split here and each distinct word is looked up once.
    Chunks between blanks that have others go to the tokenizer as they are. With another kind of tokenizer whole texts do.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        kind = json.loads(self.tokenizer.to_str())
        self.splits = [kind["normalizer"], kind["pre_tokenizer"], kind["post_processor"]] == SPLITTING
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def word_ids(self, word: str) -> bytes:
        found = self.tokenizer.model.tokenize(word.encode().decode("latin-1").translate(BYTE_LETTERS))
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def units(self, text: str) -> list[str]:
        if not self.splits:
            return [text]
        if PLAIN.fullmatch(text):
            return WORDS.findall(text.lower())
        return [u for c in BLANKS.split(text) for u in (WORDS.findall(c.lower()) if PLAIN.fullmatch(c) else [c])]

    def texts_ids(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > KNOWN:
            self.known = {}
        split = [self.units(t) for t in texts]
        for unit in set().union(*split).difference(self.known):
            self.known[unit] = self.word_ids(unit) if self.splits and PLAIN.fullmatch(unit) else self.ids(unit)
        coded = [b"".join(map(self.known.__getitem__, s)) for s in split]
        for s in split:
            for unit in s:
                if len(unit) > KNOWN_CHARS:
                    self.known.pop(unit, None)
        return coded


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def windows(text: str, size: int = TEXT_AT_ONCE) -> Iterator[str]:
    """The text in parts of about ``size``, cut only at white space."""
    at = 0
    while len(text) - at > size:
        cut = BLANKS.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32; block and serial place it among the pieces of its length."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"), F.spark_partition_id().alias("block"))
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(path), defaultdict(int)

        def groups(batch: pa.RecordBatch) -> Iterator[list[tuple[int | None, str]]]:
            """Neighbouring rows whose texts are encoded together; a long text goes alone, window by window."""
            held, n = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                if n + len(text) > TEXT_AT_ONCE and held:
                    yield held
                    held, n = [], 0
                held.append((doc, text))
                n += len(text)
            if held:
                yield held

        for batch in batches:
            block = batch.column(2)[0].as_py() if batch.num_rows else 0
            for group in groups(batch):
                if len(group) == 1:
                    coded = [b"".join(encode.texts_ids([w])[0] for w in windows(group[0][1]))]
                else:
                    coded = encode.texts_ids([t for _, t in group])
                out = []
                for (doc, _), ids in zip(group, coded, strict=True):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        length = len(part) // 4
                        out.append((doc, piece, at // 4, length, zlib.crc32(part), block, seen[length]))
                        seen[length] += 1
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "block", "serial"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, block int, serial long")


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows of ``PLAN``: pieces of one length, from rank ``first`` on, go ``copies`` at a time to sequences ``base`` to
    ``base + bins - 1``, from ``offset`` on. Sorted by length and rank."""
    left = {length: n for length, n in histogram.items() if n}
    used: dict[int, int] = defaultdict(int)
    rows: list[tuple[int, ...]] = []
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # space left: runs of (base, bins)
    spaces: list[int] = []
    opened = 0

    def place(length: int, copies: int, bins: int, base: int, offset: int) -> None:
        rows.append((length, used[length], copies, bins, base, offset))
        used[length] += copies * bins
        left[length] -= copies * bins

    def keep(space: int, base: int, bins: int) -> None:
        if space and bins:
            if not room[space]:
                bisect.insort(spaces, space)
            room[space].append((base, bins))

    large = sorted(n for n in left if 3 * n > capacity)
    small = sorted((n for n in left if 3 * n <= capacity), reverse=True)
    for a in large[::-1]:
        while left[a]:
            at = bisect.bisect_right(large, min(a, capacity - a)) - 1
            while at >= 0 and left[large[at]] < (2 if large[at] == a else 1):
                del large[at]  # used up (or a single one of the length at hand): of no use to shorter ones either
                at -= 1
            if at < 0:
                place(a, 1, bins := left[a], opened, 0)
                keep(capacity - a, opened, bins)
            else:
                b = large[at]
                bins = left[a] // 2 if a == b else min(left[a], left[b])
                place(a, 1, bins, opened, 0)
                place(b, 1, bins, opened, a)
                keep(capacity - a - b, opened, bins)
            opened += bins
    for s in small:
        while left[s]:
            at = bisect.bisect_left(spaces, s)
            if at == len(spaces):
                space, base, bins = capacity, opened, -(-left[s] // (capacity // s))
                opened += bins
            else:
                space = spaces[at]
                base, bins = room[space].pop()
                if not room[space]:
                    del spaces[at]
            copies = min(space // s, left[s])
            filled = min(bins, left[s] // copies)
            place(s, copies, filled, base, capacity - space)
            keep(space - copies * s, base, filled)
            keep(space, base + filled, bins - filled)
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, len(PLAN))


def pack_best_fit(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = settle(token_pieces(docs, capacity, tokenizer, id_column, text_column), "pieces")
    counts = settle(pieces.groupBy("length", "block").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_sequences(histogram, capacity)
    shift = int(max(histogram.values(), default=1)).bit_length()
    sent = docs.sparkSession.sparkContext.broadcast((plan, (plan[:, 0] << shift) + plan[:, 1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, keys = sent.value
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            row = table[np.searchsorted(keys, (length << shift) + rank, side="right") - 1]
            ahead = rank - row[:, 1]
            sequence, offset = row[:, 4] + ahead // row[:, 2], row[:, 5] + ahead % row[:, 2] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names)

    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(starts, ["length", "block"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("earlier") + F.col("serial")).alias("rank")
    )
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op11_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return pack_best_fit(documents(spark, folder).select("doc_id", "text"))
