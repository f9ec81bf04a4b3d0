"""SimHash near-duplicates by the generalised pigeonhole.

Fingerprints: a bit is set where over half of a text's shingle hashes have it. Distinct fingerprints are linked at ``RADIUS`` or
fewer differing bits: correlated bits are grouped into m parts, and part g gets a threshold t_g with sum(t_g + 1) = RADIUS + 1. Two
fingerprints within the radius then differ by at most t_g bits in some part, so every fingerprint is listed under its own value of
each part and probes the values at most t_g bits away. Dynamic programming chooses the thresholds (and m) by the number of probes
and of candidates expected from the bits' statistics over all fingerprints; they change the cost, never the result.

Pairs are verified where they meet, and only a spanning forest of the links leaves a bucket. Buckets of more than ``BUCKET`` rows are
cut into blocks: blocks are linked inside, every row is compared with one pivot, and then only rows outside the bucket's largest
component are compared with the rest, block by block.

With a ``similarity``, a node is a distinct set of shingles (with its fingerprint), and links are verified. Nodes whose fingerprint has
a link or is shared are listed once more with a second, wider fingerprint of their distinct shingles, which keeps back pairs that are
clearly further apart (``SLACK`` standard deviations). Every spanning link is then confirmed by the exact Jaccard similarity of the two
shingle sets. Where one fails, the pairs of its component that confirmed links have not joined are all looked at, so that a failed link
never hides a right one. The radius decides what is found, the exact similarity what is right.

Defined cases: a null or blank text has fingerprint zero and is linked like any other; a text of fewer words than a shingle is one
shingle; a null id takes part, its component is named by the smallest id that is not null (null if there is none); repeated rows share
a component; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import LOWER_ASCII, documents, fresh, id_key, settle, whole_text
from gleaner.llm.graph import components

SHINGLE, SEED, RADIUS = 4, 42, 4
BUCKET = 4096
SMALL_RUN = 48
#: Cost of comparing a candidate, in costs of moving one probe.
COMPARE = 0.03
HASHES = 1 << 17
#: Values that a fingerprint may probe in one part.
MOST_PROBES = 4096
#: 64-bit words of the wide fingerprint.
WIDE = ["w1", "w2", "w3", "w4"]
#: Standard deviations of the wide fingerprint beyond what is expected at the similarity.
SLACK = 3
#: A byte's bits, each in a byte of its own.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def shingle_hashes(text: bytes, k: int = SHINGLE, seed: int = SEED) -> list[int]:
    """XXH64 of every shingle of the lower-cased words, repeats included."""
    words = text.translate(LOWER_ASCII).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - k]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[i : j - 1], seed) for i, j in zip(starts, ends[k - 1 :], strict=True)]


def rehashed(flat: np.ndarray, word: int) -> np.ndarray:
    """Other hashes of the same shingles, for a word of the wide fingerprint; word 0 keeps them."""
    if not word:
        return flat
    x = (flat ^ (flat >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 + 2 * word)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def fold_bits(hashes: list[list[int]], word: int = 0) -> np.ndarray:
    """Fingerprints (as signed 64-bit numbers) of several texts' hashes."""
    sizes = np.array([len(h) for h in hashes], dtype=np.int64)
    found = np.zeros(len(hashes), dtype=np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        flat = rehashed(np.fromiter(itertools.chain.from_iterable(hashes), dtype=np.uint64, count=int(sizes.sum())), word)
        ends = np.cumsum(sizes[full])
        counts = np.zeros((len(full), 64), dtype=np.int64)
        # Stretches of one text of at most 255 hashes, whose bits are counted in bytes.
        cuts = np.unique(np.concatenate([[0], ends[:-1], np.arange(0, len(flat), 255), np.arange(0, len(flat), HASHES)]))
        owner = np.searchsorted(ends, cuts, side="right")
        for at in range(0, len(flat), HASHES):  # a very long text never has all its bits spread at once
            low, high = np.searchsorted(cuts, [at, at + HASHES])
            lanes = np.add.reduceat(SPREAD[flat[at : at + HASHES].view(np.uint8).reshape(-1, 8)], cuts[low:high] - at, axis=0).view(np.uint8)
            texts, first = np.unique(owner[low:high], return_index=True)
            counts[texts] += np.add.reduceat(lanes, first, axis=0, dtype=np.int64)
        found[full] = np.packbits(counts * 2 > sizes[full][:, None], axis=1).view(np.int64).ravel()
    return found


def fingerprints(docs: DataFrame, k: int = SHINGLE, seed: int = SEED, id_column: str = "doc_id", text_column: str = "text", mark: bool = False, wide: bool = False) -> DataFrame:
    """doc_id and fp of every row; ``mark`` adds a hash of the text, ``wide`` the words of the wide fingerprint, in which each distinct
    shingle counts once, and ``node``, a hash of the set of shingles and fp."""
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.xxhash64(whole_text(text_column)).alias("mark"), F.col(text_column).alias("text"))

    def folded(held: list[list[int]]) -> list[np.ndarray]:
        prints = fold_bits(held)
        if not wide:
            return [prints]
        sets = [distinct(h) for h in held]
        node = np.array([xxhash.xxh64_intdigest(x.tobytes(), int(fp) & (2**64 - 1)) for x, fp in zip(sets, prints, strict=True)], dtype=np.uint64)
        lists = [x.tolist() for x in sets]
        return [prints, *(fold_bits(lists, w) for w in range(1, 1 + len(WIDE))), node.view(np.int64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held, n = [], [], 0
            for text in batch.column(2):
                held.append(shingle_hashes((text.as_py() or "").encode("utf-8", "surrogatepass"), k, seed))
                n += len(held[-1])
                if n >= HASHES:
                    found.append(folded(held))
                    held, n = [], 0
            found.append(folded(held))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x) for x in np.concatenate(found, axis=1))], names)

    names = ["doc_id", "mark", "fp", *([*WIDE, "node"] if wide else [])]
    out = rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))
    return out if mark else out.drop("mark")


def distinct(hashes: list[int]) -> np.ndarray:
    return np.unique(np.array(hashes, dtype=np.uint64))


def shingle_sets(rows: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    """(node, shingles): the distinct shingles of each row (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                sets = [distinct(shingle_hashes((t.as_py() or "").encode("utf-8", "surrogatepass"), k, seed)).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return rows.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def similar_links(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b, right): whether the exact Jaccard similarity of the two shingle sets is at least ``similarity``."""
    met = links.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    met = met.withColumn("common", F.size(F.array_intersect("x", "y")))
    return met.select("a", "b", (F.col("common") >= F.lit(similarity) * (F.size("x") + F.size("y") - F.col("common"))).alias("right"))


def _carried(rows: DataFrame) -> list[str]:
    return [c for c in [*WIDE, "node"] if c in rows.columns]


def _names(x: np.ndarray) -> np.ndarray:
    """What rows are linked by: the node, if it is carried, or else the fingerprint."""
    return x[..., 1 + len(WIDE)] if x.shape[-1] > 1 + len(WIDE) else x[..., 0]


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and how many have bits i and j set (64 x 64); each task sends its own sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy()).astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        cells = np.append(np.rint(total).astype(np.int64).ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097)), pa.array(cells)], ["cell", "n"])

    sums = nodes.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(4097)
    for r in sums:
        cells[r["cell"]] = r["n"]
    return int(cells[4096]), cells[:4096].reshape(64, 64)


def correlated_parts(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """64 bits in m parts of nearly equal width, each grown from a seed by its most correlated bits."""
    p = np.diag(together) / max(1, n)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    close = np.abs(together / max(1, n) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(close, 0)
    rest, parts = list(range(64)), []
    for g in range(m):
        width = 64 // m + (g < 64 % m)
        part = [max(rest, key=lambda i: (close[i, rest].sum(), -i))]
        rest.remove(part[0])
        while len(part) < width:
            part.append(max(rest, key=lambda i: (close[i, part].sum(), -i)))
            rest.remove(part[-1])
        parts.append(sorted(part))
    return parts


def allocate(n: int, together: np.ndarray, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Parts with their thresholds (parts with threshold -1 are left out), at the least expected cost over 1 to radius + 1 parts.

    Of equal costs more parts win, which probe less. A part that would probe more than ``MOST_PROBES``
    values a row is never chosen; radius + 1 parts with threshold 0 always remain.
    """
    n = max(1, n)  # an empty table is planned like one row
    p = np.diag(together) / n
    differ = 2 * p * (1 - p)
    best, chosen = np.inf, []
    for m in range(1, radius + 2):
        parts = correlated_parts(n, together, m)
        costs = []
        for part in parts:
            at_most = np.zeros(len(part) + 1)
            at_most[0] = 1.0
            for b in part:  # distribution of the number of differing bits of a random pair
                at_most[1:] = at_most[1:] * (1 - differ[b]) + at_most[:-1] * differ[b]
                at_most[0] *= 1 - differ[b]
            at_most = np.cumsum(at_most)
            balls = np.cumsum([1.0] + [_choose(len(part), d) / 2 for d in range(1, radius + 1)])
            balls[balls > MOST_PROBES] = np.inf
            costs.append([0.0] + [(n * balls[u - 1] if balls[u - 1] < np.inf else np.inf) + COMPARE * n * n / 2 * at_most[min(u - 1, len(part))] for u in range(1, radius + 2)])
        total, picks = np.full((m + 1, radius + 2), np.inf), {}
        total[0, 0] = 0.0
        for g in range(m):
            for used in range(radius + 2):
                for u in range(radius + 2 - used):
                    if (c := total[g, used] + costs[g][u]) < total[g + 1, used + u]:
                        total[g + 1, used + u], picks[g + 1, used + u] = c, u
        if total[m, radius + 1] < np.inf and total[m, radius + 1] <= best:
            best, used, chosen = total[m, radius + 1], radius + 1, []
            for g in range(m, 0, -1):
                u = picks[g, used]
                if u:
                    chosen.append((parts[g - 1], u - 1))
                used -= u
    return chosen


def _choose(n: int, k: int) -> float:
    return float(np.prod([(n - i) / (i + 1) for i in range(k)]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def postings(nodes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """part, key (the fingerprint's bits in the part, or a value near it), fp, home (its own value). Probes go to larger values only:
    of two differing values the smaller one's fingerprint finds the larger one's."""
    found, carried = [], _carried(nodes)
    for g, (part, threshold) in enumerate(plan):
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in part))))
        flips = [_signed(sum(1 << b for b in c)) for d in range(1, threshold + 1) for c in itertools.combinations(part, d)]
        rows = nodes.select(F.lit(g).cast("byte").alias("part"), own.alias("key"), "fp", F.lit(True).alias("home"), *carried)
        if flips:
            flipped = nodes.select(F.lit(g).cast("byte").alias("part"), "fp", *carried, own.alias("own"), F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip"))
            flipped = flipped.select("part", F.col("own").bitwiseXOR(F.col("flip")).alias("key"), "fp", F.lit(False).alias("home"), *carried, "own").where("key > own")
            rows = rows.unionByName(flipped.drop("own"))
        found.append(rows)
    whole = found[0]
    for rows in found[1:]:
        whole = whole.unionByName(rows)
    return whole


def surely_apart(similarity: float) -> int:
    """Bits by which wide fingerprints of this similarity hardly ever differ: those expected are the share of angle / pi, with cosine
    2 s / (1 + s)."""
    n, p = 64 * len(WIDE), math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(n * p + SLACK * math.sqrt(n * p * (1 - p)))


def _near(x: np.ndarray, y: np.ndarray, radius: int, apart: int) -> np.ndarray:
    """Which rows are linked; columns are the fingerprint and, if carried, the words of the wide one."""
    near = np.bitwise_count((x[..., 0] ^ y[..., 0]).view(np.uint64)) <= radius
    if y.shape[1] > 1 and near.any():
        at = np.flatnonzero(near)
        x = x if x.ndim == 1 else x[at]
        wide = slice(1, 1 + len(WIDE))
        near[at] = np.bitwise_count((x[..., wide] ^ y[at, wide]).view(np.uint64)).sum(axis=1, dtype=np.int64) <= apart
    return near


def _forest(fps: np.ndarray, radius: int, apart: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among fps: each found row leaves the set that is still looked through."""
    rest, links = fps[np.unique(_names(fps), return_index=True)[1]], []
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = _near(x, rest, radius, apart)
            if near.any():
                links += [(int(_names(x)), int(y)) for y in _names(rest[near])]
                front += list(rest[near])
                rest = rest[~near]
    return links


def _runs(batches: Iterator[pa.RecordBatch], keys: int, rows: int = 1 << 17) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut only between runs of equal values in the first ``keys`` columns."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        columns = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(held[0].num_columns)]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:keys]], axis=0))
        if len(new):
            cut = int(new[-1]) + 1
            yield [c[:cut] for c in columns]
            columns = [c[cut:] for c in columns]
        held, n = [pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[str(i) for i in range(len(columns))])], len(columns[0])
    if n:
        yield [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(held[0].num_columns)]


def _links(pairs: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate(pairs) if pairs else np.zeros((0, 2), dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["a", "b"])


def links_in_buckets(rows: DataFrame, keys: list[str], radius: int, apart: int = 0) -> DataFrame:
    """Spanning links (a, b) inside buckets; rows are keys, home and fp (with the wide words), and a pair of two probes needs no look."""
    k, carried = len(keys), _carried(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _runs(batches, k):
            home, fp = columns[k].astype(bool), np.stack(columns[k + 1 :], axis=1)
            new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns[:k]], axis=0)])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(fp)))
            found = [np.array(_forest(fp[s : s + z], radius, apart), dtype=np.int64).reshape(-1, 2) for s, z in zip(starts, sizes, strict=True) if z > SMALL_RUN]
            left = np.repeat(np.where(sizes > SMALL_RUN, 0, sizes), sizes) - (np.arange(len(fp)) - np.repeat(starts, sizes)) - 1
            at = np.flatnonzero(home & (left > 0))  # homes come first, so a probe has only probes behind it
            lag = 1
            while len(at):
                a, b = fp[at], fp[at + lag]
                near = _near(a, b, radius, apart)
                found.append(np.stack([_names(a[near]), _names(b[near])], axis=1))
                lag += 1
                at = at[left[at] >= lag]
            yield _links(found)

    part = rows.select(*keys, "home", "fp", *carried).repartition(*keys).sortWithinPartitions(*keys, F.desc("home"))
    return part.mapInArrow(run, "a long, b long")


def links_between(rows: DataFrame, keys: list[str], radius: int, apart: int = 0) -> DataFrame:
    """Links between the rows with ``minor`` and all rows of a bucket, at most one per row and minor."""
    k, carried = len(keys), _carried(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _runs(batches, k, 1 << 14):
            minor, fp = columns[k].astype(bool), np.stack(columns[k + 1 :], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns[:k]], axis=0)]))
            found = []
            for s, e in zip(starts, np.append(starts[1:], len(fp)), strict=True):
                few, all_rows = (x[np.unique(_names(x), return_index=True)[1]] for x in (fp[s:e][minor[s:e]], fp[s:e][~minor[s:e]]))
                for x in few:
                    near = _names(all_rows[_near(x, all_rows, radius, apart)])
                    found.append(np.stack([np.full(len(near), _names(x)), near], axis=1))
            yield _links(found)

    part = rows.select(*keys, "minor", "fp", *carried).repartition(*keys).sortWithinPartitions(*keys)
    return part.mapInArrow(run, "a long, b long")


def hot_links(hot: DataFrame, sizes: DataFrame, radius: int, apart: int = 0) -> DataFrame:
    """Links inside the buckets of more than BUCKET rows (part, key, home, fp, wide words if any; sizes: part, key, n)."""
    bucket, carried = ["part", "key"], _carried(hot)
    own, wide = "node" if "node" in carried else "fp", [c for c in carried if c in WIDE]
    rows = settle(hot.join(sizes, bucket).withColumn("blocks", F.ceil(F.col("n") / BUCKET).cast("int")), "hot-rows")
    rows = rows.withColumn("block", F.pmod(F.xxhash64(own), F.col("blocks")))
    inside = links_in_buckets(rows, [*bucket, "block"], radius, apart)
    pivots = settle(rows.groupBy(*bucket).agg(F.min(F.struct("fp", *carried)).alias("pivot")), "pivots")
    differ = {c: F.bit_count(F.col(c).bitwiseXOR(F.col(f"pivot.{c}"))) for c in ["fp", *wide]}
    star = rows.join(pivots, bucket).where(differ["fp"] <= radius)
    if wide:
        star = star.where(sum((differ[c] for c in wide), F.lit(0)) <= apart)
    star = star.select(F.col(own).alias("a"), F.col(f"pivot.{own}").alias("b"))
    links = settle(inside.unionByName(star).where("a <> b").distinct(), "hot-links")
    labels = components(links).toDF(own, "label")
    rows = settle(rows.join(labels, own, "left").withColumn("label", F.coalesce("label", own)), "hot-labelled")
    groups = settle(rows.groupBy(*bucket, "label").agg(F.count("*").alias("size")), "hot-groups")
    largest = settle(groups.groupBy(*bucket).agg(F.max(F.struct("size", "label")).alias("top"), F.sum("size").alias("all")).where("top.size < all"), "hot-mixed")
    mixed = rows.join(largest, bucket).withColumn("minor", F.col("label") != F.col("top.label"))
    mixed = mixed.withColumn("chunks", F.ceil((F.col("all") - F.col("top.size")) / BUCKET).cast("int"))
    dealt = mixed.select(*bucket, F.col("block").cast("long").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(False).alias("minor"), "fp", *carried)
    few = mixed.where("minor").select(
        *bucket, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"), F.pmod(F.xxhash64(F.lit(1), own), F.col("chunks")).cast("int").alias("chunk"),
        F.lit(True).alias("minor"), "fp", *carried,
    )
    return links.unionByName(links_between(dealt.unionByName(few), [*bucket, "block", "chunk"], radius, apart))


def linked_fingerprints(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node, label) for every distinct fingerprint that has a link."""
    n, together = bit_statistics(nodes)
    return components(all_links(nodes.select("fp"), allocate(n, together, radius), radius))


def linked_sets(nodes: DataFrame, texts: DataFrame, k: int, radius: int, similarity: float) -> DataFrame:
    """(node, label) for every node (node, fp, wide words, key, mark) with a link of at least ``similarity``; texts: key, mark, text."""
    prints = settle(nodes.groupBy("fp").agg(F.count("*").alias("n")), "prints")
    n, together = bit_statistics(prints)
    plan = allocate(n, together, radius)
    linked = all_links(prints.select("fp"), plan, radius).select(F.explode(F.array("a", "b")).alias("fp"))
    linked = settle(linked.unionByName(prints.where("n > 1").select("fp")).distinct(), "linked")
    nodes = settle(nodes.join(linked, "fp", "left_semi"), "wide-nodes")
    apart, wide = surely_apart(similarity), nodes.select("fp", *WIDE, "node")
    links = settle(all_links(wide, plan, radius, apart).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # One row may repeat id and text: its set is the same.
    sets = texts.join(nodes.join(ends, "node", "left_semi").select("key", "mark", "node"), ["key", "mark"])
    sets = settle(shingle_sets(sets, k).dropDuplicates(["node"]), "shingle-sets")
    checked = settle(similar_links(links, sets, similarity), "checked-links")
    right = checked.where("right").select("a", "b")
    if checked.where("not right").isEmpty():
        return components(right)
    groups = settle(components(links), "candidate-groups").toDF("node", "group")
    open_groups = checked.where("not right").join(groups, F.col("a") == F.col("node")).select("group").distinct()
    joined = settle(components(right), "confirmed").toDF("node", "label")
    unsettled = groups.join(open_groups, "group", "left_semi").join(joined, "node", "left").withColumn("label", F.coalesce("label", "node"))
    unsettled = settle(wide.join(unsettled, "node"), "unsettled")
    rows = settle(postings(unsettled.select("fp", *WIDE, "node"), plan).join(unsettled.select("node", "group", "label"), "node"), "unsettled-postings")
    x, y = (rows.select(*(F.col(c).alias(f"{c}_{side}") if c not in ("part", "key", "group") else F.col(c) for c in rows.columns)) for side in "xy")
    differ = {c: F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y"))) for c in ["fp", *WIDE]}
    more = x.join(y, ["part", "key", "group"]).where(
        (F.col("node_x") < F.col("node_y")) & (F.col("label_x") != F.col("label_y")) & (F.col("home_x") | F.col("home_y"))
        & (differ["fp"] <= radius) & (sum((differ[c] for c in WIDE), F.lit(0)) <= apart)
    )
    more = more.select(F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct().join(checked.select("a", "b"), ["a", "b"], "left_anti")
    return components(right.unionByName(similar_links(settle(more, "more-candidates"), sets, similarity).where("right").select("a", "b")))


def all_links(nodes: DataFrame, plan: list[tuple[list[int], int]], radius: int, apart: int = 0) -> DataFrame:
    """Links (a, b) that connect what is connected among the nodes."""
    rows = settle(postings(nodes, plan), "postings")
    sizes = settle(rows.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET), "hot-buckets")
    if sizes.isEmpty():
        return links_in_buckets(rows, ["part", "key"], radius, apart)
    cold = links_in_buckets(rows.join(sizes, ["part", "key"], "left_anti"), ["part", "key"], radius, apart)
    return cold.unionByName(hot_links(rows.join(sizes, ["part", "key"], "left_semi"), sizes, radius, apart))


def near_duplicates(
    docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text", similarity: float | None = None,
) -> DataFrame:
    """doc_id, mark (hash of the text), fp, component_id (smallest id reachable over links) and component (smallest fingerprint, or node with a similarity), per row."""
    if similarity is not None:
        return _near_sets(docs, k, radius, id_column, text_column, similarity)
    prints = settle(fingerprints(docs, k, SEED, id_column, text_column, mark=True), "fingerprints")
    nodes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    labels = linked_fingerprints(nodes, radius).toDF("fp", "component")
    return prints.join(_named(nodes, labels, "fp"), "fp")  # one fingerprint may hold a third of the rows: two plain scans, which adaptive execution splits


def _named(nodes: DataFrame, labels: DataFrame, own: str) -> DataFrame:
    """``own``, component and component_id of all nodes (``own``, least)."""
    nodes = settle(nodes.join(labels, own, "left").withColumn("component", F.coalesce("component", own)), "labelled")
    named = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    return settle(nodes.join(settle(named, "named"), "component").select(own, "component", "component_id"), "classes")


def _near_sets(docs: DataFrame, k: int, radius: int, id_column: str, text_column: str, similarity: float) -> DataFrame:
    prints = settle(fingerprints(docs, k, SEED, id_column, text_column, mark=True, wide=True), "fingerprints")
    first = F.min(F.struct(id_key("doc_id").alias("key"), "mark")).alias("first")
    nodes = prints.groupBy("node", "fp", *WIDE).agg(F.min("doc_id").alias("least"), first)
    nodes = settle(nodes.select("node", "fp", *WIDE, "least", "first.key", "first.mark"), "nodes")
    texts = docs.select(id_key(F.col(id_column).cast("bigint")).alias("key"), F.xxhash64(whole_text(text_column)).alias("mark"), F.col(text_column).alias("text"))
    labels = linked_sets(nodes.drop("least"), texts, k, radius, similarity).toDF("node", "component")
    return prints.drop(*WIDE).join(_named(nodes.select("node", "least"), labels, "node"), "node").select("fp", "doc_id", "mark", "component", "component_id")


def keep_one(
    docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text", similarity: float | None = None,
) -> DataFrame:
    """The rows of ``docs`` with one of each component: the smallest id (of rows repeating an id, one)."""
    key, mark, place = fresh(docs.columns, "__key"), fresh(docs.columns, "__mark"), fresh(docs.columns, "__place")
    classes = near_duplicates(docs, k, radius, id_column, text_column, similarity)
    stay = classes.groupBy("component").agg(F.min(F.struct(id_key("doc_id").alias("key"), "mark")).alias("first"))
    stay = stay.select(F.col("first.key").alias(key), F.col("first.mark").alias(mark))
    rows = docs.withColumns({key: id_key(F.col(id_column).cast("bigint")), mark: F.xxhash64(whole_text(text_column))})
    once = Window.partitionBy(key, mark).orderBy(key)
    return rows.join(stay, [key, mark], "left_semi").withColumn(place, F.row_number().over(once)).where(F.col(place) == 1).select(*docs.columns)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(documents(spark, folder).select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
