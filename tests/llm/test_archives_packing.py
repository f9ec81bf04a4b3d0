"""WARC archives and packing."""

import gzip
import itertools
import random

import numpy as np
import pytest

from gleaner.llm import packing, warc
from gleaner.llm.common import scratch


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip_over_any_ranges(spark):
    rng = random.Random(1)
    rows = [(i, f"http://x.org/{i} é\r\nA: b", "".join(rng.choice("abcdeé \n<>") for _ in range(rng.choice((0, 5, 300, 40_000))))) for i in range(80)]
    rows += [(100, None, None), (101, "u", rows[3][2]), (None, "v", "only null"), (102, "w", "\x1f\x8b\x08WARC/1.1\r\n" * 40)]
    path = scratch(spark, "warc-test")
    warc.write_archives(pages(spark, rows).repartition(3), path)
    whole = None
    for size in (1 << 24, 9000, 700):
        got = warc.read_archives(spark, path, size).collect()
        assert all(r["error"] is None for r in got)
        found = sorted((r["page_id"] is None, r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_digest"], r["payload_bytes"], bytes(r["payload"])) for r in got)
        whole = whole or found
        assert found == whole and len(found) == len(rows)
    html = {i: (h or "").encode() for i, _, h in rows}
    first = {}
    for i in sorted(k for k in html if k is not None):
        first.setdefault(html[i], i)
    for null, page, kind, refers, digest, n, payload in whole:
        body = html[None if null else page]
        assert digest == warc.sha1_base32(body) and n == len(body)
        if null or first[body] == page:
            assert (kind, refers, payload) == ("response", None, body)
        else:
            assert (kind, refers, payload) == ("revisit", first[body], b"")


def test_header_of_any_length(spark):
    rng = random.Random(2)
    urls = [" " * 200_000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789/", k=200_000)), "".join(rng.choices("abcdefghijklmnopqrstuvwxyz/", k=3_000_000)), "short"]
    path = scratch(spark, "warc-long")
    warc.write_archives(pages(spark, [(i, u, f"page {i}") for i, u in enumerate(urls)]).coalesce(1), path)
    for size in (1 << 24, 50_000):
        got = warc.read_archives(spark, path, size).collect()
        assert {r["page_id"]: r["target_uri"] for r in got} == {i: u.replace(" ", "%20") for i, u in enumerate(urls)}
        assert len(got) == len(urls) and all(r["error"] is None for r in got)


def test_archives_are_plain_gzip(spark, tmp_path):
    warc.write_archives(pages(spark, [(1, "a", "x"), (2, "b", "y")]).coalesce(1), f"file://{tmp_path}/w")
    text = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("part-*"))
    assert text.count(b"WARC/1.1\r\n") == 2 and b"<urn:page:2>" in text


def test_long_record_ends_in_an_empty_member():
    member = warc.encode_record(1, None, bytes(range(1, 200)) * 90_000, None)
    assert member[-1] == 0 and gzip.decompress(member).startswith(b"WARC/1.1")


def test_damaged_member_is_reported_and_reading_goes_on(spark, tmp_path):
    members = [warc.encode_record(i, f"u{i}", b"payload %d " % i * 500, None) for i in range(4)]
    broken = bytearray(members[1])
    broken[len(broken) // 2] ^= 0xFF
    (tmp_path / "w").mkdir()
    (tmp_path / "w/a.warc.gz").write_bytes(members[0] + bytes(broken) + b"junk" + members[2] + members[3])
    got = warc.read_archives(spark, f"file://{tmp_path}/w", 50).collect()
    assert sorted(r["page_id"] for r in got if r["error"] is None) == [0, 2, 3]
    assert sum(r["error"] is not None for r in got) <= 1


def test_least_bytes_and_empty_table(spark):
    path = scratch(spark, "warc-least")
    warc.write_archives(pages(spark, [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "long"), (4, "d", "long")]), path, least_bytes=3)
    assert sorted((r["page_id"], r["record_type"]) for r in warc.read_archives(spark, path).collect()) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]
    path = scratch(spark, "warc-none")
    warc.write_archives(pages(spark, []), path)
    assert warc.read_archives(spark, path).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_bounds_are_optimal(seed):
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(1, 60, 11))
    counts = rng.integers(1, 30, len(lengths))
    padding = lambda bounds: sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts, strict=True))
    for buckets in (1, 2, 3, 5):
        best = min(padding([*map(int, c), int(lengths[-1])]) for c in itertools.combinations(lengths[:-1], min(buckets, len(lengths)) - 1))
        got = packing.optimal_bounds(lengths, counts, lengths * counts, buckets)
        assert len(got) <= buckets and padding(got) == best


def test_batches_fill_their_budget(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, "w " * rng.randint(0, 200)) for i in range(700)], "doc_id long, text string")
    shards, packing.SHARD_ROWS = packing.SHARD_ROWS, 90
    try:
        rows = packing.pack(docs, buckets=4, budget=1000).collect()
    finally:
        packing.SHARD_ROWS = shards
    assert len(rows) == 700 and len({(r["bucket"], r["batch"], r["slot"]) for r in rows}) == 700
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r["bucket"], r["batch"])), key=lambda r: r["bucket"]):
        group = list(group)
        capacity = 1000 // group[0]["bucket_length"]
        sizes = [len(list(g)) for _, g in itertools.groupby(group, key=lambda r: r["batch"])]
        assert all(s == capacity for s in sizes[:-1]) and 0 < sizes[-1] <= capacity
        assert all(r["n_tokens"] + r["padding"] == r["bucket_length"] and r["padding"] >= 0 for r in group)


def test_packing_odd_rows(spark, odd_docs, no_docs):
    rows = packing.pack(odd_docs, buckets=3, budget=100).collect()
    assert len(rows) == odd_docs.count() and {r["n_tokens"] for r in rows if r["doc_id"] == 3} == {1}
    long = [r for r in rows if r["n_tokens"] > 100]
    assert len({(r["bucket"], r["batch"]) for r in long}) == len(long) == 2
    assert packing.pack(no_docs).count() == 0


def test_long_lengths_are_exact(spark):
    """Lengths far above any text, all distinct: bounds by the plain programme over every distinct length."""
    docs = spark.range(400).selectExpr("id AS doc_id", "'' AS text")
    length = (packing.F.col("doc_id") * packing.F.col("doc_id") * 97 + 1) * packing.F.when(packing.F.col("doc_id") % 7 == 0, 3).otherwise(1)
    rows = packing.pack(docs, buckets=5, length=length).collect()
    assert len(rows) == 400 and all(r["padding"] >= 0 for r in rows)
    sizes = sorted(r["n_tokens"] for r in rows)
    best = [[sum(sizes[j] - x for x in sizes[: j + 1]) for j in range(400)]]
    sums = list(itertools.accumulate(sizes, initial=0))
    for _ in range(4):
        best.append([min([best[-1][j], *(best[-1][i] + sizes[j] * (j - i) - (sums[j + 1] - sums[i + 1]) for i in range(j))]) for j in range(400)])
    assert sum(r["padding"] for r in rows) == best[-1][-1]


def test_many_distinct_lengths_at_once():
    """A histogram far longer than a test table's: no cheaper bound next to any of those found."""
    rng = np.random.default_rng(9)
    lengths = np.cumsum(rng.integers(1, 9, 200_000))
    counts = rng.integers(1, 50, 200_000)
    bounds = packing.optimal_bounds(lengths, counts, lengths * counts, 8)
    c, s = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(lengths * counts)])
    at = np.searchsorted(lengths, bounds)
    cost = lambda i, j: lengths[j] * (c[j + 1] - c[i + 1]) - (s[j + 1] - s[i + 1])
    for low, mid, high in zip([-1, *at], at, at[1:], strict=False):
        between = np.arange(low + 1, high)
        assert (cost(low, between) + cost(between, high)).min() == cost(low, mid) + cost(mid, high)


def test_rows_without_id_are_dealt_by_text(spark):
    docs = spark.range(300).selectExpr("CAST(null AS long) AS doc_id", "concat('w', id) AS text")
    shards, packing.SHARD_ROWS = packing.SHARD_ROWS, 30
    try:
        rows = packing.pack(docs, buckets=2, budget=20).collect()
    finally:
        packing.SHARD_ROWS = shards
    assert len({(r["batch"], r["slot"]) for r in rows}) == 300
