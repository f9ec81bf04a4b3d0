"""SimHash near-duplicates, components and nearest neighbours."""

import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gleaner.llm import hnsw, simhash
from gleaner.llm.graph import components


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(1))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(i, i + 1) for i in range(150, 190)] + [(200, j) for j in range(201, 240)]
    want = roots(240, links)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in touched}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text, k=4):
    words = (text or "").encode().translate(simhash.LOWER_ASCII).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s, seed=42).intdigest()
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def test_fingerprints(spark, odd_docs):
    got = simhash.fingerprints(odd_docs, mark=True).withColumn("hex", F.lpad(F.lower(F.hex("fp")), 16, "0")).collect()
    want = {r["m"]: f"{plain_fingerprint(r['text']):016x}" for r in odd_docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("m")).collect()}
    assert len(got) == odd_docs.count() and all(want[r["mark"]] == r["hex"] for r in got)


def test_long_texts_are_folded_in_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    hashes = [rng.integers(0, 2**63, n, dtype=np.int64).tolist() for n in (3, 0, 500, 1, 77)]
    whole = simhash.fold_bits(hashes)
    monkeypatch.setattr(simhash, "HASHES", 50)
    assert (simhash.fold_bits(hashes) == whole).all() and whole[1] == 0


def clustered(seed, n):
    """Fingerprints with chains and dense groups at and around the radius, and bits that hang together."""
    rng = random.Random(seed)
    found = [0]
    while len(found) < n:
        x = rng.getrandbits(64) if rng.random() < 0.4 else rng.choice(found)
        for _ in range(rng.randrange(0, 7)):
            x ^= 1 << rng.randrange(64)
        if rng.random() < 0.5:
            x |= 0xFFF00
        found.append(x)
    return found


@pytest.mark.parametrize(("seed", "bucket", "run"), [(0, 4096, 3), (2, 12, 4)])
def test_links_against_all_pairs(spark, monkeypatch, seed, bucket, run):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "SMALL_RUN", run)
    prints = sorted({simhash._signed(x) for x in clustered(seed, 400)})
    links = [(i, j) for i in range(len(prints)) for j in range(i) if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= 4]
    want = roots(len(prints), links)
    got = {r["node"]: r["label"] for r in simhash.linked_fingerprints(spark.createDataFrame([(x,) for x in prints], "fp long")).collect()}
    assert [got.get(x, x) for x in prints] == [prints[i] for i in want]


def test_plans_without_nodes_or_with_costs_alike_probe_little():
    for radius in (4, 7):
        plan = simhash.allocate(0, np.zeros((64, 64)), radius)
        assert len(plan) == radius + 1 and {t for _, t in plan} == {0} and sorted(b for p, _ in plan for b in p) == list(range(64))
    few = simhash.allocate(1, np.zeros((64, 64)), 7)
    assert sum(t + 1 for _, t in few) == 8 and all(sum(simhash._choose(len(p), d) for d in range(1, t + 1)) <= 2 * simhash.MOST_PROBES for p, t in few)


def test_verified_links_against_all_pairs(spark):
    """Texts around the similarity: what is linked, over fingerprints within the radius, equals all pairs."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    texts = []
    for _ in range(8):
        base = [rng.choice(words) for _ in range(rng.choice([60, 200, 400]))]
        for _ in range(14):
            changed = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
                changed[rng.randrange(len(base))] = rng.choice(words)
            texts.append(" ".join(changed))
    prints = [int(x) & (2**64 - 1) for x in simhash.fold_bits([simhash.shingle_hashes(t.encode(), 5) for t in texts])]
    close = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 7]
    links = [(i, j) for i, j in close if jaccard(texts[i], texts[j], 5) >= 0.8]
    assert 0 < len(links) < len(close)
    want = roots(len(texts), links)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(rows, k=5, radius=7, similarity=0.8).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_similar_texts_stay_once(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    texts = [[rng.choice(words) for _ in range(600)] for _ in range(12)]
    near = [[*t[:300], "other", *t[301:]] for t in texts[:6]]  # five shingles of 596 differ
    half = [[*t[:300], *[rng.choice(words) for _ in range(300)]] for t in texts[6:]]
    rows = [(i, " ".join(t), "x") for i, t in enumerate(texts + near + half)] + [(90, None, "x"), (91, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, w1 string")
    kept = simhash.keep_one(df, k=5, radius=7, similarity=0.8)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(12), *range(18, 24), 90]


def jaccard(a, b, k):
    a, b = (set(simhash.shingle_hashes(t.encode(), k)) for t in (a, b))
    return len(a & b) / len(a | b)


def test_repeated_passages_are_not_near_copies(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(9000)]
    passage = [rng.choice(words) for _ in range(60)]
    texts = [" ".join(passage * 50 + [rng.choice(words) for _ in range(300)]) for _ in range(4)]
    assert jaccard(texts[0], texts[1], 5) < 0.2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert simhash.keep_one(df, k=5, radius=7, similarity=0.8).count() == 4


def test_texts_of_one_fingerprint_are_verified(spark, monkeypatch):
    fold = simhash.fold_bits
    monkeypatch.setattr(simhash, "fold_bits", lambda hashes, word=0: fold(hashes, word) if word else np.zeros(len(hashes), dtype=np.int64))
    docs = spark.createDataFrame([(i, " ".join(f"{i}x{j}" for j in range(200))) for i in range(3)] + [(3, " ".join(f"1x{j}" for j in range(199)))], "doc_id long, text string")
    prints = simhash.fingerprints(docs, 5, mark=True, wide=True).toArrow()
    monkeypatch.undo()
    nodes = spark.createDataFrame(prints).withColumns({"fp": F.lit(0).cast("long"), "key": F.col("doc_id")})
    texts = docs.select(F.col("doc_id").alias("key"), F.xxhash64("text").alias("mark"), "text")
    node = {r["doc_id"]: r["node"] for r in nodes.collect()}
    got = {r["node"]: r["label"] for r in simhash.linked_sets(nodes, texts, 5, 7, 0.8).collect()}
    assert set(got) == {node[1], node[3]} and len(set(got.values())) == 1


@pytest.mark.parametrize("bucket", [4096, 8])
def test_failed_links_hide_no_right_ones(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = []
    for _ in range(40):  # many similarities around 0.8
        t = list(base)
        for _ in range(rng.randrange(0, 14)):
            t[rng.randrange(300)] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(t))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    fps = simhash.fold_bits([simhash.shingle_hashes(t.encode(), 5) for t in texts])
    near = [(i, j) for i in range(40) for j in range(i) if (int(fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 7]
    right = [(i, j) for i, j in near if jaccard(texts[i], texts[j], 5) >= 0.8]
    assert 0 < len(right) < len(near)
    want = roots(40, right)
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df, k=5, radius=7, similarity=0.8).collect()} == dict(enumerate(want))


@pytest.mark.parametrize("plan", [[(list(range(20)), 2), (list(range(20, 42)), 0), (list(range(42, 64)), 0)]])
def test_every_allocation_finds_the_same(spark, monkeypatch, plan):
    prints = sorted({simhash._signed(x) for x in clustered(7, 60)})
    nodes = spark.createDataFrame([(x,) for x in prints], "fp long")
    monkeypatch.setattr(simhash, "allocate", lambda *_: plan)
    links = [(i, j) for i in range(len(prints)) for j in range(i) if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= 4]
    want = roots(len(prints), links)
    got = {r["node"]: r["label"] for r in simhash.linked_fingerprints(nodes).collect()}
    assert [got.get(x, x) for x in prints] == [prints[i] for i in want]


@pytest.mark.parametrize("n", [1, 10, 10_000, 10**8, 10**10])
def test_allocations_are_complete(n):
    rng = np.random.default_rng(1)
    bits = (rng.random((500, 64)) < rng.random(64)).astype(float)
    together = bits.T @ bits * (n / 500)
    plan = simhash.allocate(n, together)
    assert sum(t + 1 for _, t in plan) == simhash.RADIUS + 1 and all(t >= 0 for _, t in plan)
    used = [b for part, _ in plan for b in part]
    assert len(used) == len(set(used))


def test_near_duplicates_odd_rows(spark, odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    blank = {r["component_id"] for r in rows if r["fp"] == 0}
    assert blank == {3}  # nulls and blanks are linked; the null id does not name the component
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({r["component"] for r in rows})
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


def brute(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = min(good.get(i, v), v)
    found = {}
    for q in sorted(good):
        if q % 20 == 0:
            scores = [(-sum(float(a) * float(b) for a, b in zip(good[q], v, strict=True)), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
            found[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return found


def answers(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return found


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(2)
    base = [np.float32(rng.normal(size=6) * rng.choice([0.1, 1, 30])).tolist() for _ in range(50)]
    rows = [(i, base[i % 50] if i % 3 else base[0]) for i in range(200)] + [(400, [1.0, 2.0]), (401, [0.5, 2.0]), (420, [3.0, -1.0])]
    rows += [(500, None), (520, [0.0] * 6), (540, [float("nan")] * 6), (560, []), (580, [None] * 6), (600, [float("inf")] + [0.0] * 5), (None, base[1]), (20, base[0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    for shard_rows in (8192, 20):
        got = answers(hnsw.nearest(df, F.col("vec_id") % 20 == 0, 20, shard_rows))
        want = brute(rows, 20)
        assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
        assert all(abs(a[1] - b[1]) < 1e-9 for q in want for a, b in zip(got[q], want[q], strict=True))
    assert hnsw.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = answers(hnsw.nearest(df, F.col("vec_id") % 20 == 0, 20, 700))
    ids, vectors = zip(*((r["vec_id"], r["embedding"]) for r in df.collect()), strict=True)
    v = np.array(vectors, dtype=np.float64)
    hits = total = 0
    for q, found in got.items():
        s = v @ v[ids.index(q)]
        s[ids.index(q)] = -np.inf
        best = {ids[i] for i in np.argsort(-s)[:20]}
        hits += len(best & {i for i, _ in found})
        total += 20
    assert len(got) == sum(i % 20 == 0 for i in ids) and hits / total >= 0.9


def test_unequal_lengths_keep_their_recall():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(3000, 16)) * np.exp(rng.normal(size=(3000, 1)))
    v[0] *= 1e5
    order, layers = hnsw.build_graph(v)
    base = hnsw.equal_lengths(v[order])
    q = v[1:200]
    lifted = np.concatenate([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((len(q), 1))], axis=1).astype(base.dtype)
    found, _ = hnsw.beam_search(base, layers[-1], lifted, hnsw._descend(base, layers[:-1], lifted), hnsw.SEARCH_WIDTH)
    best = np.argsort(-(q @ v.T), axis=1)[:, :20]
    hits = sum(len(set(order[f[:20]]) & set(b)) for f, b in zip(found, best, strict=True))
    assert hits / best.size >= 0.9
