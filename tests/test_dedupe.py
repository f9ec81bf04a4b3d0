"""Duplicate marking and ingest against plain sequential loops."""

import datetime as dtm
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from gleaner.operators import dedupe as dd
from gleaner.operators import setjoin as sj
from gleaner.session import cut_lineage

START = dtm.datetime(2026, 5, 1)
SCHEMA = (
    "id string, arrival bigint, source_url string, article_title string, raw_content string, published_at timestamp_ntz, "
    "collected_at timestamp_ntz, source_type string, source_weight int, duplicate_of string"
)


def words(text):
    return set(re.findall("[a-z0-9]{3,}", text.lower()))


def jac(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def similarity(a, b):
    t, s = jac(words(a["article_title"]), words(b["article_title"])), jac(words(a["raw_content"]), words(b["raw_content"]))
    return 0.0 if t == 0 and s == 0 else max(t * 0.65 + s * 0.35, 0.78 if t == 1 else 0.0)


def digest(text):
    return " ".join(text.split()).lower()


def better(new, old):
    def rank(x):
        return (x["source_type"] != "official", x["published_at"], -x["source_weight"], x["collected_at"])

    return rank(new) < rank(old)


def best_of(item, earlier):
    """(match, score) the way one row after another is taken in: first exact hit, else the best score, first on ties."""
    top, score = None, 0.0
    for other in earlier:
        if other["source_url"] == item["source_url"] or (digest(item["raw_content"]) and digest(other["raw_content"]) == digest(item["raw_content"])):
            return other, 1.0
        s = similarity(item, other)
        if s >= 0.66 and s > score:
            top, score = other, s
    return top, score


def sequential_marks(items):
    """Reference outcome: groups grow one item at a time, the group's head is replaced by a better newcomer."""
    root, head = {}, {}
    seen = []
    for item in items:
        match, _ = best_of(item, seen)
        if match is None:
            root[item["id"]] = item["id"]
            head[item["id"]] = item
        else:
            r = root[match["id"]]
            root[item["id"]] = r
            if better(item, head[r]):
                head[r] = item
        seen.append(item)
    outside = {i["id"]: i["duplicate_of"] for i in items if i["duplicate_of"]}
    marks = {}
    for item in items:
        r = root[item["id"]]
        target = outside.get(r, head[r]["id"])
        marks[item["id"]] = None if target == item["id"] else target
    return marks


def random_items(seed, n=90, outside=False):
    rng = random.Random(seed)
    vocabulary = ["alpha", "beta", "gamma", "delta", "engine", "studio", "model", "agent"]
    rows = []
    for i in range(n):
        title = " ".join(rng.sample(vocabulary, rng.choice([0, 1, 2, 3, 4, 5])))
        body = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 2, 4, 6, 9])))
        if rng.random() < 0.15 and rows:
            body = rng.choice(rows)["raw_content"].upper()
        rows.append(
            {
                "id": f"i{i:03d}", "arrival": i, "article_title": title, "raw_content": body,
                "source_url": f"https://e.com/{rng.randrange(n * 3)}",
                "published_at": START + dtm.timedelta(minutes=rng.randrange(30)), "collected_at": START + dtm.timedelta(minutes=100 + i),
                "source_type": rng.choice(["official", "community", "ai_media"]), "source_weight": rng.choice([40, 60, 80]),
                "duplicate_of": f"old{rng.randrange(5)}" if outside and rng.random() < 0.2 else None,
            }
        )
    return rows


def frame(spark, rows):
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed,outside", [(1, False), (2, True), (3, True)])
def test_marks_equal_the_sequential_loop(spark, monkeypatch, seed, outside):
    if seed > 1:
        monkeypatch.setattr(dd, "BLOCK_ROWS", 2)
        monkeypatch.setattr(sj, "FREQUENT", 5)
    rows = random_items(seed, outside=outside)
    marked = dd.mark_duplicates(frame(spark, rows).repartition(3))
    assert {r["id"]: r["duplicate_of"] for r in marked.collect()} == sequential_marks(rows)


def test_best_match_is_the_best_of_all_earlier_items(spark, monkeypatch):
    monkeypatch.setattr(dd, "BLOCK_ROWS", 3)  # larger titles are searched by body tokens
    monkeypatch.setattr(sj, "FREQUENT", 6)  # and title tokens of more sets together with a body token
    rows = random_items(4)
    found = dd.best_matches(cut_lineage(dd.dedupe_keys(frame(spark, rows)))).collect()
    got = {r["id"]: (r["parent"], round(r["score"], 9)) for r in found if r["parent"]}
    expected = {}
    for i, row in enumerate(rows):
        match, score = best_of(row, rows[:i])
        if match:
            expected[row["id"]] = (match["id"], round(score, 9))
    assert got == expected


def test_hot_title_with_a_third_of_the_rows(spark):
    rows = random_items(5, n=60)
    for i in range(30):
        rows[2 * i]["article_title"] = "alpha beta gamma"
    assert {r["id"]: r["duplicate_of"] for r in dd.mark_duplicates(frame(spark, rows)).collect()} == sequential_marks(rows)


@pytest.mark.parametrize("shape", ["one title", "one template"])
def test_comparisons_grow_with_the_rows(spark, monkeypatch, shape):
    """Bodies of their own words under one title, or under titles from one template: what is compared does not grow with the square."""
    monkeypatch.setattr(dd, "BLOCK_ROWS", 64)
    monkeypatch.setattr(sj, "FREQUENT", 64)
    made = []
    real = dd.body_candidates
    monkeypatch.setattr(dd, "body_candidates", lambda met, reps: made.append(real(met, reps).count()) or real(met, reps))
    joined = sj.similar_sets
    monkeypatch.setattr(dd, "similar_sets", lambda *a: made.append(joined(*a).count()) or joined(*a))
    counts = {}
    for n in (400, 800):
        rows = []
        for i in range(n):
            body = " ".join(f"w{i * 20 + j}x" for j in range(20)) + " the report of today"
            title = "daily market report" if shape == "one title" else f"daily market report number{i}"
            rows.append({**random_items(1, n=1)[0], "id": f"i{i:04d}", "arrival": i, "source_url": f"https://e.com/{i}", "article_title": title, "raw_content": body, "duplicate_of": None})
        made.clear()
        found = {r["id"]: (r["parent"], r["score"]) for r in dd.best_matches(cut_lineage(dd.dedupe_keys(frame(spark, rows)))).collect() if r["parent"]}
        counts[n] = sum(made)
        assert set(found.values()) <= {("i0000", 0.78)} and len(found) == (n - 1 if shape == "one title" else 0)
    assert counts[800] <= 2.5 * max(counts[400], 50)


def test_exact_dedupe_is_greedy_in_arrival_order(spark):
    rows = random_items(6, n=120)
    for r in rows:
        r["source_url"] = f"https://e.com/{random.Random(r['id']).randrange(60)}"
    urls, hashes, kept = set(), set(), set()
    for r in rows:
        h = hashlib.sha256(digest(r["raw_content"]).encode()).hexdigest()
        if r["source_url"] not in urls and h not in hashes:
            kept.add(r["id"])
            urls.add(r["source_url"])
            hashes.add(h)
    got = dd.exact_dedupe(cut_lineage(dd.ingest_keys(frame(spark, rows))))
    assert {r["id"] for r in got.collect()} == kept


def test_chain_of_shared_keys_keeps_every_other_row(spark):
    keys = spark.createDataFrame([("a", 1, "u1", "h1"), ("b", 2, "u1", "h2"), ("c", 3, "u2", "h2"), ("d", 4, "u2", "h3")], "id string, arrival int, url_key string, hash_key string")
    assert {r["id"] for r in dd.exact_dedupe(keys).collect()} == {"a", "c"}


def test_near_duplicates_outside_the_window_are_ignored(spark):
    def row(i, url, title, body, collected):
        return {
            "id": i, "arrival": int(collected.timestamp()), "source_url": url, "article_title": title, "raw_content": body, "published_at": collected,
            "collected_at": collected, "source_type": "ai_media", "source_weight": 50, "duplicate_of": None,
        }

    body = "A game studio launched AI NPC tooling for live operations teams."
    old = row("old", "https://e.com/old", "AI NPC tools launch for live ops", body, dtm.datetime(2026, 5, 15, 23))
    new = row("new", "https://e.com/new", "Exclusive: AI NPC tools launched for live ops", body + " today", dtm.datetime(2026, 5, 19, 1))
    for since, expected in ((dtm.datetime(2026, 5, 16, 1), None), (dtm.datetime(2026, 5, 15), "old")):
        found = dd.windowed_near_duplicates(frame(spark, [new]), frame(spark, [old]), F.lit(since).cast("timestamp_ntz")).collect()
        assert [(r["id"], r["duplicate_of"]) for r in found] == [("new", expected)]


def test_preferred_is_official_then_earlier_then_heavier(spark):
    rows = random_items(7, n=3)
    for r, (kind, minute, weight) in zip(rows, [("community", 0, 90), ("official", 9, 40), ("official", 9, 60)]):
        r.update(source_type=kind, published_at=START + dtm.timedelta(minutes=minute), source_weight=weight)
    got = dd.preferred_per(frame(spark, rows).withColumn("g", F.lit(1)), "g").first()["preferred_id"]
    assert got == "i002"


def test_a_large_title_gives_one_candidate_per_searcher_and_tile(spark, monkeypatch):
    """Bodies that all share half of their words under one title: the best matches are found without a list of pairs."""
    for name, value in (("BLOCK_ROWS", 8), ("TILE_ROWS", 16), ("TILE_TOKENS", 7)):
        monkeypatch.setattr(dd, name, value)
    rng, rows, made = random.Random(3), [], []
    for i in range(40):
        body = "the report of today said this about games " + " ".join(f"w{rng.randrange(30)}x" for _ in range(8))
        rows.append({**random_items(1, n=1)[0], "id": f"i{i:04d}", "arrival": i, "source_url": f"https://e.com/{i}", "article_title": "daily market report", "raw_content": body, "duplicate_of": None})
    real = dd.body_candidates
    monkeypatch.setattr(dd, "body_candidates", lambda met, reps: made.append(real(met, reps).count()) or real(met, reps))
    found = {r["id"]: (r["parent"], round(r["score"], 9)) for r in dd.best_matches(cut_lineage(dd.dedupe_keys(frame(spark, rows)))).collect() if r["parent"]}
    expected = {row["id"]: best_of(row, rows[:i]) for i, row in enumerate(rows) if i}
    assert found == {k: (match["id"], round(score, 9)) for k, (match, score) in expected.items()}
    assert 0 < sum(made) <= 40 * 3


def test_late_title_tokens_meet_few_body_tokens(spark):
    """A title token far back in its title leaves little title similarity, so only bodies that agree in their rarest tokens can matter."""
    posts = spark.createDataFrame([("a", 10, p, p) for p in range(6)], "k string, n int, p int, token int")
    titles = spark.createDataFrame([("a", [f"t{i}" for i in range(10)])], "title_key string, title_set array<string>")
    bodies = [("r1", "a", [f"w{i:02d}" for i in range(20)]), ("r2", "a", [f"w{i:02d}" for i in range(20)])]
    reps = spark.createDataFrame(bodies, "id string, partner string, body_set array<string>")
    met = sj.narrowed(posts, dd.title_bodies(posts.select("k").distinct(), titles, reps)).groupBy("p").count().collect()
    # of 20 body tokens, those that leave a body similarity of (0.66 - 0.65 * s) / 0.35 for s = min(10 / 11, (10 - p) / 10)
    assert {r["p"]: r["count"] for r in met} == {0: 17, 1: 16, 2: 13, 3: 9, 4: 5, 5: 1}


def test_similar_titles_meet_at_one_place(spark, monkeypatch):
    """Titles that are all alike: each body goes to one place, not to every partner."""
    rows, moved, real = [], [], dd.written
    for i in range(24):
        title, body = f"alpha beta gamma delta engine studio w{i}x", "the report of today said this about games and studios again " + f"b{i % 7}x c{i % 5}x d{i}x"
        rows.append({**random_items(1, n=1)[0], "id": f"i{i:04d}", "arrival": i, "source_url": f"https://e.com/{i}", "article_title": title, "raw_content": body, "duplicate_of": None})
    monkeypatch.setattr(dd, "written", lambda df, *a: moved.append(df.count()) or real(df, *a) if "partners" in df.columns else real(df, *a))
    monkeypatch.setattr(dd, "PLACE_ROWS", 10)  # and its rows are dealt out
    found = {r["id"]: (r["parent"], round(r["score"], 9)) for r in dd.best_matches(cut_lineage(dd.dedupe_keys(frame(spark, rows)))).collect() if r["parent"]}
    expected = {row["id"]: best_of(row, rows[:i]) for i, row in enumerate(rows) if i}
    assert found == {k: (match["id"], round(score, 9)) for k, (match, score) in expected.items()}
    assert moved == [24]


def test_sketches_leave_out_no_pair_that_matters(spark):
    """Pairs by brute force: those that matter are found, none is below the threshold, and none is without an asking set."""
    rng, rows = random.Random(8), []
    for k in range(60):
        near = set(rng.choice(rows)[1]) if rows and rng.random() < 0.6 else set()
        tokens = {t for t in near if rng.random() < 0.85} | {f"t{rng.randrange(300)}x" for _ in range(rng.choice([1, 3, 20]))}
        other = {f"o{rng.randrange(40)}x" for _ in range(rng.choice([5, 30]))}
        rows.append((k, sorted(tokens), sorted(other), k % 3 == 0, k % 4 > 0))
    sets = spark.createDataFrame(rows, "k bigint, s array<string>, o array<string>, asks boolean, alone boolean")
    sets = sets.select("k", "s", "asks", F.when(F.col("alone"), F.size("o")).otherwise(F.lit(-1)).alias("size"), sj.sketch(F.col("o"), sj.OTHER).alias("other"))
    pairs = sj.similar_sets(sets, 0.4, lambda s: 0.9 - s)
    assert pairs.columns == ["left", "right"]  # no set goes with a pair
    found = {(r["right"], r["left"]): r["similarity"] for r in sj.compared(pairs, sets, 0.4).collect()}
    near, matter = {}, set()
    for i, (k, s, o, asks, alone) in enumerate(rows):
        for k2, s2, o2, asks2, alone2 in rows[i + 1 :]:
            t, b = jac(set(s), set(s2)), jac(set(o), set(o2)) if alone and alone2 else 1.0
            if t >= 0.4 and (asks or asks2):
                near[k, k2] = t
                if b >= 0.9 - t:
                    matter.add((k, k2))
    assert matter and matter <= set(found) <= set(near)
    assert all(abs(found[p] - near[p]) < 1e-12 for p in found)
