"""The item store: batches against a plain loop, runs that fail, days rewritten meanwhile, the key index's plan."""

import datetime as dtm
import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import dedupe as dd
from gleaner.operators.item_store import ItemStore, KeyIndex, long_keys
from gleaner.operators.ledger import Ledger
from gleaner.plans import edition_queries as eq
from gleaner.streaming import ingest as stream
from tests.test_dedupe import SCHEMA, START, digest, similarity

COLUMNS = [c.split(" ")[0] for c in SCHEMA.split(", ")][:-1]


def batch_of(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], SCHEMA.rsplit(", ", 1)[0])


def rank(row, turn):
    return (row["source_type"] != "official", row["published_at"], -row["source_weight"], row["collected_at"], turn, row["arrival"])


def plain_ingest(batches, hours=72):
    """One batch after the other, one row after the other: {id: (duplicate_of, batch)}."""
    stored, urls, texts = [], set(), set()
    for n, batch in enumerate(batches):
        new = []
        for row in sorted(batch, key=lambda r: r["arrival"]):
            url, text = row["source_url"], None if row["raw_content"] is None else digest(row["raw_content"])
            if (url is not None and url in urls) or (text is not None and text in texts):
                continue
            urls.add(url)
            texts.add(text)
            new.append({**row, "duplicate_of": None, "batch": n, "raw_content": row["raw_content"] or ""})
        since = max((r["collected_at"] for r in new), default=START) - dtm.timedelta(hours=hours)
        window = sorted((r for r in stored if r["collected_at"] >= since), key=lambda r: r["arrival"])
        root = {r["id"]: r["id"] for r in window}
        groups = {}
        for i, row in enumerate(new):
            best, score = None, 0.0
            for other in [*window, *new[:i]]:
                s = similarity(row, other)
                if s >= 0.66 and s > score:
                    best, score = other, s
            root[row["id"]] = root[best["id"]] if best else row["id"]
        points = {r["id"]: r["duplicate_of"] for r in window}
        for row in new:
            head = points.get(root[row["id"]]) or root[row["id"]]
            groups.setdefault(head, []).append(row)
        for head, members in groups.items():
            held = next((r for r in window if r["id"] == head), None)
            contenders = [(rank(r, 1), r) for r in members] + ([(rank(held, 0), held)] if held else [])
            here = held is not None or any(r["id"] == head for r in members)
            target = min(contenders, key=lambda c: c[0])[1]["id"] if here else head
            for _, r in contenders:
                if r["id"] != target:
                    r["duplicate_of"] = target
                elif r["batch"] == n:
                    r["duplicate_of"] = None
        stored += new
    return {r["id"]: (r["duplicate_of"], r["batch"]) for r in stored}


def random_batches(seed, batches=3, size=40):
    rng = random.Random(seed)
    vocabulary = ["alpha", "beta", "gamma", "delta", "engine", "studio", "model", "agent"]
    found, texts = [], []
    for n in range(batches):
        rows = []
        for i in range(size):
            text = rng.choice(texts).upper() if texts and rng.random() < 0.2 else " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 4, 6, 9])))
            texts.append(text)
            at = START + dtm.timedelta(hours=40 * n, minutes=i)
            rows.append(
                {
                    "id": f"b{n}-{i:03d}", "arrival": n * 1000 + i, "article_title": " ".join(rng.sample(vocabulary, rng.choice([0, 2, 3, 4]))),
                    "raw_content": None if rng.random() < 0.1 else text, "source_url": None if rng.random() < 0.1 else f"https://e.com/{rng.randrange(150)}",
                    "published_at": at - dtm.timedelta(minutes=rng.randrange(9000)), "collected_at": at, "source_type": rng.choice(["official", "community", "ai_media"]),
                    "source_weight": rng.choice([40, 60, 80]),
                }
            )
        found.append(rows)
    return found


def snapshot(spark, store):
    rows = stream.stored_items(spark, store).collect()
    assert len(rows) == len({r["id"] for r in rows})
    return {r["id"]: (r["duplicate_of"], r["batch_id"]) for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_the_plain_loop(spark, seed):
    batches, store = random_batches(seed), eq.scratch(spark, "store")
    for n, rows in enumerate(batches):
        stream.ingest_batch(batch_of(spark, rows).repartition(3), n, store)
    want = plain_ingest(batches)
    assert any(r["source_url"] is None and r["id"] in want for b in batches for r in b) and any(d for d, _ in want.values())
    assert snapshot(spark, store) == want


def test_rows_without_url_or_content_are_kept(spark):
    rows = spark.createDataFrame(
        [("a", 1, None, "h1"), ("b", 2, None, "h2"), ("c", 3, "u1", None), ("d", 4, "u2", None), ("e", 5, None, None), ("f", 6, "u1", "h9"), ("g", 7, None, "h2"), ("h", 8, "none e", "x")],
        "id string, arrival int, url_key string, hash_key string",
    )
    assert {r["id"] for r in dd.exact_dedupe(rows).collect()} == {"a", "b", "c", "d", "e", "h"}
    store = eq.scratch(spark, "store")
    same = [
        {"id": i, "arrival": n, "source_url": url, "article_title": f"title {i}", "raw_content": text, "published_at": START, "collected_at": START, "source_type": "official", "source_weight": 50}
        for n, (i, url, text) in enumerate([("p", None, "one text"), ("q", None, "other text"), ("r", "https://e.com/r", None), ("s", "https://e.com/s", None), ("t", None, None)])
    ]
    stream.ingest_batch(batch_of(spark, same), 0, store)
    again = [{**r, "id": r["id"] * 2, "arrival": r["arrival"] + 9} for r in same]
    stream.ingest_batch(batch_of(spark, again), 1, store)
    assert set(snapshot(spark, store)) == {"p", "q", "r", "s", "t", "tt"}


def test_a_failed_batch_shows_nothing_and_is_repeated(spark, monkeypatch):
    first, second, third = random_batches(3)
    store = eq.scratch(spark, "store")
    stream.ingest_batch(batch_of(spark, first), 0, store)
    before = snapshot(spark, store)

    append = KeyIndex.append

    def breaks(self, keys, attempt):
        append(self, keys, attempt)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(KeyIndex, "append", breaks)
        with pytest.raises(OSError, match="lost"):
            stream.ingest_batch(batch_of(spark, second), 1, store)
    assert snapshot(spark, store) == before  # rows, marks and keys were written, none is seen
    stream.ingest_batch(batch_of(spark, second), 1, store)
    stream.ingest_batch(batch_of(spark, second), 1, store)
    stream.ingest_batch(batch_of(spark, third), 2, store)
    assert snapshot(spark, store) == plain_ingest([first, second, third])
    runs = {r["id"]: r for r in ItemStore(spark, store).ledger.runs().collect()}
    assert [(r["status"], r["attempts"], r["failures"], r["error"]) for _, r in sorted(runs.items())] == [("completed", 1, 0, None), ("completed", 2, 1, None), ("completed", 1, 0, None)]
    assert runs["batch-1"]["started_at"] < runs["batch-1"]["completed_at"] == runs["batch-1"]["updated_at"]


def test_days_are_rewritten_while_batches_arrive(spark, monkeypatch):
    batches, store = random_batches(4, batches=5, size=15), eq.scratch(spark, "store")
    for rows in batches:  # all on two days, so that folders pile up
        for r in rows:
            r["collected_at"] = START + dtm.timedelta(hours=r["arrival"] // 1000 * 6)
    shop = ItemStore(spark, store)
    for n in range(3):
        stream.ingest_batch(batch_of(spark, batches[n]), n, store)
    before, files = snapshot(spark, store), len(shop.raw(shop.ledger.state()).inputFiles())
    write, seen = ItemStore.write_raw, []

    def meanwhile(self, rows, run):
        write(self, rows, run)
        if run.run_id.startswith("compact"):
            monkeypatch.setattr(ItemStore, "write_raw", write)
            seen.append(snapshot(spark, store))
            stream.ingest_batch(batch_of(spark, batches[3]), 3, store)

    monkeypatch.setattr(ItemStore, "write_raw", meanwhile)
    assert shop.compact(dtm.date(2026, 6, 1)) >= 3
    assert seen == [before] and len(shop.raw(shop.ledger.state()).inputFiles()) < files + 1
    assert snapshot(spark, store) == plain_ingest(batches[:4])
    shop.compact(dtm.date(2026, 6, 1))
    assert shop.compact(dtm.date(2026, 6, 1)) == 0  # one folder a day is left
    stream.ingest_batch(batch_of(spark, batches[4]), 4, store)
    assert snapshot(spark, store) == plain_ingest(batches)


def test_of_two_rewrites_of_the_same_folders_one_counts(spark):
    ledger = Ledger(spark, eq.scratch(spark, "runs"))
    with ledger.run("load") as run:
        run.adds += ["raw/a", "raw/b"]
    with ledger.run("first") as one, ledger.run("second") as two:
        one.adds, one.removes = ["raw/c"], ["raw/a", "raw/b"]
        two.adds, two.removes = ["raw/d"], ["raw/b"]
    state = ledger.state()  # the inner one ended first
    assert state.folders == ["raw/a", "raw/d"] and state.done == {"load", "second"} and state.hidden == [one.attempt]
    assert Ledger(spark, eq.scratch(spark, "none")).state().folders == []


def test_the_index_is_not_shuffled(spark):
    shop = ItemStore(spark, eq.scratch(spark, "store"))
    rows = batch_of(spark, random_batches(5)[0])
    shop.keys.append(dd.ingest_keys(rows), "one")
    shop.keys.append(dd.ingest_keys(rows.where("arrival < 9")), "two")
    seen = shop.keys.seen(dd.ingest_keys(rows), ["two"])
    plan = seen._jdf.queryExecution().executedPlan().toString().replace("\r", "").split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "Bucketed: true" in line)
    join = max(i for i in range(scan) if "SortMergeJoin" in plan[i])
    above = [i for i in range(join + 1, scan) if all(depth(plan[i]) < depth(plan[j]) for j in range(i + 1, scan + 1))]
    assert not any("Exchange" in plan[i] for i in above)
    assert {r["id"] for r in seen.collect()} == {r["id"] for r in long_keys(dd.ingest_keys(rows)).collect()}
    assert shop.keys.seen(dd.ingest_keys(rows), ["one", "two"]).count() == 0
    assert long_keys(dd.ingest_keys(rows).where(F.lit(False))).count() == 0


def plain_roots(batches):
    """Root of every row as known when it came, key by key: {id: (root, replaced)}; all dates are within the window."""
    best, found = {}, {}
    for n, batch in enumerate(batches):
        for row in sorted(batch, key=lambda r: r["arrival"]):
            if row["raw_content"] is None:
                found[row["id"]] = (row["id"], None)
                continue
            k = digest(row["raw_content"])
            mine = (row["source_type"] != "official", row["published_at"], -row["source_weight"], row["collected_at"], n, row["arrival"], row["id"])
            old = best.get(k)
            best[k] = mine if old is None else min(old, mine)
            found[row["id"]] = (best[k][-1], old[-1] if old and old[-1] != best[k][-1] else None)
    return found


@pytest.mark.parametrize("blocks", [None, 5])
def test_running_roots_equal_the_plain_loop(spark, blocks):
    batches, store = random_batches(8), eq.scratch(spark, "roots")
    rng = random.Random(1)
    for rows in batches:  # one text holds a third of all rows
        for r in rows:
            r["collected_at"] = START + dtm.timedelta(minutes=r["arrival"] % 1000)
            r["raw_content"] = "the hot text" if rng.random() < 0.33 else r["raw_content"]
    for n, rows in enumerate(batches):
        stream.follow_roots(batch_of(spark, rows).repartition(3), n, store, blocks=blocks)
        stream.follow_roots(batch_of(spark, rows), n, store)  # done already
    rows = stream.followed_roots(spark, store).collect()
    assert {r["id"]: (r["root"], r["replaced"]) for r in rows} == plain_roots(batches) and len(rows) == sum(map(len, batches))


def test_stored_roots_expire(spark):
    """A stored root lives 72 hours after its key was last seen; the watermark lags 72 hours behind what earlier batches brought."""
    store = eq.scratch(spark, "roots")
    row = {**random_batches(1, batches=1, size=1)[0][0], "source_type": "official", "published_at": START, "source_weight": 50}
    for n, (hours, text) in enumerate([(0, "same"), (100, "same"), (300, "other"), (301, "same"), (302, "same")]):
        at = START + dtm.timedelta(hours=hours)
        stream.follow_roots(batch_of(spark, [{**row, "id": f"r{n}", "arrival": n, "raw_content": text, "collected_at": at}]), n, store)
    roots = {r["id"]: r["root"] for r in stream.followed_roots(spark, store).collect()}
    assert roots == {"r0": "r0", "r1": "r0", "r2": "r2", "r3": "r3", "r4": "r3"}
