"""Class n-grams, Kneser-Ney, the language network and the pipeline."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import class_lm, exact_dedup, kneser_ney, language_cnn, mixing, simhash
from gleaner.llm.common import fold

FOLDER = "/root/testdata/sf0.001"


def folds(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def test_base_scores_and_held_out_gain(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = class_lm.op3_class_lm(spark, FOLDER).collect()
    texts = {r["doc_id"]: class_lm.words_of(r["text"]) + [b""] for r in docs.collect()}
    seen = collections.Counter(w for i, t in texts.items() if folds(i, 5) != 1 for w in t)
    total = sum(seen.values())
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]]
        base = sum(math.log10((seen[w] + 0.5) / (total + 0.5 * (len(seen) + 1))) for w in t)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (folds(r["doc_id"], 5) == 1, len(t), sum(seen[w] > 0 for w in t), total)
        assert abs(base - r["base_score"]) < 1e-6 * max(1, abs(base))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_add_up():
    rng = np.random.default_rng(0)
    trigrams = rng.integers(0, 50, (4, 4, 4)).astype(float)
    sizes = np.array([1.0, 3, 2, 5])
    words = [rng.multinomial(int(n), np.ones(int(s)) / s) for n, s in zip(trigrams.sum(axis=(0, 1)), sizes, strict=True)]
    scores = class_lm.token_scores(trigrams, sizes)
    for a, b in itertools.product(range(4), repeat=2):
        total = sum(10 ** scores[a, b, c] * ((w + 0.5).sum() + 0.5) for c, w in enumerate(words))
        assert abs(total - 1) < 1e-9


def test_exchange_finds_the_classes(spark):
    rng = random.Random(5)
    groups = [[f"{g}{i}" for i in range(12)] for g in "abc"]
    docs = [(i, " ".join(rng.choice(groups[(i + j) % 3]) for j in range(30))) for i in range(300)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").select(F.col("doc_id").alias("row"), "doc_id", F.lit(False).alias("held_out"), "text")
    words = class_lm.frequent_words(class_lm.word_counts(rows), 100)
    coding = class_lm.Coding(words, 300, 4)
    coded = class_lm.code_texts(rows, coding)
    classes = class_lm.cluster(coded, coding, 5, 8)
    own = {w.decode(): int(classes[coding.codes[w]]) for w, _ in words}
    assert all(len({own[w] for w in g}) <= 2 for g in groups)
    kinds = [{own[w] for w in g} for g in groups]
    assert not (kinds[0] & kinds[1] or kinds[1] & kinds[2] or kinds[0] & kinds[2])
    before = class_lm.context_counts(coded, classes, 5)
    assert before[:, 0].sum() == before[:, 1].sum() == 300 * 31


def test_words_beyond_the_dictionary_find_their_classes(spark):
    """As above, with the frequent third of the words in the dictionary and the others, a fifth of all tokens, moved in tasks."""
    rng = random.Random(6)
    groups = [[f"{g}{i}x{rng.randint(100, 999)}" for i in range(60)] for g in "abc"]
    docs = [(i, " ".join(rng.choice(groups[(i + j) % 3][: 20 if rng.random() < 0.8 else 60]) for j in range(30))) for i in range(300)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").select(F.col("doc_id").alias("row"), "doc_id", F.lit(False).alias("held_out"), "text")
    counts = class_lm.word_counts(rows)
    coding = class_lm.Coding(class_lm.frequent_words(counts, 60), 300, 8)
    coded = class_lm.code_texts(rows, coding)
    classes = class_lm.cluster(coded, coding, 5, 8)
    pairs = class_lm.transition_counts(coded.select("codes"), 5, classes).sum(axis=0)
    contexts = class_lm.rare_contexts(coded, classes, coding.first_suffix, 5)

    code = lambda w: coding.codes.get(w, None) or class_lm.suffix_code(w, coding.first_suffix, 8)
    expected = collections.Counter()
    for _, text in docs:
        tokens = [b"", *text.encode().split(), b""]
        own = [0 if not w else int(classes[code(w)]) for w in tokens]
        for j, w in enumerate(tokens):
            if w and w not in coding.codes:
                expected[w, own[j - 1]] += 1
                expected[w, 5 + own[j + 1]] += 1
    assert {(bytes(r["word"]), c["cell"]): c["n"] for r in contexts.collect() for c in r["cells"]} == dict(expected)

    moved = {bytes(r["word"]).decode(): r["class"] for r in class_lm.move_rare(contexts, counts, classes, coding, pairs).collect()}
    often = collections.Counter(w for _, t in docs for w in t.split())
    assert set(moved) == {w for w, n in often.items() if n >= class_lm.LEAST and w.encode() not in coding.codes}
    kinds = [collections.Counter(c for w, c in moved.items() if w[0] == g) for g in "abc"]
    assert sum(k.most_common(1)[0][1] for k in kinds) >= 0.9 * len(moved) and len({k.most_common(1)[0][0] for k in kinds}) == 3


def test_best_class_by_trying_each():
    rng = np.random.default_rng(2)
    pairs = rng.integers(20, 90, (5, 5)).astype(float)
    left, right = rng.integers(0, 4, (2, 30, 5))
    own = rng.integers(1, 5, 30)
    cells, n, starts = [], [], []
    for w in range(30):
        left[w, 0] += 1
        starts.append(len(cells))
        both = [*left[w], *right[w]]
        cells += [j for j in range(10) if both[j]]
        n += [x for x in both if x]
    got = class_lm.best_classes(own, np.array(cells), np.array(n), np.array(starts), pairs)
    flow = lambda x: sum(v * math.log(v) for v in x.ravel() if v > 0)
    for w in range(30):
        def gain(c):
            joined = flow(pairs[c] - right[w] * (c == own[w]) + right[w]) - flow(pairs[c] - right[w] * (c == own[w]))
            joined += flow(pairs[:, c] - left[w] * (c == own[w]) + left[w]) - flow(pairs[:, c] - left[w] * (c == own[w]))
            for side, x in ((pairs.sum(axis=1), right[w].sum()), (pairs.sum(axis=0), left[w].sum())):
                base = side[c] - x * (c == own[w])
                joined -= flow(np.array([base + x])) - flow(np.array([base]))
            return joined

        assert got[w] == max(range(1, 5), key=gain)


def test_class_scores_by_hand(spark):
    """Whole scores on a small table: class trigrams counted by plain code over the classes that the operator assigned."""
    rng = random.Random(8)
    docs = [(i, " ".join(f"w{min(rng.randint(0, 60), rng.randint(0, 60))}" for _ in range(rng.randint(0, 40)))) for i in range(120)]
    held = F.col("doc_id") % 4 == 1
    tables = {}
    plain = class_lm.settle
    class_lm.settle = lambda df, name: tables.setdefault(name, plain(df, name))
    try:
        rows = class_lm.score_texts(spark.createDataFrame(docs, "doc_id long, text string"), held, words=12, suffixes=4, n_classes=5, rounds=3).collect()
    finally:
        class_lm.settle = plain
    own = {r["doc_id"]: list(r["own"]) for r in tables["classed-texts"].collect()}
    words = {i: [*t.split(), ""] for i, t in docs}
    assert all(len(own[i]) == len(words[i]) and own[i][-1] == 0 and 0 not in own[i][:-1] for i in words)
    class_of = collections.defaultdict(set)
    for i, t in words.items():
        for w, c in zip(t, own[i], strict=True):
            class_of[w].add(c)
    assert all(len(c) == 1 for c in class_of.values())
    train = [i for i in words if i % 4 != 1]
    seen = collections.Counter(w for i in train for w in words[i])
    three, two, one, sizes = (collections.Counter() for _ in range(4))
    for i in train:
        path = [0, 0, *own[i]]
        for a, b, c in zip(path, path[1:], path[2:], strict=False):
            three[a, b, c] += 1
            two[b, c] += 1
            one[c] += 1
    for w in seen:
        sizes[next(iter(class_of[w]))] += 1

    def p(a, b, c):
        p1 = (one[c] + 0.5) / (sum(one.values()) + 2.5)
        p2 = (two[b, c] + 5 * p1) / (sum(two[b, x] for x in range(5)) + 5)
        return (three[a, b, c] + 5 * p2) / (sum(three[a, b, x] for x in range(5)) + 5)

    for r in rows:
        path = [0, 0, *own[r["doc_id"]]]
        score = sum(math.log10(p(*path[j : j + 3]) * (seen[w] + 0.5) / (one[path[j + 2]] + 0.5 * (sizes[path[j + 2]] + 1))) for j, w in enumerate(words[r["doc_id"]]))
        assert abs(score - r["score"]) < 1e-6 * max(1, abs(score))


def test_tables_of_texts_are_packed(spark):
    table = class_lm.settle(spark.createDataFrame([(b"word",)], "word binary"), "packed")
    assert all(".zstd." in name for name in table.inputFiles()) and table.count() == 1


def test_class_lm_odd_rows(spark, odd_docs, no_docs):
    rows = class_lm.score_texts(odd_docs, fold("doc_id", 5) == 1, words=50, suffixes=8, n_classes=6, rounds=2).collect()
    assert len(rows) == odd_docs.count()
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4, 7)} == {1}
    none = class_lm.score_texts(odd_docs, F.lit(True), words=50, suffixes=8, n_classes=6, rounds=2).collect()
    assert {r["n_known"] for r in none} == {0} and {r["train_tokens"] for r in none} == {0}
    assert class_lm.score_texts(no_docs, fold("doc_id", 5) == 1, words=50, suffixes=8, n_classes=6, rounds=1).count() == 0


def kneser_ney_by_hand(train, texts, vocabulary):
    words = collections.Counter(w for t in train for w in t)
    known = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:vocabulary]]
    unseen = max(0, len(words) - len(known)) + 1
    known = set(known)
    symbols = lambda t: ["<s>", "<s>"] + [w if w in known else "<?>" for w in t] + ["</s>"]
    three = collections.Counter(x for t in train for x in zip(*(symbols(t)[i:] for i in range(3)), strict=False))
    two = collections.Counter()
    for (_, b, c), n in three.items():
        two[b, c] += n if b == "<s>" else 1
    one = collections.Counter(c for _, c in two)

    def discount(table):
        n = [sum(1 for x in table.values() if x == i) for i in range(5)]
        if not n[1] or not n[2]:
            return [0.5] * 3
        y = n[1] / (n[1] + 2 * n[2])
        raw = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]

    d1, d2, d3 = discount(one), discount(two), discount(three)
    off = lambda n, d: d[min(n, 3) - 1] if n else 0.0

    def p1(c):
        total = sum(one.values())
        return (one[c] - off(one[c], d1)) / total + sum(off(n, d1) for n in one.values()) / total / (len(known) + 2)

    def p(context, c, table, d, lower):
        inside = {k: n for k, n in table.items() if k[:-1] == context}
        if not inside:
            return lower
        total = sum(inside.values())
        n = inside.get((*context, c), 0)
        return (n - off(n, d)) / total + sum(off(x, d) for x in inside.values()) / total * lower

    out = []
    for t in texts:
        s = symbols(t)
        log = sum(math.log10(p((a, b), c, three, d3, p((b,), c, two, d2, p1(c)))) for a, b, c in zip(s, s[1:], s[2:], strict=False))
        log -= math.log10(unseen) * s.count("<?>")
        out.append(10 ** (-log / (len(t) + 1)))
    return out


@pytest.mark.parametrize(("seed", "hot"), [(0, 400_000), (1, 5), (2, 40)])
def test_perplexity_against_a_plain_model(spark, seed, hot):
    rng = random.Random(seed)
    alphabet = [f"w{i}" for i in range(15)]
    text = lambda: " ".join(rng.choices(alphabet, range(1, 16), k=rng.randrange(0, 25)))
    train, rest = [text() for _ in range(25)], [text() + rng.choice(("", " new", " w1 w1 w1")) for _ in range(20)] + [""]
    codes, singles, weights = kneser_ney.fit(spark.createDataFrame([(t,) for t in train], "text string"), vocabulary=9)
    docs = spark.createDataFrame(list(enumerate(rest + train)), "doc_id long, text string")
    got = {r["doc_id"]: r["perplexity"] for r in kneser_ney.perplexities(docs, codes, singles, weights, ["doc_id"], hot=hot).collect()}
    want = kneser_ney_by_hand([t.split() for t in train], [t.split() for t in rest + train], 9)
    assert np.allclose([got[i] for i in range(len(want))], want, rtol=1e-9)


def test_all_words_of_the_sample_count(spark):
    rng = random.Random(4)
    alphabet = [f"w{i}" for i in range(40_000)] + ["長" * 60 + str(i) for i in range(9)]  # more than 16 bits hold, and longer than 64 bytes
    train = [" ".join(rng.sample(alphabet, 900)) for _ in range(45)] + [" ".join(alphabet[-9:])] * 2
    rest = [" ".join(alphabet[-9:]), " ".join(alphabet[-18:]), "new " * 9]
    docs = spark.createDataFrame(list(enumerate(rest)), "doc_id long, text string")
    got = {r["doc_id"]: r["perplexity"] for r in kneser_ney.perplexities(docs, *kneser_ney.fit(spark.createDataFrame([(t,) for t in train], "text string")), ["doc_id"], hot=1000).collect()}
    want = kneser_ney_by_hand([t.split() for t in train], [t.split() for t in rest], 10**9)
    assert np.allclose([got[i] for i in range(3)], want, rtol=1e-9) and got[0] < got[1] < got[2]


def test_keys_are_those_of_spark(spark):
    x = np.array([0, 0, -5, 2**62, 1, 7], dtype=np.int64)
    rows = spark.createDataFrame([tuple(map(int, x[i : i + 3])) for i in range(4)], "a long, b long, c long")
    got = rows.select(kneser_ney.gram_key("a").alias("i"), kneser_ney.gram_key("a", "b").alias("j"), kneser_ney.gram_key("a", "b", "c").alias("k")).collect()
    assert [tuple(r) for r in got] == list(zip(*(k[:4].tolist() for k in kneser_ney.gram_keys(x)), strict=True))


def test_quality_on_labels(spark):
    rows = kneser_ney.op10_kneser_ney(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    kept = {r["quality"]: r["k"] for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert kept[1] > 0.97 and kept[0] < 0.4


def test_sample_is_not_shrunk(spark):
    assert kneser_ney.classify.__defaults__[1] == kneser_ney.TRAIN_DOCS == 6000


def test_query_and_pipeline_fit_on_all_trusted_documents(spark, monkeypatch):
    """With room for one document in a sample, every trusted document of the model's half is fitted on."""
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    want = labels.join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id"), "doc_id", "left_semi").where(F.xxhash64(F.lit(29), F.col("doc_id").cast("bigint")) % 2 == 0).count()
    seen, plain = [], kneser_ney.fit
    monkeypatch.setattr(kneser_ney.classify, "__defaults__", (kneser_ney.QUANTILE, 1, None))
    monkeypatch.setattr(kneser_ney, "fit", lambda docs, *rest: seen.append(docs.count()) or plain(docs, *rest))
    kneser_ney.op10_kneser_ney(spark, FOLDER)
    corpus_pipeline.quality(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
    assert want > 1 and seen == [want, want]


def test_rare_language_has_its_own_threshold(spark):
    rows = [("en", 100.0 + i % 40) for i in range(400)] + [("fr", 900.0 + 10 * i) for i in range(5)] + [(None, 5000.0)]
    limits, overall = kneser_ney.thresholds(spark.createDataFrame(rows, "lang string, perplexity double"))
    found = {r["of"]: r["own"] for r in limits.collect()}
    assert set(found) == {"en", "fr", None} and 130 < found["en"] < 150
    assert found["fr"] > 940 and found[None] >= 5000  # clean documents of a rare language stay, whatever the frequent one's perplexity is
    assert found["fr"] < 2000 and spark.range(1).select(overall).first()[0] < 1000


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, 1, 0) for i in (1, 1, 5, 6, 8, 9, 77, None)] + [(10, 0, None), (4, None, 0)], "doc_id long, quality int, toxic int")
    rows = kneser_ney.classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(r["kept"] is not None for r in rows)
    kept = kneser_ney.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["kept"] for r in rows)
    none = kneser_ney.classify(odd_docs, labels.limit(0)).collect()
    assert all(r["kept"] and r["threshold"] is None for r in none) and len(none) == odd_docs.count()
    assert kneser_ney.keep_good(no_docs, labels).count() == 0


def test_tables_agree_with_the_network():
    rng = np.random.default_rng(3)
    x = rng.integers(32, 127, (40, language_cnn.WINDOW)).astype(np.uint8)
    net = language_cnn.train(x, rng.integers(0, 3, 40), ["a", "b", "c"], epochs=1)
    features = []
    e = net.embed[x]
    for w, f, b in zip(language_cnn.WIDTHS, net.filters, net.biases, strict=True):
        answers = np.stack([e[:, i : i + w].reshape(len(x), -1) @ f for i in range(language_cnn.WINDOW - w + 1)], axis=1)
        features.append(np.maximum(answers.max(axis=1) + b, 0))
    want = language_cnn._log_softmax(np.concatenate(features, axis=1) @ net.out + net.out_bias)
    assert np.abs(language_cnn.Predictor(net).log_probs(x) - want).max() < 0.01


def test_windows_cover_whole_texts():
    texts = [b"a" * 600, b"", b"b" * 256, b"c"]
    cut, owner, held = language_cnn.windows_of(texts)
    assert owner.tolist() == [0, 0, 0, 2, 3] and held.tolist() == [256, 256, 88, 256, 1]
    assert b"".join(c[:h].tobytes() for c, h in zip(cut, held, strict=True)) == b"".join(texts)


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = language_cnn.op8_language_cnn(spark, "/root/testdata/sf0.1").join(docs, "doc_id").where("held_out").select("lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97 and all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_rows(spark, odd_docs, no_docs):
    net = language_cnn.fit(odd_docs.where("lang is not null"), train_docs=5)
    rows = language_cnn.predict(odd_docs, net, ["doc_id", "component_id"]).collect()
    assert len(rows) == odd_docs.count()
    assert {(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (3, 4, 7)} == {("und", 0.0)}
    assert language_cnn.fit(no_docs) is None
    assert {r["lang_pred"] for r in language_cnn.predict(odd_docs, None, ["doc_id"]).collect()} == {"und"}
    assert language_cnn.predict(no_docs, net, ["doc_id"]).count() == 0
    only = language_cnn.predict_batch(language_cnn.Predictor(net), pa.array(["12 34 !", "日本", "é", None, "x"]).slice(1))
    assert [x == "und" for x in only[0]] == [False, False, True, False]


def test_pipeline_stages(spark, odd_docs, no_docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mix", "pack"]
    for docs in (odd_docs, no_docs):
        before = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            if name != "pack":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
            if name in ("quality", "exact", "near"):
                assert out.count() <= before


def first_of_near_copies(rows, k=5, radius=7, similarity=0.8):
    """Smallest id of each group, over all pairs whose fingerprints are within the radius and whose sets of shingles are similar."""
    hashes = [simhash.shingle_hashes((text or "").encode(), k) for _, text in rows]
    prints, sets = simhash.fold_bits(hashes).view(np.uint64), [set(h) for h in hashes]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i] = root[root[i]]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= radius).tolist():
            both = len(sets[i] & sets[j])
            if both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(least.values())


def test_pipeline_decisions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 1500")
    exact = corpus_pipeline.exact(spark, docs, FOLDER)
    want = {r["doc_id"] for r in docs.groupBy("text").agg(F.max("doc_id").alias("doc_id")).collect()}
    assert {r["doc_id"] for r in exact.select("doc_id").collect()} == want and exact.count() == len(want)
    near = corpus_pipeline.near(spark, docs, FOLDER)
    assert sorted(r["doc_id"] for r in near.select("doc_id").collect()) == first_of_near_copies([tuple(r) for r in docs.select("doc_id", "text").collect()])
    mixed = corpus_pipeline.mixed(spark, docs, FOLDER)
    assert mixed.count() == mixing.mix(docs).count()
    assert corpus_pipeline.packed(spark, mixed, FOLDER).count() == mixed.count()
    assert exact_dedup.OP7_SQL
