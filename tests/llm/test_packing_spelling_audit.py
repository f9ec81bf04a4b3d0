"""Best-fit packing, spelling variants and the filter audit against plain versions."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleaner.llm import best_fit, filter_audit, spelling

FOLDER = "/root/testdata/sf0.001"


# --- best-fit packing


def plain_plan(lengths, capacity):
    """The same method piece by piece: number of sequences."""
    large = sorted((n for n in lengths if 3 * n > capacity), reverse=True)
    rooms = []
    while large:
        a = large.pop(0)
        at = next((i for i, b in enumerate(large) if a + b <= capacity), None)
        rooms.append(capacity - a - (0 if at is None else large.pop(at)))
    for s in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - s)
        else:
            rooms.append(capacity - s)
    return len(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_plan_equals_the_method_piece_by_piece(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 30, 100, 4096])
    kind = r.choice(["even", "small", "large", "few"])
    draw = {"even": lambda: r.randint(1, capacity), "small": lambda: r.randint(1, max(1, capacity // 3)), "large": lambda: r.randint(capacity // 3, capacity), "few": lambda: r.choice([1, capacity // 3, capacity // 2, capacity])}[kind]
    lengths = [max(1, draw()) for _ in range(r.randint(0, 300))]
    counts = Counter(lengths)
    filled, placed = defaultdict(list), Counter()
    for length, first, copies, bins, base, offset in best_fit.plan_sequences(dict(counts), capacity).tolist():
        assert first == placed[length]
        placed[length] += copies * bins
        for b in range(base, base + bins):
            filled[b] += [(offset + c * length, length) for c in range(copies)]
    assert placed == counts
    for rows in filled.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(filled) == plain_plan(lengths, capacity)
    assert sorted(filled) == list(range(len(filled)))


def check_pieces(rows, texts, capacity):
    """Every document's ids are there once, cut only beyond the capacity, and sequences have no gap."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], dtype="<u4").tobytes()
            want[doc, piece, at, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    filled = defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(filled) == plain_plan([n for *_, n, _ in want.elements()], capacity)


@pytest.mark.parametrize("capacity", [4096, 32])
def test_packing_of_odd_rows(spark, odd_docs, no_docs, capacity):
    rows = best_fit.pack_best_fit(odd_docs, capacity).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in odd_docs.collect()], capacity)
    assert best_fit.pack_best_fit(no_docs, capacity).collect() == []


def test_packing_of_documents(spark):
    rows = best_fit.op11_best_fit(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs], 4096)


def test_ids_are_those_of_the_whole_text():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, encoder = Tokenizer.from_file(path), best_fit.Encoder(path)
    r = random.Random(5)
    bits = [" ", "\n", "\t", "\r", " ", "　", "\x0b", "\x0c", "\x1c", "\x85", " ", "a", "Don't", "'S", "e", "́", "̈", "é", "İ", "ΣΑΣ", "7", "١", "!?", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "\x01", "\x00", "한", "ᄀ", "ᅡ", "🎉", "x" * 50]
    texts = ["", *("".join(r.choice(bits) for _ in range(r.randint(1, 30))) for _ in range(3000))]
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        for text, ids in zip(part, encoder.texts_ids(part), strict=True):
            assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_texts_are_cut_at_white_space_only():
    text = "ab  \n cd " * 1000 + "x" * 5000 + " end"
    parts = list(best_fit.windows(text, 100))
    assert best_fit.BLANKS.split(" ".join(parts)) == best_fit.BLANKS.split(text) and len(parts) > 50
    assert list(best_fit.windows("", 100)) == [""] and list(best_fit.windows("x" * 500, 100)) == ["x" * 500]


# --- spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def plain_variants(docs):
    counts = Counter()
    for doc, text in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for word in spelling.RUN.findall(lowered):
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v.encode()), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, words[w], len(near[w]), words.get(forms[w])))
    return out


def variants(docs):
    rows = spelling.spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def test_variants_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    want = plain_variants([tuple(r) for r in docs.collect()])
    got = variants(docs)
    assert got == want and any(r[1] for r in got)


def test_variants_of_odd_rows(spark, odd_docs, no_docs):
    assert variants(odd_docs) == plain_variants([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert variants(no_docs) == set()


def test_variants_of_dense_words(spark):
    """Few letters, so that words have many near ones, repeated bigrams and ties; chains of forms; a very long word."""
    r = random.Random(3)
    words = ["".join(r.choice("abé") for _ in range(r.randint(5, 9))) for _ in range(250)]
    words += ["".join(r.choice("ab") for _ in range(r.randint(9, 14))) for _ in range(250)]
    words += ["a" * n for n in range(5, 14)] + ["ab" * n for n in range(3, 8)] + ["x" * 3000, "x" * 3001, "x" * 2999 + "y"]
    chain = [("abcdefgh", 5), ("abcdefghi", 25), ("abcdefghij", 125), ("abcdefghijk", 625), ("abcdefghijkl", 3125)]
    rows = [(i, " ".join(w for w in words for _ in range(r.choice([1, 3, 5, 9, 30])))) for i in range(4)]
    rows += [(9, " ".join([w.upper() if k % 2 else w for w, n in chain for k in range(n)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = variants(docs)
    assert got == plain_variants(rows)
    assert ("abcdefgh", "abcdefghi", "abcdefghijkl", 5, 1, 25) in got


def test_pivots_are_the_rarest_disjoint_pair():
    r = random.Random(11)
    for _ in range(500):
        word = "".join(r.choice("abcd") for _ in range(r.randint(6, 12)))
        counts = {a + b: r.randint(1, 9) for a in "abcd" for b in "abcd"}
        rank = {g: i for i, (g, _) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0])))}
        places, indexed, _ = spelling.prefix_grams(word, rank)
        assert len(places) == 3 and set(places) <= set(indexed)
        i, j = spelling.pivots(word, places, counts)
        cost = lambda a, b: counts[word[a : a + 2]] + counts[word[b : b + 2]]
        assert j - i >= 2 and cost(i, j) == min(cost(a, b) for a, b in itertools.combinations(places, 2) if b - a >= 2)


# --- filter audit


def plain_audit(docs, labels):
    first = {}
    for doc, text, _ in docs:
        key = -(2**63) if doc is None else doc
        first[text or ""] = min(first.get(text or "", key), key)
    good = {doc for doc, quality, _ in labels if quality == 1 and doc is not None}
    toxic = {doc for doc, _, t in labels if t == 1 and doc is not None}
    fails = []
    for doc, text, source in docs:
        t = text or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w]
        failed = {
            c for c, x in zip("ABCDE", [
                len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                any(c in "#$%&*|" for c in t), (-(2**63) if doc is None else doc) > first[t],
            ], strict=True) if x
        }
        fails.append((source or "", failed, doc in good, doc in toxic))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in fails}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [f for f in fails if f[0] == part]
            gone = []
            for step, c in enumerate(order, 1):
                removed = [f for f in left if c in f[1]]
                redundant = sum(c in f[1] for f in gone)
                left = [f for f in left if c not in f[1]]
                gone += removed
                alone = sum(f[0] == part and f[1] == {c} for f in fails)
                out[part, order, step] = [len(left), len(removed), redundant, alone, sum(f[2] for f in removed), sum(f[3] for f in removed)]
                shapley[part, c] += len(removed)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(docs, labels):
    rows = filter_audit.audit_orders(filter_audit.mask_cells(filter_audit.failure_masks(docs, labels))).select(*COLUMNS).collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def test_audit_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, 1), (3, 1, None), (None, 1, 1), (10, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
    assert audit(odd_docs, labels) == plain_audit(docs, [tuple(r) for r in labels.collect()])
    assert audit(no_docs, labels) == set() and audit(odd_docs, labels.where("false")) == plain_audit(docs, [])


def test_audit_of_documents_by_plain_code_and_sql(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    got = {tuple(r) for r in filter_audit.op13_filter_audit(spark, FOLDER).select(*COLUMNS).collect()}
    assert got == plain_audit([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    assert got == set(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({filter_audit.OP13_SQL})").fetchall())


def test_the_recursion_has_the_same_size_for_any_table(spark):
    steps = filter_audit.prefix_steps(spark)
    assert steps.count() == 325 * 32
    assert steps.where(F.col("removed").cast("int") + F.col("kept").cast("int") + F.col("redundant").cast("int") > 1).count() == 0
