"""Claims traced in evidence against a plain count of words."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import text as tx
from gleaner.operators import selection as sl


def stems(text):
    return [re.sub("(?:ing|ed|es|s)$", "", w) for w in re.findall("[a-z0-9]+", text.lower())]


def traced(claim, text):
    known = set(stems(text))
    claimed = [t for t in stems(claim) if len(t) > 3 and t not in fv.SELECTION_STOP_WORDS]
    return bool(claimed) and sum(t in known for t in claimed) / len(claimed) >= 0.5


@pytest.mark.parametrize("seed", [1, 2])
def test_traced_claims_equal_a_plain_count(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"word{rng.randrange(900)}{end}" for end in ("", "s", "ing", "ed") for _ in range(200)]
    rows = []
    for i in range(60):
        n = rng.choice([5, 40, 400])
        # words that are in the text only as the middle of another one are not evidence
        text = " ".join(rng.choice(vocabulary) if rng.random() < 0.7 else "x" + rng.choice(vocabulary) for _ in range(n))
        claim = " ".join(rng.choices(text.split() if i % 3 else vocabulary, k=rng.choice([3, 30, 300])) + rng.choices(vocabulary, k=rng.choice([0, 20])))
        rows.append((i, claim, text))
    data = spark.createDataFrame(rows, "n int, claim string, raw_content string")
    empty = {c: F.lit("") for c in sl._EVIDENCE if c != "raw_content"} | {c: F.array().cast("array<string>") for c in sl._EVIDENCE_LISTS}
    found = tx.settle(data.withColumns(empty), {"traced": sl.claims_trace(F.col("claim"))})
    assert {r["n"]: r["traced"] for r in found.collect()} == {n: traced(claim, text) for n, claim, text in rows}
    assert 5 < sum(traced(claim, text) for _, claim, text in rows) < 55


def test_repeats_of_a_long_claim_are_not_counted_pair_by_pair(spark):
    """Sorted and gone through once; a look-up of each token among the known ones took the square of a text's words."""
    words = [f"w{i}" for i in range(60)]
    rows = [(words * 3, words[::2]), (["b", "a", "b"], ["b"]), (["a"], []), ([], [])]
    data = spark.createDataFrame(rows, "tokens array<string>, some array<string>")
    assert [r[0] for r in data.select(sl.repeats_of(F.col("tokens"), F.col("some"))).collect()] == [90, 2, 0, 0]
