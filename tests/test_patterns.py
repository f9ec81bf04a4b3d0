"""Pattern matching by needed literals, and the early-ending low-information test, against the plain forms."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import text as tx

PATTERNS = [
    *[p for _, p in [*fv.AI_SIGNALS, *fv.GAME_SIGNALS, *fv.CROSS_SIGNALS, *fv.VALUE_SIGNALS]],
    fv.SCORER_TUTORIAL_PATTERN, fv.SCORER_GOSSIP_PATTERN, fv.SCREEN_TUTORIAL_PATTERN, fv.SCREEN_REPOST_PATTERN,
    r"the\s+and|of the", r"\bthem?\b", r"ab*c", r"a+b", r"(?:^|[^a-z])the(?:[^a-z]|$)", r"\b(a|bc?)\b", "x|", r"ab\s*", "(ab|ba)",
]


@pytest.mark.parametrize(
    ("pattern", "found"),
    [
        (r"\bai\b", (["ai"], False)), ("人工智能", (["人工智能"], True)), ("a|bc", (["a", "bc"], True)), (r"\bagents?\b", (["agent"], False)),
        (r"\b(how to|tips)\b", (["how to", "tips"], False)), ("(?:ab|cd)", (["ab", "cd"], True)), (r"游戏\s*\+\s*ai", None), (r"the\s+and|of the", (["the", "of the"], False)),
        ("[a-z]", None), ("a?", None), ("x|", None), ("ab+c", (["ab"], False)), ("ab{2}", None), (r"\d", None),
    ],
)
def test_literals_that_a_pattern_needs(pattern, found):
    assert tx.literals(pattern) == found


def test_matches_equal_the_regular_expression(spark):
    rng = random.Random(2)
    bits = ["ai", "agent", "agents", "them", "the", "and", "of", " ", " ", "\n", " ", "_", "游戏", "ai游戏", "how to", "tips", "announce", "launch", "a", "b", "c", "bc", "abbc", "人工智能", ".", "x"]
    texts = ["", None, *("".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(2000))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in PATTERNS:
        boundary = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"
        plain = re.compile(pattern.replace(r"\b", boundary).replace(r"\s", tx.WS.replace(r"\x{", r"\u").replace("}", "").replace(r"\uA0", r" ")))
        rows = df.select("t", tx.matches(F.col("t"), pattern).alias("m")).collect()
        assert [r["m"] for r in rows] == [None if r["t"] is None else bool(plain.search(r["t"])) for r in rows], pattern


def test_low_information_equals_collapsing_and_splitting(spark):
    rng = random.Random(3)
    bits = ["word", "a", "é", "😀", " ", "  ", "\n", " ", "　", "\t", ".", "!", "。", "?", "..", ". "]
    texts = ["", None, " ", "...", "." * 200, " . " * 200, "x" * 159, "x" * 160, "a. b. c", "x" * 160 + ". b. c", " " * 300 + "a.b.c", "a " * 80 + ".b.c", "x" * 100_000]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 140))) for _ in range(2000)]

    def plain(t):
        compact = re.sub(f"[{tx._BLANKS}]+", " ", t).strip(" ")
        parts = [p for p in re.split("[。！？.!?]", compact) if p.strip(tx._BLANKS)]
        return len(compact) < 160 or len(parts) < 3

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.is_low_information(F.col("t")).alias("m")).collect()
    assert [r["m"] for r in rows] == [None if r["t"] is None else plain(r["t"]) for r in rows]
