"""Text helpers. Every function takes and returns Columns, so all of it stays inside the JVM plan.

Conventions: white space is the Unicode set plus U+FEFF; lengths count code points; ``\\b`` in a pattern
means an ASCII word boundary (Java's own ``\\b`` does not fire between Han and Latin letters).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import fixed_values as fv

_BLANKS = "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
WS = r"[\t-\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
_WS_NOT_BLANK = WS.replace(" ", "", 1)
# Java's \w is this ASCII class, looked up in one table
_WORD = r"\w"
_ASCII_BOUNDARY = rf"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"
# the range first: the script of a letter is looked up only where there can be Han at all
_HAN = r"[\x{2E80}-\x{10FFFF}&&\p{IsHan}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def settle(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add (or replace) costly columns so that each is evaluated once per row.

    They come out of a one-row generator, which the optimiser neither merges into later projections nor copies into
    filters pushed below it; a plain projection would have its expressions repeated wherever they are used.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def java_pattern(pattern: str) -> str:
    """Rewrite ``\\b`` to an ASCII word boundary and ``\\s`` to the white-space class.

    A boundary before a word (at the start of a branch) or after one needs one look-around only. A single word looks behind
    after it is found, so that the search goes by its letters.
    """
    word = re.fullmatch(r"\\b([A-Za-z0-9_]+)\\b", pattern)
    if word:
        return f"{word[1]}(?<!{_WORD}{word[1]})(?!{_WORD})"
    pattern = re.sub(r"(^|[|(]|\?:)\\b(?=[A-Za-z0-9(])", lambda m: f"{m[1]}(?<!{_WORD})", pattern)
    pattern = re.sub(r"(?<=[A-Za-z0-9)?])\\b(?=$|[|)])", lambda _: f"(?!{_WORD})", pattern)
    return pattern.replace(r"\b", _ASCII_BOUNDARY).replace(r"\s", WS)


def _needed(branch: str) -> tuple[str, bool] | None:
    """The longest literal without which a branch cannot match, and whether it is the whole branch; None: not a plain branch."""
    runs, whole, i = [""], True, 0
    while i < len(branch):
        c, after = branch[i], branch[i + 1 : i + 2]
        if c in "[](){}^$.*+?":
            return None
        if c == "\\":
            if after not in ("b", "s"):
                return None
            whole, i = False, i + 2
            runs.append("")
            if branch[i : i + 1] in ("+", "*", "?"):
                i += 1
            continue
        if after and after in "?*+{":
            if after == "{":
                return None
            runs[-1] += c if after == "+" else ""
            runs.append("")
            whole, i = False, i + 2
            continue
        runs[-1] += c
        i += 1
    longest = max(runs, key=len)
    return (longest, whole) if longest else None


def literals(pattern: str) -> tuple[list[str], bool] | None:
    """For an alternation of words: one literal that each branch needs, and whether finding any of them is a match."""
    wrapped = re.fullmatch(r"(\\b)?\((?:\?:)?([^()]*)\)(\\b)?", pattern)
    found = [_needed(b) for b in (wrapped[2] if wrapped else pattern).split("|")]
    if None in found:
        return None
    bounded = bool(wrapped and (wrapped[1] or wrapped[3]))
    return [f[0] for f in found], not bounded and all(f[1] for f in found)


def matches(text: Column, pattern: str) -> Column:
    """Whether the pattern is found. Texts without any literal that it needs are told apart by byte comparison, without a
    regular expression; most patterns of a dictionary are in few texts."""
    plain = literals(pattern)
    if plain is None:
        return text.rlike(java_pattern(pattern))
    held = reduce(lambda a, b: a | b, [text.contains(word) for word in plain[0]])
    return held if plain[1] else held & text.rlike(java_pattern(pattern))


def null_if_blank(c: Column) -> Column:
    return F.when(c != "", c)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def strip_end(c: Column) -> Column:
    return F.rtrim(c, F.lit(_BLANKS))


def collapse(c: Column) -> Column:
    """White-space runs to one blank, ends trimmed."""
    # a single blank needs no rewriting, so only other runs are matched; visible ASCII is told apart by its range, before the long class
    return F.trim(F.regexp_replace(c, f" (?![!-~]){WS}+|(?![ -~]){_WS_NOT_BLANK}{WS}*", " "))


def head(c: Column, n: int) -> Column:
    """The text up to its ``n``-th character that is not white space, as it is. What looks at fewer characters of a collapsed or stripped
    text, or asks whether it is longer, gets the same from this part."""
    return F.regexp_extract(c, f"^(?:[!-~]|{WS}*+[^{WS[1:-1]}]){{0,{n}}}+", 0)


def line_head(c: Column, n: int) -> Column:
    """Like :func:`head`, with the whole first line that is not blank and ``n`` characters after it."""
    return F.regexp_extract(c, rf"^{WS}*+[^\n]*+(?:[!-~]|{WS}*+[^{WS[1:-1]}]){{0,{n}}}+", 0)


def first_non_blank(*values: Column, default: str | None = None) -> Column:
    cleaned = [null_if_blank(strip(v)) for v in values]
    if default is not None:
        cleaned.append(F.lit(default))
    return F.coalesce(*cleaned)


def normalize_text(c: Column) -> Column:
    return F.lower(collapse(c))


def normalize_title(c: Column) -> Column:
    words = "|".join(fv.TITLE_NOISE_WORDS)
    cleaned = F.regexp_replace(normalize_text(c), r"[^\p{L}\p{N}\s]", " ")
    cleaned = F.regexp_replace(cleaned, java_pattern(rf"\b({words})\b"), " ")
    return collapse(cleaned)


def content_hash(c: Column, blank_is_null: bool = False) -> Column:
    normalized = normalize_text(c)
    digest = F.sha2(normalized, 256)
    return F.when(normalized != "", digest) if blank_is_null else digest


def has_han(c: Column) -> Column:
    return c.rlike(_HAN)


def han_bigrams(c: Column) -> Column:
    """Overlapping pairs inside each Han run; a run of one character stays as it is."""
    runs = F.regexp_extract_all(c, F.lit(f"({_HAN}+)"), 1)
    pairs = F.transform(
        runs,
        lambda run: F.when(F.length(run) == 1, F.array(run)).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(F.length(run) - 1, F.lit(1))), lambda i: F.substr(run, i, F.lit(2)))
        ),
    )
    return F.when(has_han(c), F.flatten(pairs)).otherwise(F.array().cast("array<string>"))


def token_set(c: Column) -> Column:
    """Distinct Han bigrams and ASCII words longer than two characters, lower-cased."""
    words = F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]{3,})"), 1)
    return F.array_distinct(F.concat(han_bigrams(c), words))


def stem(c: Column) -> Column:
    return F.regexp_replace(c, "(?:ing|ed|es|s)$", "")


def stem_tokens(c: Column) -> Column:
    """Token list (repeats kept): Han bigrams, then ASCII words with one suffix removed."""
    words = F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]+)"), 1)
    return F.concat(han_bigrams(c), F.transform(words, stem))


def stem_lookup(c: Column) -> Column:
    """Tokens of :func:`stem_tokens` to look words up in: suffixes are cut in the whole text, so words that are a suffix are missing."""
    cut = F.regexp_replace(F.lower(c), "(?=[eis])(?:ing|ed|es|s)(?![a-z0-9])", "")
    return F.concat(han_bigrams(c), F.split(cut, "[^a-z0-9]+"))


def without(tokens: Column, words: Iterable[str]) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*words))


def claim_tokens(c: Column, stop_words: Sequence[str], keep_han: bool = True) -> Column:
    """Claim words: no stop words, longer than three characters; Han bigrams kept or left out."""
    # words of which the stem is empty are too short anyway
    kept = without(stem_lookup(c), stop_words)
    if keep_han:
        return F.filter(kept, lambda t: t.rlike(_HAN) | (F.length(t) > 3))
    return F.filter(kept, lambda t: (F.length(t) > 3) & ~t.rlike(f"^{_HAN}+$"))


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard of two duplicate-free arrays; 0 when either is empty."""
    counts = F.struct(F.size(F.array_intersect(left, right)).alias("c"), (F.size(left) + F.size(right)).alias("n"))
    return let(counts, lambda x: F.when(x["c"] == 0, F.lit(0.0)).otherwise(x["c"] / (x["n"] - x["c"])))


def overlap_ratio(left: Column, right: Column) -> Column:
    """Share of left chunks present on the right, over the shorter list."""
    a = F.regexp_extract_all(left, F.lit(rf"({_HAN}{{1,2}}|[a-z0-9]+)"), 1)
    b = F.regexp_extract_all(right, F.lit(rf"({_HAN}{{1,2}}|[a-z0-9]+)"), 1)

    def ratio(x: Column) -> Column:
        hits = F.size(F.filter(x["a"], lambda t: F.array_contains(x["b"], t)))
        shorter = F.least(F.size(x["a"]), F.size(x["b"]))
        return F.when(shorter == 0, F.lit(0.0)).otherwise(hits / shorter)

    return let(F.struct(a.alias("a"), b.alias("b")), ratio)


def clamp(c: Column, limit: int, mark: str = "...", tidy: bool = True) -> Column:
    """Trimmed text of at most ``limit`` characters, the cut marked with ``mark``."""

    def cut(text: Column) -> Column:
        start = F.substring(text, 1, limit - len(mark))
        return F.when(F.length(text) <= limit, text).otherwise(F.concat(strip_end(start) if tidy else start, F.lit(mark)))

    return let(strip(c), cut)


def clamp_at(c: Column, limit: Column, mark: str = "...") -> Column:
    """Like :func:`clamp` with a limit per row (null: no limit) and without trimming short texts."""
    head = F.substr(c, F.lit(1), F.greatest(limit - len(mark), F.lit(0)))
    cut = F.concat(strip_end(head), F.lit(mark))
    plain = F.substr(c, F.lit(1), limit)
    return (
        F.when(limit.isNull() | (F.length(c) <= limit), c)
        .when(limit <= len(mark), plain)
        .otherwise(cut)
    )


def content_lines(c: Column) -> Column:
    # a carriage return at a line's end is white space
    lines = F.transform(F.split(c, "\n"), strip)
    return F.filter(lines, lambda line: line != "")


def first_line(c: Column) -> Column:
    return F.coalesce(F.try_element_at(content_lines(c), F.lit(1)), F.lit(""))


def rest_lines(c: Column) -> Column:
    lines = content_lines(c)
    return F.array_join(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), " ")


def strip_tags(c: Column, drop_code: bool = False) -> Column:
    if drop_code:
        c = F.regexp_replace(c, r"(?is)<script\b.*?</script>", " ")
        c = F.regexp_replace(c, r"(?is)<style\b.*?</style>", " ")
    return F.regexp_replace(c, "<[^>]+>", " ")


def decode_entities(c: Column, ellipsis: bool = False) -> Column:
    """The ampersand is decoded first, so doubly escaped entities open up too."""
    entities = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]
    if ellipsis:
        entities.append(("&hellip;", "…"))
    for entity, char in entities:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def html_to_text(c: Column, drop_code: bool = True) -> Column:
    return collapse(decode_entities(strip_tags(c, drop_code)))


def split_sentences(c: Column) -> Column:
    """Sentences with one trailing mark kept."""

    def split(whole: Column) -> Column:
        parts = F.regexp_extract_all(whole, F.lit(r"([^。！？!?；;.\n]+(?:[。！？!?；;.]|$))"), 1)
        kept = let(parts, lambda p: F.when(F.size(p) == 0, F.array(whole)).otherwise(F.filter(F.transform(p, strip), lambda s: s != "")))
        return F.when(whole == "", F.array().cast("array<string>")).otherwise(kept)

    return let(collapse(c), split)


def is_low_information(c: Column) -> Column:
    """Fewer than 160 characters once white space is collapsed, or fewer than three sentences that are not blank.

    Two anchored patterns that end as soon as they have counted enough, so a long text is neither rewritten nor split. ASCII is told
    apart by its range first, and no step is ever taken back.
    """
    marks = "。！？.!?"
    blanks, inner = WS[1:-1], f"{WS}++(?=[^{WS[1:-1]}])"
    long_enough = f"^{WS}*+(?:[!-~]|[^{blanks}]|{inner}){{{fv.LOW_INFORMATION_CHARS}}}+"
    part = f"[^{marks}{blanks}]"
    rest = rf"(?:[^.!?\x{{80}}-\x{{10FFFF}}]++|[^{marks}])*+"
    sentences = f"^[{marks}{blanks}]*+(?:{part}{rest}[{marks}][{marks}{blanks}]*+){{{fv.LOW_INFORMATION_SENTENCES - 1}}}+{part}"
    return ~(c.rlike(long_enough) & c.rlike(sentences))


def slugify(c: Column) -> Column:
    slug = F.regexp_replace(strip(F.lower(c)), r"[^a-z0-9\x{4e00}-\x{9fff}]+", "-")
    slug = F.regexp_replace(slug, "^-+|-+$", "")
    return F.coalesce(null_if_blank(slug), F.lit("section"))


def looks_like_mojibake(c: Column) -> Column:
    return F.regexp_count(c, F.lit(fv.MOJIBAKE_CLASS)) >= 2


def escape_markdown(c: Column) -> Column:
    return F.regexp_replace(collapse(c), r"([\\`*_{}\[\]()#+\-.!|>])", r"\\$1")


def escape_markdown_url(c: Column) -> Column:
    c = F.replace(strip(c), F.lit("\\"), F.lit("%5C"))
    c = F.replace(F.replace(c, F.lit("<"), F.lit("%3C")), F.lit(">"), F.lit("%3E"))
    return F.regexp_replace(c, WS, "%20")


def escape_html(c: Column, backtick: bool = False) -> Column:
    for char, entity in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")]:
        c = F.replace(c, F.lit(char), F.lit(entity))
    return F.replace(c, F.lit("`"), F.lit("&#96;")) if backtick else c


def markdown_link(label: Column, url: Column) -> Column:
    return F.concat(F.lit("["), escape_markdown(label), F.lit("](<"), escape_markdown_url(url), F.lit(">)"))


def render_template(template: Column, values: dict[str, Column]) -> Column:
    """Fill ``{{name}}`` marks in one pass. An unknown mark makes the result null (the row is a violation)."""
    mark = r"\{\{([a-zA-Z0-9_]+)\}\}"
    marks = F.regexp_extract_all(template, F.lit(mark), 1)
    pieces = F.split(template, mark, -1)
    lookup = F.create_map(*[part for name, value in values.items() for part in (F.lit(name), value)])
    filled = F.transform(
        pieces,
        lambda piece, i: F.concat(
            piece, F.when(i < F.size(marks), F.try_element_at(lookup, F.get(marks, i))).otherwise(F.lit(""))
        ),
    )
    known = F.array(*[F.lit(name) for name in values])
    return F.when(F.size(F.array_except(marks, known)) == 0, F.array_join(filled, ""))
