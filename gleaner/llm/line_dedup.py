"""Repeated passages of lines, with DataFrame functions only.

Every three consecutive lines of a text form a window, named by two 64-bit hashes of its line hashes. A window seen more than once
anywhere stays at its first place (smallest document id, then text hash, then line number); at every later place its three lines are
covered. Covered stretches merge, and each text is put together again from the stretches between them.

Defined cases: lines end at "\\n" (a trailing one gives an empty last line); texts of fewer than three lines stay as they are; a null
text stays null with zero lines; a null id sorts before all others; rows repeated with the same id and text are one place and all
get the same result; a text covered completely becomes empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import documents, fresh, id_key, settle, whole_text

SPAN = 3


def text_mark(column: str):
    return F.xxhash64(whole_text(column))


def line_windows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per window: doc, mark (hash of the text), pos, and the window's hashes k1 and k2."""
    lines = docs.select(
        id_key(F.col(id_column).cast("bigint")).alias("doc"), text_mark(text_column).alias("mark"),
        F.transform(F.split(F.col(text_column), "\n", -1), lambda s: F.xxhash64(s)).alias("h"),
    ).where(F.size("h") >= SPAN)
    h = F.col("h")
    spans = F.transform(
        F.sequence(F.lit(0), F.size("h") - SPAN),
        lambda i: F.struct(i.alias("pos"), F.xxhash64(h[i], h[i + 1], h[i + 2]).alias("k1"), F.xxhash64(h[i + 2], h[i], h[i + 1]).alias("k2")),
    )
    return lines.select("doc", "mark", F.inline(spans))


def later_places(windows: DataFrame) -> DataFrame:
    """Per text, the line numbers at which a window starts that occurs earlier somewhere: doc, mark, starts (ascending)."""
    place = F.struct("doc", "mark", "pos")
    repeated = (
        windows.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(F.col("first") != F.col("last")).drop("last")
    )
    later = windows.join(repeated, ["k1", "k2"]).where(place > F.col("first"))
    return later.groupBy("doc", "mark").agg(F.array_sort(F.collect_set("pos")).alias("starts"))


def drop_repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows with their text cleaned, and n_lines and n_removed added (names change when taken)."""
    columns = docs.columns
    doc, mark, starts, lines, text = (fresh(columns, c) for c in ("__doc", "__mark", "__starts", "__lines", "__text"))
    n_lines, n_removed = fresh(columns, "n_lines"), fresh(columns, "n_removed")
    windows = settle(line_windows(docs, id_column, text_column), "line-windows")
    later = later_places(windows).toDF(doc, mark, starts)
    rows = docs.withColumns({doc: id_key(F.col(id_column).cast("bigint")), mark: text_mark(text_column)}).join(later, [doc, mark], "left")
    rows = rows.withColumn(lines, F.split(F.col(text_column), "\n", -1))
    p, n = F.col(starts), F.size(lines)
    # Stretches that stay: before the first start, between starts more than SPAN apart, after the last.
    between = F.transform(p, lambda x, i: F.struct(F.when(i == 0, 0).otherwise(p[i - 1] + SPAN).alias("at"), x.alias("to")))
    stretches = F.concat(between, F.array(F.struct((F.element_at(p, -1) + SPAN).alias("at"), n.alias("to"))))
    whole = F.filter(stretches, lambda s: s["to"] > s["at"])
    stay = F.flatten(F.transform(whole, lambda s: F.slice(F.col(lines), s["at"] + 1, s["to"] - s["at"])))
    rows = rows.withColumn(text, F.when(p.isNull(), F.col(lines)).otherwise(stay))
    return rows.select(
        *[F.array_join(text, "\n").alias(c) if c.lower() == text_column.lower() else F.col(f"`{c}`") for c in columns],
        F.coalesce(n, F.lit(0)).alias(n_lines),
        F.coalesce(n - F.size(text), F.lit(0)).alias(n_removed),
    )


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return drop_repeated_lines(docs).select("doc_id", "text", F.col("n_lines").cast("bigint").alias("n_lines"), F.col("n_removed").cast("bigint").alias("n_removed"))


OP9_SQL = """
WITH d AS (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, text, pos, l[pos + 1] AS a, l[pos + 2] AS b, l[pos + 3] AS c FROM d, unnest(generate_series(0, len(l) - 3)) AS t(pos)),
r AS (SELECT *, first_value(doc_id) OVER o AS fd, first_value(pos) OVER o AS fp FROM w WINDOW o AS (PARTITION BY a, b, c ORDER BY doc_id, pos)),
s AS (SELECT DISTINCT doc_id, text, pos + k AS pos FROM r, (VALUES (0), (1), (2)) AS v(k) WHERE (doc_id, pos) <> (fd, fp)),
e AS (SELECT doc_id, text, pos, l[pos + 1] AS line FROM d, unnest(generate_series(0, len(l) - 1)) AS t(pos)),
g AS (SELECT e.doc_id, e.text AS whole, count(*) AS n_lines, count(s.pos) AS n_removed,
             coalesce(string_agg(e.line, chr(10) ORDER BY e.pos) FILTER (s.pos IS NULL), '') AS text
      FROM e LEFT JOIN s ON e.doc_id = s.doc_id AND e.text = s.text AND e.pos = s.pos GROUP BY e.doc_id, e.text)
SELECT o.doc_id, g.text, coalesce(g.n_lines, 0) AS n_lines, coalesce(g.n_removed, 0) AS n_removed
FROM documents o LEFT JOIN g ON o.doc_id = g.doc_id AND o.text = g.whole
"""
