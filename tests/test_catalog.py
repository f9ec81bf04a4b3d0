"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from gleaner.plans import catalog  # noqa: F401
from gleaner.plans.registry import ORACLES, QUERIES

FOLDER = os.environ.get("GLEANER_TABLES", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert got == expected


def test_front_matter_values_lose_their_quotes_in_query_and_sql(spark, tmp_path):
    """A headline that ends in a quote, one within quotes, and headings in texts without a head."""
    texts = ['token = "ab"\nbody one', "'quoted'\nbody two", "plain\n# The  heading\nbody three", "# \n#\nbody four", "no quote\nbody five", "first\n## lower\nbody six"]
    rows = [(i + 1, text, "en", f"src{i}") for i, text in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["file_name"]: (r["title"], r["excerpt"]) for r in QUERIES["read_frontmatter_docs"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.execute(f"SELECT file_name, title, excerpt FROM ({ORACLES['read_frontmatter_docs']})").fetchall()
    assert found == {name: (title, excerpt) for name, title, excerpt in expected}
    assert found["doc-1.md"][0] == 'token = "ab' and found["doc-2.md"][0] == "quoted" and found["doc-3.md"][0] == "The  heading"
