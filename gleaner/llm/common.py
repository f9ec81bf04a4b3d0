"""What the operators share: column naming, scratch tables in the shared folder, whole-table reads."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import ensure_checkpoint_dir

#: A null id counts as one id below all others.
LOWEST_ID = -(2**63)
LOWER_ASCII = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, and the table survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(columns: Iterable[str], wish: str) -> str:
    """``wish``, with underscores added while a column (in any case) already has that name."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def id_key(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(LOWEST_ID))


def whole_text(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fold(id_column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % n


def ascii_lower(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lowered; lone surrogates cannot occur in a Spark string."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER_ASCII)
