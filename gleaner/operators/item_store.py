"""The store of ingested items: day folders of rows, marks that change earlier rows, and an index of their keys.

* ``raw/<attempt>/day=...``: rows as they were inserted, one folder per run and day of collection. Readers name the folders, so a time
  window reads its own days only.
* ``marks/<attempt>``: later changes of ``duplicate_of``; the newest one of an id wins over what was written at insert.
* the key index: digests of URLs and contents, one row per key and inserted row, in a table bucketed and sorted by digest. A batch meets
  it in a merge join whose index side is read bucket by bucket and never shuffled; only the batch moves.

Rows, marks and keys of a run become visible together, when the run's record is in the ledger (:mod:`gleaner.operators.ledger`). Keys of
attempts without such a record are filtered out by name.
"""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.ledger import Ledger, Run, State, absolute, read_or_empty

RAW_SCHEMA = (
    "id string, arrival bigint, source_url string, article_title string, raw_content string, published_at timestamp_ntz, "
    "collected_at timestamp_ntz, source_type string, source_weight int, url_key string, hash_key string, "
    "duplicate_of string, duplicate_score double, batch_id bigint, collected_date date"
)
MARK_SCHEMA = "id string, duplicate_of string, batch_id bigint"
RAW_COLUMNS = [c.split(" ")[0] for c in RAW_SCHEMA.split(", ")]
NO_DAY = "none"
BUCKETS = 32


def long_keys(keys: DataFrame) -> DataFrame:
    """``id, digest``: a row per key that an item has; a null key is no key."""
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("key")) for kind in ("url_key", "hash_key")])
    rows = keys.select("id", F.inline(kinds)).where("key IS NOT NULL")
    return rows.select("id", F.unhex(F.sha2(F.concat_ws(":", "kind", "key"), 256)).alias("digest"))


class KeyIndex:
    """``buckets`` is fixed when the index is created."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        location = f"{path}/keys-{buckets}"
        self.table = "item_keys_" + hashlib.md5(location.encode()).hexdigest()[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, attempt STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'"
        )

    def rows(self, hidden: list[str]) -> DataFrame:
        """``digest`` of what may be seen; ``hidden`` names the few attempts that failed or are still under way."""
        rows = self.spark.table(self.table)
        return (rows.where(~F.col("attempt").isin(hidden)) if hidden else rows).select("digest")

    def seen(self, keys: DataFrame, hidden: list[str]) -> DataFrame:
        """Ids of the items (``id, url_key, hash_key``) of which a key is in the index."""
        asked = long_keys(keys).repartition(self.buckets, "digest")
        return asked.join(self.rows(hidden).hint("merge"), "digest", "left_semi").select("id").distinct()

    def append(self, keys: DataFrame, attempt: str) -> None:
        """One file per bucket and run."""
        rows = long_keys(keys).select("digest", F.lit(attempt).alias("attempt"))
        rows.repartition(self.buckets, "digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)


class ItemStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path
        self.ledger, self.keys = Ledger(spark, f"{path}/runs"), KeyIndex(spark, path, buckets)

    def raw(self, state: State, since: date | None = None) -> DataFrame:
        """Rows as inserted; with ``since``, only folders of that day and later are read."""
        folders = [f for f in state.below("raw") if since is None or (day_of(f) != NO_DAY and day_of(f) >= since.isoformat())]
        return read_or_empty(self.spark, absolute(self.path, folders), RAW_SCHEMA)

    def marks(self, state: State) -> DataFrame:
        """The newest mark of every id that has one: ``id, m.duplicate_of``."""
        rows = read_or_empty(self.spark, absolute(self.path, state.below("marks")), MARK_SCHEMA)
        return rows.groupBy("id").agg(F.max_by(F.struct("duplicate_of"), "batch_id").alias("m"))

    def items(self, state: State | None = None, since: date | None = None) -> DataFrame:
        """Inserted rows with their current ``duplicate_of``."""
        state = state or self.ledger.state()
        return self.raw(state, since).join(self.marks(state), "id", "left").withColumn(
            "duplicate_of", F.when(F.col("m").isNotNull(), F.col("m.duplicate_of")).otherwise(F.col("duplicate_of"))
        ).drop("m")

    def write_raw(self, rows: DataFrame, run: Run) -> None:
        """Rows to the run's own folders, one per day; days with many rows are written by many tasks."""
        days = rows.select(*RAW_COLUMNS, F.coalesce(F.col("collected_date").cast("string"), F.lit(NO_DAY)).alias("day"))
        days.hint("rebalance", "day").write.partitionBy("day").parquet(f"{self.path}/raw/{run.attempt}")
        written = self.spark.read.schema(f"{RAW_SCHEMA}, day string").parquet(f"{self.path}/raw/{run.attempt}")
        run.adds += sorted(f"raw/{run.attempt}/day={r['day']}" for r in written.select("day").distinct().collect())

    def write_marks(self, rows: DataFrame, run: Run) -> None:
        rows.write.parquet(f"{self.path}/marks/{run.attempt}")
        run.adds.append(f"marks/{run.attempt}")

    def compact(self, before: date, folders: int = 2) -> int:
        """Rewrite every day before ``before`` that has ``folders`` or more of them, and all marks if there are as many.

        Runs while batches are ingested: they only add folders, and readers see either the old ones or the new ones. Returns how many
        folders were replaced. Old files stay until storage rules remove them, since a reader may still hold them.
        """
        state = self.ledger.state()
        days: dict[str, list[str]] = {}
        for f in state.below("raw"):
            if day_of(f) != NO_DAY and day_of(f) < before.isoformat():
                days.setdefault(day_of(f), []).append(f)
        old = [f for held in days.values() if len(held) >= folders for f in held]
        marks = state.below("marks")
        marks = marks if len(marks) >= folders else []
        if not old and not marks:
            return 0
        with self.ledger.run(f"compact-{before.isoformat()}-{len(state.done)}", {"before": before}) as run:
            if old:
                self.write_raw(read_or_empty(self.spark, absolute(self.path, old), RAW_SCHEMA), run)
            if marks:
                newest = self.spark.read.schema(MARK_SCHEMA).parquet(*absolute(self.path, marks))
                newest = newest.groupBy("id").agg(F.max_by(F.struct("duplicate_of", "batch_id"), "batch_id").alias("m"))
                self.write_marks(newest.select("id", "m.*"), run)
            run.removes += [*old, *marks]
            run.result["folders"] = len(run.removes)
        return len(old) + len(marks)


def day_of(folder: str) -> str:
    return folder.rsplit("day=", 1)[-1]
