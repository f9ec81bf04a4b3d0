"""Runs over tables on shared storage.

A run writes its files to folders of its own and then appends one record that names them. Readers replay the records and read the
folders of finished runs only: all tables that a run touched change at once, a failed or killed run shows nothing, and repeating it
needs no cleaning up. A record may also take folders away (a compaction puts new ones in their place); it counts only while all of
them are still there, so of two runs that rewrite the same folders the later one has no effect. Nothing is ever updated in place.

Records are a few hundred bytes per run; replaying them is driver work that grows with the number of runs, not with the rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.store import append_log

RUNNING, DONE, FAILED = "running", "completed", "failed"
RECORD = (
    "run_id string, attempt string, status string, recorded_us bigint, config string, result string, error string, "
    "adds array<string>, removes array<string>"
)


def read_or_empty(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Parquet files with the given schema; an empty table where there are none yet."""
    if paths:
        try:
            return spark.read.schema(schema).parquet(*([paths] if isinstance(paths, str) else paths))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)


@dataclass
class Run:
    """One attempt at a run: what it adds (folders below the store), takes away and reports."""

    run_id: str
    attempt: str
    config: str
    adds: list[str] = field(default_factory=list)
    removes: list[str] = field(default_factory=list)
    result: dict = field(default_factory=dict)


@dataclass
class State:
    """What the records come to: folders to read, finished runs, attempts whose rows nobody may see."""

    folders: list[str]
    done: set[str]
    hidden: list[str]

    def below(self, table: str) -> list[str]:
        return [f for f in self.folders if f.split("/", 1)[0] == table]


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._last = spark, path, 0

    def records(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, RECORD)

    def _append(self, run: Run, status: str, error: str | None = None) -> None:
        self._last = max(time.time_ns() // 1000, self._last + 1)
        ended = status == DONE
        row = (
            run.run_id, run.attempt, status, self._last, run.config, json.dumps(run.result, default=str), error,
            run.adds if ended else [], run.removes if ended else [],
        )
        append_log(self.spark.createDataFrame([row], RECORD).coalesce(1), self.path)

    @contextmanager
    def run(self, run_id: str, config: dict | None = None) -> Iterator[Run]:
        """Everything inside is one attempt: recorded as running before, as completed or failed after (the error goes on)."""
        run = Run(run_id, f"{run_id}-{uuid.uuid4().hex}", json.dumps(config or {}, default=str))
        self._append(run, RUNNING)
        try:
            yield run
        except BaseException as error:
            self._append(run, FAILED, f"{type(error).__name__}: {error}")
            raise
        self._append(run, DONE)

    def state(self) -> State:
        rows = self.records().select("run_id", "attempt", "status", "recorded_us", "adds", "removes").collect()
        live: dict[str, None] = {}
        done: set[str] = set()
        counted: set[str] = set()
        for r in sorted((r for r in rows if r["status"] == DONE), key=lambda r: (r["recorded_us"], r["attempt"])):
            if r["run_id"] in done or not all(f in live for f in r["removes"]):
                continue
            done.add(r["run_id"])
            counted.add(r["attempt"])
            for f in r["removes"]:
                del live[f]
            live.update(dict.fromkeys(r["adds"]))
        return State(list(live), done, sorted({r["attempt"] for r in rows} - counted))

    def runs(self) -> DataFrame:
        """One row per run, as its records leave it: the first one's times, the last one's status, config, result and error."""
        at = F.struct("recorded_us", F.col("status") != RUNNING)
        last = F.max_by(F.struct("status", "config", "result", "error"), at).alias("last")
        rows = self.records().groupBy("run_id").agg(
            F.min("recorded_us").alias("first_us"), F.max("recorded_us").alias("last_us"), last, F.count_distinct("attempt").alias("attempts"),
            F.count_if(F.col("status") == FAILED).alias("failures"),
        )
        time_of = F.timestamp_micros
        return rows.select(
            F.col("run_id").alias("id"), "last.status", time_of("first_us").alias("started_at"),
            F.when(F.col("last.status") != RUNNING, time_of("last_us")).alias("completed_at"), "last.config", "last.result", "last.error",
            time_of("first_us").alias("created_at"), time_of("last_us").alias("updated_at"), "attempts", "failures",
        )


def absolute(store: str, folders: Iterable[str]) -> list[str]:
    return [f"{store}/{f}" for f in folders]
