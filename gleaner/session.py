"""Session construction and the one place that decides where checkpoints go."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "gleaner", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session; every setting can be overridden by ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory used to cut lineage.

    A directory already set on the context, or named by ``spark.checkpoint.dir``, is used as it is.
    Only a single-machine session without one gets a scratch folder; on a cluster that is an error,
    because executors could not read it back.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of the executors that computed it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Like :func:`cut_lineage` for wide tables of which later steps read a few columns each: Parquet in the same shared folder."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """In a single-machine session, deal out a table scan that has fewer splits than the session has cores.

    A Parquet file of one row group cannot be split by settings. On a cluster the scan is taken as it is, and nothing is
    planned twice. For plain scans only: asking a plan with shuffles for its partitions would run it.
    """
    context = df.sparkSession.sparkContext
    if not context.master.startswith("local["):
        return df
    cores = context.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
