"""Session helpers.

On a cluster the session is built by the platform; the library only reads
settings from it. ``local_session`` is for tests, the bench and the driver
smoke check.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "textmill") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TEXTMILL_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    A cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as is. Only when it is unset (tests, local runs) a fresh scratch folder
    is created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext on this client
            current = None
    if current:
        return current
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="textmill-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001
        pass
    return path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Scan-parallelism guard for CPU-heavy text operators.

    A corpus stored as a few large row groups scans into fewer tasks than
    there are cores, and every regex / higher-order function then runs on a
    handful of threads. Only in that case the rows are spread round-robin;
    a scan that already has enough splits (the normal case for a large
    corpus of many files) is returned untouched, with no extra shuffle.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # noqa: BLE001 - no RDD API (e.g. a Spark Connect session): leave the scan as is
        return df
    return df.repartition(target)


def barrier(df: DataFrame) -> DataFrame:
    """Materialise the current columns once per row before later filters.

    Catalyst pushes filters below projections by substituting the projected
    expressions into the condition; for expensive text expressions (regex
    rewrites, token arrays) that means evaluating them again in the filter
    and in every branch of a CASE. A one-row ``inline`` is a Generate node,
    which filters on its output cannot be pushed through, so every column is
    computed exactly once. No shuffle, no extra pass.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    return a scan of it.

    This is how a stage hands its output to later stages (the cleaned corpus
    is written once and read by extraction, summarisation and evaluation),
    and it cuts the lineage: a lost executor recomputes from the table, not
    from the raw corpus.
    """
    import uuid

    base = ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
