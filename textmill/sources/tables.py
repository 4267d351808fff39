"""Sources and sinks (S1-S9): scans, JSONL landing files, typed table writes,
parameterised SQL and keyed point lookups, all as lazy DataFrames."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textmill.session import ensure_checkpoint_dir

SCAN_LIMIT_DEFAULT = 1_500
EVAL_SAMPLE_DEFAULT = 100


def scan_limit(df: DataFrame, limit: int = SCAN_LIMIT_DEFAULT, key: str = "doc_id") -> DataFrame:
    """The first ``limit`` rows in key order (TakeOrderedAndProject: k rows per task)."""
    if limit < 0:
        raise ValueError("limit must be >= 0")
    return df.orderBy(F.col(key)).limit(limit)


def eval_sample(df: DataFrame, reference_col: str, columns: list[str], limit: int = EVAL_SAMPLE_DEFAULT,
                key: str = "doc_id") -> DataFrame:
    """Rows that carry a reference text, column-pruned, first ``limit`` by key."""
    return df.filter(F.col(reference_col).isNotNull()).select(*columns).orderBy(F.col(key)).limit(limit)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_jsonl(df: DataFrame, path: str) -> str:
    """One JSON object per line; overwrite (also when empty)."""
    df.write.mode("overwrite").json(path)
    return path


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """S3: load JSONL under a declared schema; malformed rows fail the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def enforce_required(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to ``schema`` and fail the write on a null in a REQUIRED field.

    The check is an expression inside the write's own projection
    (``raise_error``), so it costs no extra pass over the data.
    """
    cols: list[Column] = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"null in required field {f.name}"))).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def create_table_if_absent(spark: SparkSession, path: str, schema: StructType) -> str:
    """Create an empty typed Parquet table unless one exists at ``path``.

    Nothing there is ever overwritten: the write ignores a path that holds
    something, and any other failure (permissions, an unreadable path) reaches
    the caller. A table of other columns or types at the path is an error.
    """
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    found = [(f.name, f.dataType) for f in spark.read.parquet(path).schema.fields]
    wanted = [(f.name, f.dataType) for f in schema.fields]
    if sorted(found, key=str) != sorted(wanted, key=str):
        raise ValueError(f"the table at {path} has other columns: {found}")
    return path


def write_table(df: DataFrame, path: str, schema: StructType, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Typed write (overwrite truncates, append adds). Never write to a
    path that the same plan reads from."""
    w = enforce_required(df, schema).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def param_sql(spark: SparkSession, sql_text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Parameterised SQL, bound by name (no string splicing); lazy result.

    DataFrames passed as keyword arguments are referenced as ``{name}`` in the text.
    """
    return spark.sql(sql_text, args=args or {}, **frames)


def fetch_by_id(ids: DataFrame, docs: DataFrame, key: str = "doc_id", columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """S9 in set form: every requested id, with a ``found`` flag and the columns
    of the matching document (null on a miss). Duplicate ids are kept."""
    right = docs.select(key, *columns).withColumn("_hit", F.lit(True))
    out = ids.select(key).join(right, on=key, how="left")
    return out.select(key, F.coalesce(F.col("_hit"), F.lit(False)).alias("found"), *columns)
