"""Tables that are written together, batch by batch, and appear together or not at all.

A batch has a name. Each of its tables goes into a folder of its own
(``root/<table>/batch=<name>``); then one row with the name goes into ``root/commits``, and only
batches named there are ever read. A batch that failed half-way leaves files that nobody
reads, and writing it again replaces them; a batch that is already committed is not written
twice. So a task, a driver or a whole stream can be run again without losing or repeating a row
in any of the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textmill.sources.tables import create_table_if_absent, enforce_required

COMMITS = StructType([
    StructField("batch", StringType()),
    StructField("only", StringType()),       # the one table that a compaction writes
    StructField("replaced", StringType()),   # a batch that the compaction holds
])


@dataclass(frozen=True)
class CommittedTables:
    """``tables``: schema of each table. ``split``: table -> column that its folders are split by."""

    spark: SparkSession
    root: str
    tables: dict[str, StructType]
    split: dict[str, str]

    @classmethod
    def open(cls, spark: SparkSession, root: str, tables: dict[str, StructType], split: dict[str, str] | None = None) -> "CommittedTables":
        create_table_if_absent(spark, f"{root.rstrip('/')}/commits", COMMITS)
        return cls(spark, root.rstrip("/"), tables, split or {})

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")

    def has(self, batch: str) -> bool:
        return not self.commits().where(F.col("batch") == batch).isEmpty()

    def live(self, table: str) -> DataFrame:
        """Names of the batches whose files hold the rows of ``table``."""
        own = self.commits().where(F.col("only").isNull() | (F.col("only") == table))
        gone = own.where("replaced IS NOT NULL").select(F.col("replaced").alias("batch"))
        return own.select("batch").distinct().join(gone, "batch", "left_anti")

    def read(self, table: str) -> DataFrame:
        """The committed rows of ``table``, with the name of their batch as ``batch``."""
        schema = StructType([*self.tables[table].fields, StructField("batch", StringType())])
        if self.live(table).isEmpty():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}").join(self.live(table), "batch", "left_semi").select(*schema.names)

    def put(self, batch: str, table: str, df: DataFrame) -> DataFrame:
        """Write one table of a batch (again, if it was written before) and read it back."""
        rows = enforce_required(df, self.tables[table])
        path, by = f"{self.root}/{table}/batch={batch}", self.split.get(table)
        # a number of its own, as tasks joined by size would leave all the folders to a few of them
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = rows.repartition(parts, by).write.partitionBy(by) if by else rows.write
        writer.mode("overwrite").parquet(path)
        return self.spark.read.schema(self.tables[table]).parquet(path)

    def commit(self, batch: str, only: str | None = None, replaced: list[str] | None = None) -> None:
        """From here on the batch is read. One file of a few rows, so it is there or not."""
        rows = [(batch, only, r) for r in replaced or [None]]
        self.spark.createDataFrame(rows, COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def write(self, batch: str, **frames: DataFrame) -> bool:
        """All tables of a batch, then the commit; False where it was committed before."""
        if self.has(batch):
            return False
        for table, df in frames.items():
            self.put(batch, table, df)
        self.commit(batch)
        return True

    def compact(self, table: str, merge: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> str | None:
        """The rows of many small batches of a table in one, put together by ``merge``; readers go
        over to it at its commit."""
        names = [r["batch"] for r in self.live(table).collect()]
        if len(names) < 2:
            return None
        batch = f"compact-{uuid.uuid4().hex}"
        self.put(batch, table, merge(self.read(table).drop("batch")))
        self.commit(batch, only=table, replaced=names)
        return batch
