"""Streaming form of the append sink (S6) and of the turn log.

``append_stream`` writes each micro-batch of a Structured Streaming query with
``foreachBatch`` into a folder of its own under the table path, named by the
query and the batch. A batch that is replayed after a failure overwrites
exactly that folder, so the table receives every row once. Two queries, or one
that starts again with a new checkpoint, never share a folder: the name holds
Spark's id of the query, which lives in its checkpoint. Required fields are
enforced inside the write (``raise_error``), so a bad row fails the batch, and
the query can be restarted from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textmill.sources.tables import enforce_required


def read_appended(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of a table that ``append_stream`` writes, with the table's own columns only."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def append_stream(stream: DataFrame, path: str, schema: StructType, checkpoint: str,
                  available_now: bool = False, processing_time: str | None = None,
                  query_name: str | None = None) -> StreamingQuery:
    """Start a streaming append of ``stream`` into the Parquet table at ``path``.

    ``checkpoint`` is named by the caller, in a folder that outlives the
    session: with it the query goes on where it stopped, under another one it
    is another query, whose rows are added.
    """
    root = path.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # set by Spark for the thread that runs the batch; stable for a checkpoint
        own = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        enforce_required(batch, schema).write.mode("overwrite").parquet(f"{root}/{own}-{batch_id}")

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
