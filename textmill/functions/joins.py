"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parameter tables built from Python literals (stopwords, lexicons, query
# lists) have a size known when the plan is built; anything larger than this
# many rows or bytes is left to the shuffle join / AQE.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, known_rows: int | None = None,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only with a proven size bound.

    ``known_rows`` is given for literal parameter tables. Otherwise the rows
    (``max_rows + 1`` at most) are counted and their bytes as JSON summed up;
    above either bound the frame is returned as is and the planner shuffles
    (AQE may still broadcast at run time when the shuffled side turns out
    small).
    """
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("b")
    found = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), size).first()
    return F.broadcast(df) if found["n"] <= max_rows and found["b"] <= max_bytes else df
