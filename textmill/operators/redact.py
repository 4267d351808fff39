"""Personal data in texts replaced by a label, map-only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.entities import PATTERNS

KINDS = ("EMAIL", "PHONE")


def redact(df: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``df`` with every match of the patterns of ``kinds``, in that order, replaced
    by ``[KIND]``, and a column ``n_<kind>`` with the number replaced. A null text
    stays null, with null counts."""
    out = df
    for k in kinds:
        out = out.withColumn(f"n_{k.lower()}", F.regexp_count(text_col, F.lit(PATTERNS[k])).cast("bigint"))
        out = out.withColumn(text_col, F.regexp_replace(text_col, PATTERNS[k], f"[{k}]"))
    return out
