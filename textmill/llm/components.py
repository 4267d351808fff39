"""Connected components of a graph given as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import base


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v: long); nodes of one component share a
    root, which is one of them.

    Each round sends every node to its smallest neighbour (or itself) and contracts the
    edges, until none is left; each table is written and read again, so nothing but counts
    comes to the driver. Node numbers should be hashes: with random order the rounds are
    logarithmic in the number of nodes."""
    edges = base.stage(edges.select("u", "v").where("u <> v").distinct(), "cc-edges")
    at = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = base.stage(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("root")), "cc-to")
        if at is None:
            at = to
        else:
            at = at.join(to.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
            at = base.stage(at.select("node", F.coalesce("next", "root").alias("root")), "cc-at")
        a, b = (to.select(F.col("node").alias(c), F.col("root").alias(f"{c}_to")) for c in ("u", "v"))
        edges = edges.join(a, "u").join(b, "v").select(F.least("u_to", "v_to").alias("u"), F.greatest("u_to", "v_to").alias("v"))
        edges = base.stage(edges.where("u <> v").distinct(), "cc-edges")
    return at if at is not None else edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
