"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on ``edges(a, b)`` with a > b: neighbours move to the smallest one."""
    if large:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m")).select("c", F.least("m", "c").alias("m"))
        out = both.join(least, F.col("a") == F.col("c")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m"))
        moved = edges.join(least, F.col("a") == F.col("c")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = moved.unionAll(least.select(F.col("c").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, keep: Scratch | None = None) -> DataFrame:
    """``(node, root)`` for all nodes of ``edges(a, b)`` but the roots; root is the smallest id of the component.

    The result is a table of the shared folder, that of ``keep`` if given.

    Minima are aggregated map-side before any join, each round is written to
    the shared folder, and only a count and a checksum reach the driver.
    """
    with Scratch(edges.sparkSession) as scratch:
        now = scratch.table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        mark = None
        while True:
            seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if seen == mark or not seen[0]:
                found = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
                return keep.table(found, "components") if keep else materialize(found, "components")
            mark = seen
            now = scratch.table(_stars(_stars(now, True), False), "edges")
            scratch.drop(keep=1)
