"""Connected components of a link table by alternating large and small stars, with every round stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """edges has u > v. Large: every node's larger neighbours go to its least one. Small: its lesser ones and itself do."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
    return out.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node) for every node in links (a, b); nodes that stand alone are in no row."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
    before = mark(edges)
    while before[0]:
        edges = stored(_stars(_stars(edges, True), False), "edges")
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
