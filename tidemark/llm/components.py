"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One contraction: nodes point at the least node they know of.

    Least neighbours are a partial aggregate and the rest is a join sized at run time, so a node with
    a third of all links is never gathered in one place.
    """
    if small:
        known = edges.select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        )
    else:
        known = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    least = known.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = known.join(least, "u")
    if small:
        pointed = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    else:
        pointed = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return pointed.filter("a <> b").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``component``, its least connected node, for all nodes of links ``a``, ``b``.

    Rounds are written to the shared folder, and only a count and a sum come to the driver.
    Links of a node with itself are ignored; repeated links are one.
    """
    linked = edges.select("a", "b").filter("a <> b").distinct()
    current = stored(linked, label)
    state = None
    while True:
        current = stored(_star(_star(current, small=False), small=True), label)
        now = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(now) == state or not now[0]:
            break
        state = tuple(now)
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)
