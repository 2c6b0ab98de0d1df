"""Connected components of a link table by alternating large and small stars.

Every round rewires each node's larger neighbours to its smallest one (large star), then its smaller
neighbours (small star), until nothing changes: a logarithmic number of rounds, each two joins and
aggregations over the links.  Each round's links are a written table, so lineage stays short; nothing
but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import materialize


def _star(edges: DataFrame, smaller: bool) -> DataFrame:
    """edges (a, b) with a > b, once each."""
    around = edges if smaller else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    if smaller:     # a's smaller neighbours and a itself hang on the smallest
        made = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        made = made.unionByName(least.select("a", F.col("m").alias("b")))
    else:           # a's larger neighbours hang on the smallest
        made = around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return made.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of numbers -> (node, component) for each linked node; component: its smallest node."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = materialize(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        edges = materialize(_star(_star(edges, False), True), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
