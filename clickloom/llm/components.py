"""Connected components by alternating star contractions.

A round hangs the larger neighbours of every node on its smallest neighbour
(large star), then the smaller ones (small star). The rounds grow with the
logarithm of a component's size. Each round is written and read back, so no
lineage grows, and nothing but two numbers reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of longs -> (node, root); root is the smallest node reachable.

    Only nodes that an edge names are returned. Edges may repeat, point either
    way or join a node to itself; edges with a null end are left out.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    stars = materialize(
        pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "components",
    )
    before = None
    while (state := _state(stars)) != before:
        before = state
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select(F.col("u").alias("n"), F.least("n", "m").alias("m"))
        low = materialize(low, "components-low")
        # u > v: v sees the larger u and hangs it on v's smallest neighbour.
        large = materialize(
            stars.join(low, stars["v"] == low["n"]).select("u", F.col("m").alias("v")).distinct(),
            "components-large",
        )
        small = materialize(
            large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n"),
            "components-small",
        )
        hung = large.join(small, large["u"] == small["n"])
        stars = materialize(
            hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .unionByName(small.select(F.col("n").alias("u"), F.col("m").alias("v")))
            .distinct(),
            "components",
        )
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
