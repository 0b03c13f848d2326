"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round is two grouped minimums and two joins over the edges; nothing is gathered. A round's edges are written to
the shared folder, so every join reads freshly exchanged tables and adaptive execution can split a node with very many
neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entryclime.session import write_stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", "u"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("u", "_m").alias("_m"))
    return (both.join(least, F.col("u") == F.col("_u")).where("v > u")
            .select(F.col("v").alias("u"), F.col("_m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), "_m")
    joined = down.join(least, F.col("u") == F.col("_u"))
    return (joined.select(F.col("v").alias("u"), F.col("_m").alias("v")).where("u <> v")
            .unionByName(least.select(F.col("_u").alias("u"), F.col("_m").alias("v"))).distinct())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Edges ``u, v`` (unequal longs) to ``node, root``: every node of an edge with its component's least node."""
    edges = write_stage(edges.select("u", "v").distinct(), f"{name}_edges")
    before = _state(edges)
    while before[0]:
        large = write_stage(_large_star(edges), f"{name}_large")
        edges = write_stage(_small_star(large), f"{name}_small")
        after = _state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
