"""Connected components of an edge table: alternating large-star and small-star rounds.

Every round is two grouped minima and two equi-joins (hot nodes are pre-aggregated map-side and their join
rows can be split by the adaptive skew join); the edge table is written to the shared folder between rounds.
The number of rounds grows with the logarithm of the longest path, not with the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.store import drop_table, write_table


def _digest(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    # repeated edges may come out; the small star that follows drops them
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return linked.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(id, root) for every node of ``edges`` (columns a, b); root is the smallest id of its component.

    Null ends and self loops carry no link and are ignored; repeated edges count once. An empty edge table
    gives an empty result."""
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, path = write_table(edges, "edges")
    before = _digest(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        used = path
        edges, path = write_table(_small_star(_large_star(edges)), "edges")
        drop_table(edges.sparkSession, used)
        now = _digest(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("root"))).distinct()
