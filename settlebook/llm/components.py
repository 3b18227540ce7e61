"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlebook.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b), root being the least
    node of its component.

    Each round points every node at its least neighbour, shortens the pointers
    to their roots by doubling, and goes on with the edges between roots. Every
    table is written before it is joined, so all joins are between plain
    shuffles that adaptive execution can split at a node with many neighbours.
    """
    live = scratch.save(edges.where("a <> b").select("a", "b").distinct(), f"{name}-e0")
    total = None
    k = 0
    while not live.isEmpty():
        k += 1
        both = live.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(live.select(F.col("b").alias("u"), F.col("a").alias("v")))
        up = scratch.save(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")), f"{name}-p{k}.0")
        for j in range(1, 100):
            over = up.select(F.col("u").alias("p"), F.col("p").alias("q"))
            up = scratch.save(up.join(over, "p").select("u", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")), f"{name}-p{k}.{j}")
            moved = not up.where("moved").isEmpty()
            up = up.drop("moved")
            if not moved:
                break
        of_a, of_b = (up.select(F.col("u").alias(c), F.col("p").alias(f"r{c}")) for c in "ab")
        live = scratch.save(live.join(of_a, "a").join(of_b, "b").where("ra <> rb").select(
            F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), f"{name}-e{k}")
        if total is None:
            total = up.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            step = up.select(F.col("u").alias("root"), F.col("p").alias("next"))
            total = total.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        total = scratch.save(total, f"{name}-t{k}")
    return total if total is not None else live.select(F.col("a").alias("node"), F.col("b").alias("root"))
