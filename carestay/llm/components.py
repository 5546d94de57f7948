"""Connected components of an edge table by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay.llm.store import forget, stored


def _hung_below_least(edges: DataFrame, keep) -> DataFrame:
    """Link the neighbours that ``keep`` selects to the least neighbour of each node (node included).

    The least neighbour is a hash aggregate with map-side combine and is joined back, so a node
    with very many neighbours is reduced before the shuffle and its rows can be split by AQE.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
    return edges.join(least, "u").where(keep)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has an edge; root is the least node of its component.

    ``edges`` has long columns ``u``, ``v``; direction, repeats and loops do not matter. Null ends
    are dropped. An empty edge table gives an empty result. Each round is two joins; the edge set
    is written to the shared folder after each round. Converges when a round changes nothing.
    """
    spark = edges.sparkSession
    cur = stored(edges.where("u is not null and v is not null and u <> v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _signature(cur)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hung_below_least(both, F.col("v") > F.col("u")).where("v <> w").select(
            F.col("v").alias("u"), F.col("w").alias("v")).distinct()
        hung = _hung_below_least(large, F.lit(True))
        small = hung.where("v <> w").select(F.col("v").alias("u"), F.col("w").alias("v")).unionByName(
            hung.select("u", F.col("w").alias("v"))).distinct()
        nxt = stored(small, "edges")
        after = _signature(nxt)
        forget(spark, cur)
        cur = nxt
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
