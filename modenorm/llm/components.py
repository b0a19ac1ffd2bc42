"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modenorm.llm.common import staged


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` (its smallest node) for every node of the edges ``a, b`` (long).

    Each step is a minimum by node and a join; each round is written to the shared folder.  Every round keeps
    the components, and the last state links each node to its smallest one.
    """
    spark = edges.sparkSession
    now = staged(spark, edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b").distinct(), "cc")
    state = None
    for _ in range(max_rounds):
        both = now.unionByName(now.selectExpr("b AS a", "a AS b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").selectExpr("b AS a", "m AS b").where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))  # here every b is smaller than its a
        small = (large.join(low, "a").selectExpr("b AS a", "m AS b").where("a <> b")
                 .unionByName(low.selectExpr("a", "m AS b")).distinct())
        now = staged(spark, small, "cc")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.selectExpr("a AS node", "b AS component").unionByName(
        now.selectExpr("b AS node", "b AS component").distinct())
