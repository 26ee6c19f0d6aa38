"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.llm.tables import Scratch


def components(links: DataFrame, scratch: Scratch, name: str, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node that has a link.

    Each round turns the links round by round into stars: every node links its larger neighbours to its
    smallest one, then its smaller neighbours too.  Both steps keep the components, and the number of
    rounds grows with the logarithm of the nodes.  A round's links are written once, as ``scratch`` tables
    whose names contain ``name``.
    """
    edges = links.select(F.greatest(a, b).alias("up"), F.least(a, b).alias("down")).where("up > down").distinct()
    edges = scratch.put(edges, f"edges-{name}")
    last, before, turn = f"edges-{name}", None, 0
    while True:
        # Larger neighbours of each node point to the smallest of the node and its neighbours.
        both = edges.unionByName(edges.select(F.col("down").alias("up"), F.col("up").alias("down")))
        least = both.groupBy("up").agg(F.least(F.min("down"), F.col("up")).alias("least"))
        large = both.join(least, "up").where(F.col("down") > F.col("up"))
        large = large.select(F.col("down").alias("up"), F.col("least").alias("down")).where("up > down").distinct()
        large = scratch.put(large, f"large-{name}-{turn}")
        # A node and its smaller neighbours point to the smallest of them.
        least = large.groupBy("up").agg(F.min("down").alias("least"))
        up = F.when(F.col("down") == F.col("least"), F.col("up")).otherwise(F.col("down"))
        small = large.join(least, "up").select(up.alias("up"), F.col("least").alias("down")).where("up > down").distinct()
        edges = scratch.put(small, f"small-{name}-{turn}")
        scratch.drop(f"large-{name}-{turn}")
        scratch.drop(last)
        total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
        now = edges.agg(F.count("*"), total("down"), total("up")).first()
        if now == before:
            break
        last, before, turn = f"small-{name}-{turn}", now, turn + 1
    # The links are stars by now: every node has one link, to its component's smallest node.
    tops = edges.select(F.col("down").alias("node"), F.col("down").alias("component")).distinct()
    return edges.select(F.col("up").alias("node"), F.col("down").alias("component")).unionByName(tops)
