"""Connected components of a link table by iterative joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.store import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has a link.

    Alternating large-star and small-star steps, each written to the shared folder. A step
    turns links, so their number never grows; the rounds grow with the logarithm of the
    longest path. Links must be written already; nothing but a count reaches the driver.
    """
    state = links.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).filter("u <> v").distinct()
    state = stored(state, "links")
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("m", "u").alias("m"))
        # large-star: greater neighbours are linked to the least of the neighbourhood
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct(), "links")
        # small-star: smaller neighbours and the node itself likewise
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        small = stored(small, "links")
        old = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        new = small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        state = small
        if tuple(old) == tuple(new):
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
