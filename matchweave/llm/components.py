"""Connected components of large edge lists by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.session import durable


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node it reaches) of every node in ``edges(u, v)``.

    Each round ties the larger neighbours of a node to its smallest one, then the smaller ones; the number of rounds
    grows with the logarithm of the longest chain. Each round is written, so an executor that is lost costs no
    earlier round. No node's neighbours are gathered: minima are taken before the shuffle.
    """
    u, v = F.col("u"), F.col("v")
    stars = durable(edges.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    before = None
    while True:
        both = stars.unionByName(stars.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        large = both.filter(v > u).join(least, "u").select(v.alias("u"), F.col("_m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("_m"))
        small = large.join(least, "u").select(v.alias("u"), F.col("_m").alias("v")).filter(u != v)
        stars = durable(small.unionByName(least.select("u", F.col("_m").alias("v"))).distinct())
        now = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before or not now[0]:
            break
        before = now
    roots = stars.select(v.alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(u.alias("node"), v.alias("component")).unionByName(roots)
