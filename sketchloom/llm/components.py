"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shuffled, written


def connected(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and class (its component's smallest node) of every node of the links (a, b).

    Large-star and small-star rounds: each round hangs every node's neighbours on the smallest of
    them, so paths shrink by half and stars stay as they are. A node of any degree is aggregated
    before it is shuffled, and as the smallest neighbours are written too, both sides of a join are plain
    shuffles, so that a node of many links is split at run time. Rounds are written to the shared folder.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.where("v > u").join(shuffled(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        down = written(down, "edges")
        discard(edges, low)
        low = written(down.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = down.join(shuffled(low), "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        edges = written(small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct(), "edges")
        discard(down, low)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("class")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("class")).union(roots)
