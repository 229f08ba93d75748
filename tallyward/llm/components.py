"""Connected components of a stored edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyward.llm.text import forget, stored_at


def _written(edges: DataFrame, before: str | None = None) -> tuple[DataFrame, str, tuple]:
    """Store the edges, with a mark of what was written taken on the way; the folder of the round before goes."""
    mark = Observation()
    marked = edges.observe(mark, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("h"))
    edges, path = stored_at(marked, "edges")
    if before:
        forget(edges.sparkSession, before)
    return edges, path, (mark.get["n"], mark.get["h"])


def components(edges: DataFrame) -> DataFrame:
    """From (hi, lo) with hi > lo to one row (hi, lo) per node that is not the least of its component, ``lo`` being that least node.

    A round points every neighbour of a node at the least one, first the larger neighbours, then the smaller;
    the number of rounds grows with the logarithm of the diameter.  Each round is stored by one job, so lineage
    stays short; minima are combined on the map side, and the joins' hot nodes are split by adaptive execution.
    """
    edges, path, mark = _written(edges.distinct())
    while mark[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = small.select("hi", F.col("m").alias("lo")).union(small.where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        last = mark
        edges, path, mark = _written(small.distinct(), path)
        if mark == last:
            break
    return edges
