"""Connected components of a large graph by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import drop, save


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 50) -> DataFrame:
    """(node, component) of every node that has an edge; component is the least node reachable.

    Self-loops, repeated and reversed edges are fine, an empty table gives an empty result, and
    edges with a null end are ignored.  Each round writes its edges to the shared folder.  A hub
    with very many neighbours meets only map-side minima and a join with one row on its other
    side, which Spark's skew join splits.
    """
    start = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = save(start.distinct(), "edges")
    seen = None
    for _ in range(rounds):
        # large star: v's larger neighbours move to v's least neighbour
        both = now.select("v", "u").union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        # small star: v and its smaller neighbours move to the least of them
        large = large.where("v != u").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        moved = large.join(least, "v").select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.*")
        after = save(moved.where("v != u").distinct(), "edges")
        key = after.agg(F.count("*"), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        drop(now)
        now = after
        if key == seen:
            break
        seen = key
    else:
        raise RuntimeError(f"connected components did not settle in {rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).union(roots)
