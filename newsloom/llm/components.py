"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.storage import release, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Every node of an edge with the smallest node that it can reach: columns ``node`` and ``component``.

    Nodes may be of any ordered type. Self loops, repeated edges and edges with a null end add nothing; without
    edges the result is empty. Minima are pre-aggregated per node and written, so that they are joined back as a table
    of one row a node: the edges of a hub are the large side, which adaptive execution splits over several tasks.
    Each round is written to the shared folder and starts from those files; rounds go on until nothing changes.
    """
    kind = edges.schema[a].dataType
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "components")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")
        large = written(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large-star")
        release(now, low)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        now = written(small.where("u <> v").distinct(), "components")
        release(large, least)
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").cast(kind).alias("node"), F.col("v").cast(kind).alias("component")).distinct()
    return now.select(F.col("u").cast(kind).alias("node"), F.col("v").cast(kind).alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """A fingerprint of an edge set: its size and the sum of its rows' hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
