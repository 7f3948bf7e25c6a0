"""Connected components of a table of edges."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varicube.functions.storage import discard, stored

FEW = 1 << 20  # edges that one task may take whole


def forest(edges: pd.DataFrame) -> pd.DataFrame:
    """(u, v): each node of the edges but the smallest of its component, and that one."""
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in zip(edges["u"].tolist(), edges["v"].tolist()):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    pairs = [(x, root(x)) for x in list(parent)]
    return pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["u", "v"]).astype("int64")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node reachable. Nodes are whole numbers.

    Each task first makes a forest of its own edges, sorted by their larger end. What is left goes through rounds of large-star and small-star steps,
    each a few aggregations whose result is written to the shared folder, until few enough edges are left for one task or nothing changes.
    A null end or a loop makes no edge; an empty frame gives an empty frame.
    """
    both = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v")

    def in_task(batches):
        parts = list(batches)
        if parts:
            yield forest(pd.concat(parts))

    now, before = stored(both.repartitionByRange("u").mapInPandas(in_task, "u long, v long"), "edges"), None
    while True:
        seen = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen[0] <= FEW:
            last, now = now, stored(now.coalesce(1).mapInPandas(in_task, "u long, v long"), "edges")
            discard(last)
            break
        if seen == before:
            break
        before = seen
        sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = sides.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        last, now = now, stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(last)
    own = now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return own.unionByName(now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node")))
