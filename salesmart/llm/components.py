"""Connected components of a table of links, as Spark jobs.

Links are first contracted by a union-find inside each partition, then by
alternating large-star and small-star steps: every node's neighbours are tied
to the smallest of them, until each node hangs on its component's smallest.
A step is an aggregate with partial sums and a join that AQE can split, so a
node with very many links is not one task's work. Each round is written to
the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LINK = "u long, v long"


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over a batch of links: (node, root) for each node that isn't a root."""
    for pdf in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while (up := parent.get(x, x)) != top:
                parent[x], x = top, up
            return top

        for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        found = [(x, r) for x in parent if (r := root(x)) != x]
        yield pd.DataFrame(found, columns=["u", "v"]).astype("int64")


def _store(df: DataFrame, folder: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(folder)
    return df.sparkSession.read.schema(_LINK).parquet(folder)


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v: long); the component is its smallest node."""
    links = links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v")
    edges = _store(links.mapInPandas(_forest, _LINK).distinct(), f"{folder}/round0")
    step = 0
    while True:
        # A forest of stars: each node has one link, and what it points at has none. No rows: nothing to link.
        many = edges.groupBy("u").count().where("count > 1").limit(1).count()
        chained = many or edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        if not chained:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        step += 1
        edges = _store(small, f"{folder}/round{step}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
