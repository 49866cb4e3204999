"""Connected components of a graph by alternating star contraction, in DataFrame operations only.

Every round links each node's larger neighbours to its smallest one, then each node and its smaller neighbours to the
smallest of them, until nothing changes: then every node is linked to its component's smallest node. Minima are taken with partial
aggregation and joined back by :func:`lookup`, so a node with a large share of the edges loads no single task. Tables of a round go
when the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import dropped, written
from ._skew import lookup


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for every node of the edges (a, b); roots have a row too.

    Null ends and loops are ignored, except that a loop makes its node known. Repeated edges do no harm. No edges give no rows.
    """
    known = edges.select(F.col("a").alias("node")).union(edges.select("b")).filter("node IS NOT NULL").distinct()
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = written(e, "edges")
    now = _state(e)
    while now[0]:
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select("v", "u"))
        least = written(both.groupBy("x").agg(F.min("y").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("x", "m")), "edges")
        large = lookup(both.filter("y > x"), least, "x", "n", 2 * now[0]).select(F.col("y").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = written(large, "edges")
        n_large = large.count()
        smallest = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "edges")
        moved = lookup(large, smallest, "u", "n", n_large).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        stars = written(moved.union(smallest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        dropped(e, least, large, smallest)
        e, before, now = stars, now, _state(stars)
        if now == before:
            break
    return known.join(e.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node"))
