"""Connected components of a link table, without collecting it anywhere.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each step replaces links by links
to the smallest neighbour and keeps connectivity; at the end every node links
straight to the smallest node of its component. Minima are map-side aggregates
and a hot node's links are an ordinary skewed join, so no group is ever held
by one task. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ordo.llm.tables import materialize, release


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over links (a > b). Large: a node's larger neighbours link to the
    smallest of the node and its neighbours. Small: the node and its smaller
    neighbours do. Links may repeat in the result."""
    around = links
    if large:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = around.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("low"))
    joined = around.join(low, around["a"] == low["node"])
    if large:
        return joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    # the link to the smallest neighbour itself stays as it is: b = low gives (a, low)
    moved = F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b"))
    return joined.select(moved.alias("a"), F.col("low").alias("b")).filter("a > b")


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct links in the shared folder and a fingerprint of them."""
    seen = Observation()
    out = materialize(links.distinct().observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), "links")
    return out, (seen.get["n"], seen.get["h"])


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node that has
    a link in ``links`` (bigint columns ``a``, ``b``; either order, repeats and
    loops allowed)."""
    now, mark = _written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b"))
    while mark[0]:
        # stars are the fixed point: every node links straight to the smallest of its component
        then, before = now, mark
        now, mark = _written(_star(_star(now, True), False))
        release(then)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
