"""Connected components over a table of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.session import write_once


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("x")).select("x.u", "x.v")


def _to_least(pairs: DataFrame) -> DataFrame:
    """Each pair (u, v) with the least id among u and all its v. The join's pair side is split by AQE where a u is hot."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("key"), F.least("u", "m").alias("m"))
    return pairs.join(least, pairs.u == least.key).select("u", "v", "m")


def component_roots(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``: the root is the least node reachable.

    A round hangs a node's larger neighbours on its least neighbour, then its smaller ones. A node keeps no list
    of neighbours anywhere: both steps are a minimum per node and a join. Each round is written to the
    shared folder, so a lost executor costs one round at most. Null ends are ignored; loops and repeats do no harm.
    """
    edges = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = write_once(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    # A forest is at rest when every node hangs on a root: no node is both a child and a parent.
    while True:
        large = _to_least(_both_ways(edges)).where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
        hung = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _to_least(hung)
        step = small.select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
                                              F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("x"))
        edges = write_once(step.select("x.a", "x.b").where(F.col("a") != F.col("b")).distinct(), "links")
        children = edges.groupBy("a").agg(F.count("*").alias("parents"))
        unsettled = children.where(F.col("parents") > 1).select("a").union(
            edges.join(children.select(F.col("a").alias("child")), F.col("b") == F.col("child"), "left_semi").select("b"))
        if unsettled.isEmpty():
            break
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
