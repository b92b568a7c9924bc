"""One id per person across sources: connected components over shared keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.shaping import union_all
from martloom.session import write_once


def identity_clusters(records: DataFrame, record_id: str, keys: Mapping[str, str], out: str = "person_id") -> DataFrame:
    """Smallest record id reachable through equal keys, transitively.

    ``keys`` maps a key kind to its column. Every key links its records to the
    smallest of them, never pairwise. Then two contraction steps alternate until
    nothing moves: neighbours above a record link to its smallest neighbour, then
    neighbours below it do. The number of rounds grows with the logarithm of the
    graph, not with its longest chain, and each round is written out.
    """
    records = write_once(records.select(record_id, *keys.values()), "records")
    ids = records.select(F.col(record_id).alias("rec")).where("rec IS NOT NULL").distinct()
    kinds = [F.struct(F.lit(kind).alias("kind"), F.col(column).alias("value")) for kind, column in keys.items()]
    held = (records.select(F.col(record_id).alias("rec"), F.inline(F.array(*kinds)))
            .where("rec IS NOT NULL AND value IS NOT NULL").distinct())
    roots = held.groupBy("kind", "value").agg(F.min("rec").alias("low"))
    edges = held.join(roots, ["kind", "value"]).select(F.col("rec").alias("high"), "low")
    edges = write_once(edges.where("high <> low").distinct(), "edges")

    state = None
    while True:
        # Each half step reads its edges several times, so each is written.
        edges = write_once(_contract_lower(write_once(_contract_upper(edges), "edges")), "edges")
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first()
        if seen == state:
            break
        state = seen
    labels = edges.select(F.col("high").alias("rec"), "low")
    return ids.join(labels, "rec", "left").select(
        F.col("rec").alias(record_id), F.coalesce("low", "rec").alias(out))


def _contract_upper(edges: DataFrame) -> DataFrame:
    """Each record links its larger neighbours to the smallest of its neighbourhood."""
    both = union_all(edges, edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    smallest = both.groupBy("high").agg(F.least(F.min("low"), F.col("high")).alias("root"))
    return (both.join(smallest, "high").where("low > high")
            .select(F.col("low").alias("high"), F.col("root").alias("low"))
            .where("high <> low").distinct())


def _contract_lower(edges: DataFrame) -> DataFrame:
    """Each record links itself and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("high").agg(F.min("low").alias("root"))
    below = edges.join(smallest, "high").select(F.col("low").alias("high"), F.col("root").alias("low"))
    itself = smallest.select("high", F.col("root").alias("low"))
    return union_all(below, itself).where("high <> low").distinct()
