"""Change envelopes, merges, retention and masking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.dedup import latest_per_key


def apply_cdc(changes: DataFrame, key: str, seq: str, row: str = "after", op: str = "op") -> DataFrame:
    """Current rows from change envelopes: newest change per key, deletions dropped.

    A deletion carries no row image, so its key is read from ``before``.
    """
    fields = [f for f in changes.schema[row].dataType.names if f != key]
    flat = changes.select(
        F.coalesce(F.col(f"{row}.{key}"), F.col(f"before.{key}")).alias(key),
        *[F.col(f"{row}.{f}").alias(f) for f in fields], F.col(op).alias("_op"), F.col(seq).alias("_seq"))
    newest = latest_per_key(flat, [key], "_seq", ["_op"])
    return newest.where("_op <> 'd'").drop("_op", "_seq")


def merge_by_key(target: DataFrame, updates: DataFrame, key: Sequence[str], version: str,
                 tie_break: Sequence[Column | str]) -> DataFrame:
    """Upsert: the newest version of every key of both frames."""
    return latest_per_key(target.unionByName(updates), list(key), version, tie_break)


def above_high_water(updates: DataFrame, target: DataFrame, version: str) -> DataFrame:
    """Rows newer than anything the target holds; all rows when it is empty."""
    mark = target.agg(F.max(version)).first()[0]
    return updates if mark is None else updates.where(F.col(version) > F.lit(mark))


def summing_read(df: DataFrame, keys: Sequence[str], sums: Sequence[str],
                 means: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Merge rows of equal key: additive columns are summed, means recomputed from sums."""
    merged = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    for name, (total, count) in (means or {}).items():
        kind = df.schema[name].dataType
        merged = merged.withColumn(name, (F.col(total) / F.col(count)).cast(kind))
    return merged


def replacing_read(df: DataFrame, keys: Sequence[str], version: str,
                   tie_break: Sequence[Column | str]) -> DataFrame:
    """Keep the row with the highest version of each key."""
    return latest_per_key(df, keys, version, tie_break)


def retain(df: DataFrame, ts: str, days: int, as_of: Column) -> DataFrame:
    """Drop rows whose event time is further back than the retention. The plain column is compared, so the scan can skip old row groups."""
    return df.where(F.col(ts) > as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def views_by_group(frames: Mapping[str, DataFrame], policy: DataFrame) -> dict[tuple[str, str], DataFrame]:
    """What each consumer group may see: ``(group, table)`` to a frame.

    ``policy(consumer_group, table_name, column_name, rule)`` is a small table somebody keeps by hand; rules are ``keep`` and those
    of ``mask``. A column without a rule is hidden, and a table without rules is no view of the group.
    """
    rules: dict[tuple[str, str], dict[str, str]] = {}
    for r in policy.select("consumer_group", "table_name", "column_name", "rule").collect():
        rules.setdefault((r[0], r[1]), {})[r[2]] = r[3]
    views = {}
    for (group, table), allowed in rules.items():
        if table in frames:
            seen = [c for c in frames[table].columns if allowed.get(c, "drop") != "drop"]
            views[group, table] = mask(frames[table].select(*seen), {c: allowed[c] for c in seen if allowed[c] != "keep"})
    return views


def register_group_views(frames: Mapping[str, DataFrame], policy: DataFrame) -> list[str]:
    """Temp views ``{group}__{table}`` of all of a policy."""
    views = views_by_group(frames, policy)
    for (group, table), frame in views.items():
        frame.createOrReplaceTempView(f"{group}__{table}")
    return sorted(f"{group}__{table}" for group, table in views)


def mask(df: DataFrame, policy: Mapping[str, str]) -> DataFrame:
    """Hide columns: ``hash`` (sha-256), ``tail`` (last three characters stay), ``email``, ``drop``."""
    shapes = {
        "hash": lambda c: F.sha2(c, 256),
        "tail": lambda c: F.concat(F.repeat(F.lit("*"), F.greatest(F.length(c) - 3, F.lit(0))), F.right(c, F.lit(3))),
        "email": lambda c: F.regexp_replace(c, "^[^@]*", "***"),
    }
    dropped = [name for name, how in policy.items() if how == "drop"]
    masked = {name: shapes[how](F.col(name).cast(T.StringType())) for name, how in policy.items() if how != "drop"}
    return df.drop(*dropped).withColumns(masked)
