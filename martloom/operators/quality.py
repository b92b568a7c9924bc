"""Declarative data checks, compiled into one aggregate per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom.operators.joins import orphans
from martloom.operators.shaping import union_all

_COMPARE = {
    "=": lambda a, b: a == b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
}


@dataclass(frozen=True)
class Check:
    """One check: a measured number and the test it must pass.

    ``measure`` is an aggregate expression. Checks that need their own grouping
    (duplicates, relationships) build a one-row frame through ``frame`` instead.
    """

    name: str
    passes: tuple[str, float]
    measure: Column | None = None
    frame: object = field(default=None, compare=False)
    warns: tuple[str, float] | None = None

    # -- counts of offending rows --------------------------------------------

    @staticmethod
    def row_count(op: str = ">", n: int = 0) -> Check:
        return Check(f"row_count {op} {n}", (op, n), F.count("*"))

    @staticmethod
    def missing(column: str) -> Check:
        return _none_of(f"missing_count({column})", F.col(column).isNull())

    @staticmethod
    def in_range(column: str, low: float | None = None, high: float | None = None) -> Check:
        outside = F.lit(False)
        if low is not None:
            outside = outside | (F.col(column) < low)
        if high is not None:
            outside = outside | (F.col(column) > high)
        return _none_of(f"invalid_range({column})", outside)

    @staticmethod
    def matches(column: str, pattern: str) -> Check:
        return _none_of(f"invalid_regex({column})", ~F.col(column).rlike(pattern))

    @staticmethod
    def accepted(column: str, values: Sequence[str]) -> Check:
        return _none_of(f"accepted_values({column})", ~F.col(column).isin(list(values)))

    @staticmethod
    def fails(name: str, condition: Column | str) -> Check:
        test = F.expr(condition) if isinstance(condition, str) else condition
        return _none_of(f"failed_rows({name})", test)

    # -- other measures ------------------------------------------------------

    @staticmethod
    def metric(sql: str, op: str, n: float) -> Check:
        return Check(f"{sql} {op} {n}", (op, n), F.expr(sql))

    @staticmethod
    def freshness(column: str, as_of: Column, warn_hours: float, error_hours: float) -> Check:
        """Age in hours of the newest row; no row at all counts as infinitely old."""
        age = (F.unix_micros(as_of) - F.unix_micros(F.max(column))) / 3_600_000_000
        return Check(f"freshness({column})", ("<", error_hours), F.coalesce(age, F.lit(float("inf"))),
                     warns=("<", warn_hours))

    @staticmethod
    def duplicates(*columns: str) -> Check:
        """Number of values that occur more than once."""
        def frame(df: DataFrame) -> DataFrame:
            return duplicates(df, columns).agg(F.count("*").cast("double").alias("measured"))
        return Check(f"duplicate_count({', '.join(columns)})", ("=", 0), frame=frame)

    @staticmethod
    def relationship(fk: str, dim: DataFrame | Callable[[], DataFrame], pk: str) -> Check:
        """``dim`` may be a function, called when the check runs: by then the dimension may stand as a table."""
        def frame(df: DataFrame) -> DataFrame:
            return orphans(df, fk, dim() if callable(dim) else dim, pk).agg(F.count("*").cast("double").alias("measured"))
        return Check(f"relationship({fk})", ("=", 0), frame=frame)

    def status(self) -> Column:
        op, n = self.passes
        ok = _COMPARE[op](F.col("measured"), F.lit(float(n)))
        if self.warns is None:
            return F.when(ok, "pass").otherwise("fail")
        warn_op, limit = self.warns
        good = _COMPARE[warn_op](F.col("measured"), F.lit(float(limit)))
        return F.when(good, "pass").when(ok, "warn").otherwise("fail")


def _none_of(name: str, offending: Column) -> Check:
    return Check(name, ("=", 0), F.count_if(offending))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check, measured, status). All plain checks share one scan and one aggregate."""
    plain = [c for c in checks if c.measure is not None]
    frames = []
    if plain:
        totals = df.agg(*[c.measure.cast("double").alias(f"m{i}") for i, c in enumerate(plain)])
        rows = [F.struct(F.lit(c.name).alias("check"), F.col(f"m{i}").alias("measured")) for i, c in enumerate(plain)]
        frames.append(totals.select(F.inline(F.array(*rows))))
    for check in (c for c in checks if c.frame is not None):
        frames.append(check.frame(df).select(F.lit(check.name).alias("check"), "measured"))
    verdict = F.coalesce(*[F.when(F.col("check") == c.name, c.status()) for c in checks])
    return union_all(*frames).withColumn("status", verdict)


def observed(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation]:
    """The frame, and an observation of its plain checks that is filled when the frame is written: no scan of their own."""
    seen = Observation()
    plain = [c.measure.cast("double").alias(f"m{i}") for i, c in enumerate(checks) if c.measure is not None]
    return df.observe(seen, *(plain or [F.count("*").alias("rows")])), seen


def observed_report(written: DataFrame, checks: Sequence[Check], seen: Observation) -> DataFrame:
    """The report of ``run_checks`` after a write that was observed: only checks with a grouping of their own read the table."""
    if written.isEmpty():  # an empty frame is planned away together with what observes it
        return run_checks(written, checks)
    values = seen.get
    rows = [(c.name, values[f"m{i}"]) for i, c in enumerate(checks) if c.measure is not None]
    plain = written.sparkSession.createDataFrame(rows, "check string, measured double")
    grouped = [c.frame(written).select(F.lit(c.name).alias("check"), "measured") for c in checks if c.frame is not None]
    verdict = F.coalesce(*[F.when(F.col("check") == c.name, c.status()) for c in checks])
    return union_all(plain, *grouped).withColumn("status", verdict)


class QualityGateError(RuntimeError):
    """A table failed its checks, so the next layer must not be built."""


def gate(table: str, report: DataFrame) -> None:
    # One row per declared check.
    failed = [f"{r['check']} (measured {r['measured']})" for r in report.where("status = 'fail'").collect()]
    if failed:
        raise QualityGateError(f"{table}: {'; '.join(failed)}")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts; rows without a key do not count."""
    present = df.where(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull())
    return present.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def silent_sources(spark: SparkSession, counts: DataFrame, expected: Sequence[str], as_of: Column,
                   hours: int = 2) -> DataFrame:
    """Expected sources without a row in the last hours. ``counts(source, last_seen)``."""
    names = spark.createDataFrame([(name,) for name in expected], "source string")
    recent = (counts.where(F.col("last_seen") > as_of - F.expr(f"INTERVAL {int(hours)} HOURS"))
              .select("source").distinct())
    return names.join(recent, "source", "left_anti")


def last_seen(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Newest time stamp per source."""
    return union_all(*[df.agg(F.max(ts).alias("last_seen")).select(F.lit(source).alias("source"), "last_seen")
                       for source, (df, ts) in frames.items()])
