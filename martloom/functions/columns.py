"""Reusable column expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Fixed value: placeholder for a null part of a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- identity fields --------------------------------------------------------

def phone_digits(phone: ColumnLike) -> Column:
    """Digits only, with a leading country code 84 written as 0."""
    digits = F.regexp_replace(as_col(phone), "[^0-9]", "")
    return F.regexp_replace(digits, "^84", "0")


def phone_normalize(phone: ColumnLike) -> Column:
    """Drop blanks and dashes; +84, or 84 on 11 or more characters, becomes 0."""
    raw = as_col(phone)
    compact = F.translate(raw, " -", "")
    long_84 = raw.startswith("84") & (F.length(compact) >= 11)
    return (
        F.when(raw.startswith("+84"), F.concat(F.lit("0"), F.substr(compact, F.lit(4))))
        .when(long_84, F.concat(F.lit("0"), F.substr(compact, F.lit(3))))
        .otherwise(compact)
    )


def email_normalize(email: ColumnLike) -> Column:
    return F.lower(F.trim(as_col(email)))


def surrogate_key(*parts: ColumnLike) -> Column:
    """md5 over the dash-joined parts, nulls replaced by a placeholder."""
    filled = [F.coalesce(as_col(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *filled))


def packed_key(key: ColumnLike) -> Column:
    """A text key as bytes, half as long if it is an md5 in lower case; different keys stay different.

    Only such a key has 16 bytes: all others get a tail that makes them longer.
    """
    text = as_col(key).cast("string")
    raw = F.unhex(text)
    is_md5 = (F.length(text) == 32) & (F.lower(F.hex(raw)) == text)
    return F.when(is_md5, raw).otherwise(F.concat(text.cast("binary"), F.lit(bytes(17))))


# --- arithmetic -------------------------------------------------------------

def safe_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Floating division; null where the denominator is 0 or null."""
    top = as_col(numerator).cast("double")
    return top / F.nullif(as_col(denominator).cast("double"), F.lit(0.0))


def exact_mean(value: ColumnLike) -> Column:
    """Mean of an integral column as one division of two exact totals.

    The built-in mean adds doubles, which makes large money sums depend on the
    order in which partial sums arrive.
    """
    col = as_col(value)
    return safe_ratio(F.sum(col), F.count(col))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def last_by(value: ColumnLike, ts: ColumnLike) -> Column:
    """Latest non-null value by event time; equal times fall back to the larger value."""
    col = as_col(value)
    return F.max(F.when(col.isNotNull(), F.struct(as_col(ts).alias("t"), col.alias("v"))))["v"]


# --- dates ------------------------------------------------------------------

def month_start(day: ColumnLike) -> Column:
    return F.trunc(as_col(day), "MM")


def quarter_start(day: ColumnLike) -> Column:
    return F.trunc(as_col(day), "quarter")


def days_between(start: ColumnLike, end: ColumnLike) -> Column:
    return F.datediff(as_col(end), as_col(start))


def seconds_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole elapsed seconds, truncated toward zero."""
    micros = F.unix_micros(as_col(end)) - F.unix_micros(as_col(start))
    return (micros / F.lit(1_000_000)).cast("bigint")


def iso_weekday(day: ColumnLike) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(as_col(day)) + F.lit(1)


def calendar_parts(day: ColumnLike) -> dict[str, Column]:
    d = as_col(day)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": iso_weekday(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": iso_weekday(d) >= 6,
        "day_name": F.date_format(d, "EEEE"),
        "month_name": F.date_format(d, "MMMM"),
        "first_day_of_month": month_start(d),
        "first_day_of_quarter": quarter_start(d),
        "year_quarter": F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")),
        "year_month": F.date_format(d, "yyyy-MM"),
    }


def parse_any_date(text: ColumnLike, formats: Sequence[str] = ("yyyy-MM-dd", "dd/MM/yyyy")) -> Column:
    """First format that parses wins; text no format fits becomes null."""
    return F.coalesce(*[F.try_to_timestamp(as_col(text), F.lit(fmt)) for fmt in formats])


def to_utc(local_ts: ColumnLike, tz: str = "Asia/Ho_Chi_Minh") -> Column:
    return F.to_utc_timestamp(as_col(local_ts), tz)
