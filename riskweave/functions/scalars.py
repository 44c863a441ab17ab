"""Row-level expressions.  All are built-in functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import NUM_SENTINEL, TEXT_SENTINEL
from .rulebook import RISK_TIERS, TIME_BUCKET_REST, TIME_BUCKETS

SECONDS_PER_DAY = 86400


def hour_of(seconds: Column) -> Column:
    """Hour 0-23 of an offset in seconds."""
    return F.floor((seconds % SECONDS_PER_DAY) / 3600)


def dow_of(seconds: Column) -> Column:
    """Day 0-6 within a relative week; not a calendar weekday."""
    return F.floor((seconds / SECONDS_PER_DAY) % 7)


def day_of(seconds: Column) -> Column:
    """Whole days since the origin."""
    return F.floor(seconds / SECONDS_PER_DAY)


def time_bucket(hour: Column) -> Column:
    """Named part of the day."""
    case = None
    for first, last, name in TIME_BUCKETS:
        test = hour.between(first, last)
        case = F.when(test, name) if case is None else case.when(test, name)
    return case.otherwise(TIME_BUCKET_REST)


def is_night(hour: Column) -> Column:
    first, last, _ = TIME_BUCKETS[0]
    return F.when(hour.between(first, last), 1).otherwise(0)


def log_amt(amount: Column) -> Column:
    return F.ln(amount + 1)


def amt_decimal(amount: Column) -> Column:
    """Fractional part, four digits."""
    return F.round(amount - F.floor(amount), 4)


def num_or_sentinel(c: Column) -> Column:
    return F.coalesce(c, F.lit(NUM_SENTINEL))


def str_or_unknown(c: Column) -> Column:
    return F.coalesce(c, F.lit(TEXT_SENTINEL))


def flag_or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def flag(c: Column, true: str = "T") -> Column:
    """1 where the text equals ``true``; everything else, NULL included, is 0."""
    return F.when(c == true, 1).otherwise(0)


def bool_flag(c: Column) -> Column:
    """1 for true, 0 for false and NULL."""
    return F.when(c.cast("boolean"), 1).otherwise(0)


def no_signal(*cs: Column) -> Column:
    """1 when every input is NULL."""
    test = cs[0].isNull()
    for c in cs[1:]:
        test = test & c.isNull()
    return F.when(test, 1).otherwise(0)


def try_int(c: Column) -> Column:
    """Whole number in the text, NULL where there is none; fractions round half up.

    The pattern keeps junk away from the cast, whose failures are costly.
    """
    number = F.when(c.rlike(r"^\s*[+-]?[0-9]+([.][0-9]*)?\s*$"), c.try_cast("decimal(38,6)"))
    return F.round(number, 0).try_cast("bigint")


def screen_part(c: Column, n: int) -> Column:
    """``n``-th side of a ``<width>x<height>`` text."""
    return F.coalesce(try_int(F.split_part(c, F.lit("x"), F.lit(n))), F.lit(-999).cast("bigint"))


def match_status(c: Column) -> Column:
    """Ordinal behind the ``match_status:`` prefix."""
    return F.coalesce(
        try_int(F.replace(c, F.lit("match_status:"), F.lit(""))), F.lit(-999).cast("bigint")
    )


def chrome_major(folded: Column | str) -> Column:
    """Major version after ``chrome `` in lower-cased text, NULL where there is none."""
    digits = F.regexp_extract(folded, "chrome ([0-9]+)", 1)
    # the empty text of a miss must not reach the cast: a failed cast costs 30 times a good one
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def chrome_bucket(folded: Column, major: Column, buckets) -> Column:
    """Version bucket; NULL for anything that is not Chrome."""
    bounds, newest, unreadable = buckets
    version = F.when(major.isNull(), unreadable)
    for bound, name in bounds:
        version = version.when(major < bound, name)
    return F.when(folded.contains("chrome"), version.otherwise(newest))


def is_exotic(text: Column, names) -> Column:
    return F.when(text.isin(*names), 1).otherwise(0)


def uid(card: Column, addr: Column) -> Column:
    """Pseudo customer: card and billing address; NULL when either is."""
    return F.concat(card.cast("string"), F.lit("_"), addr.cast("string"))


def amount_ratio(amount: Column, average: Column) -> Column:
    """Amount relative to the card's average, NULL where that average is 0."""
    return amount / F.nullif(average, F.lit(0.0))


def device_group(device_type: Column, hit: Column) -> Column:
    """Desktop, mobile, no identity row at all, or an identity row without device type."""
    return (
        F.when(device_type.isin("desktop", "mobile"), device_type)
        .when(hit.isNull(), "no_identity_match")
        .otherwise("unknown_device")
    )


def half_up(num: Column, den: Column, scale: int, digits: int) -> Column:
    """``num / den * scale`` rounded half up to ``digits``, computed on whole numbers.

    Both inputs are non-negative counts.  Integer arithmetic makes the last digit independent of
    binary fractions; NULL when ``den`` is 0.
    """
    whole = F.call_function(
        "div",
        num * F.lit(2 * scale * 10**digits).cast("bigint") + den,
        F.nullif(den * F.lit(2).cast("bigint"), F.lit(0).cast("bigint")),
    )
    return whole / F.lit(float(10**digits))


def pct2(num: Column, den: Column) -> Column:
    """Percentage with two digits."""
    return half_up(num, den, 100, 2)


def risk_tier(score: Column) -> Column:
    """Tier of a score in right-closed intervals; 0 and anything above 1 get none."""
    case = F.when(score <= 0, F.lit(None).cast("string"))
    for upper, name in RISK_TIERS:
        case = case.when(score <= upper, name)
    return case


def predict_at(score: Column, threshold: float = 0.5) -> Column:
    return (score >= threshold).cast("int")
