"""Counting, ratios and fantasy points as column expressions.

Points and ratios stay in integers until the last division, so that every
engine gives the same digits.
"""

from pyspark.sql import functions as F


def column_or(df, name, default=None, dtype=None):
    """The column if the frame has it, else a typed literal."""
    if name in df.columns:
        return F.col(name)
    value = F.lit(default)
    return value.cast(dtype) if dtype else value


def count_where(condition):
    """Rows that satisfy the condition; one scan serves many such counts."""
    return F.count_if(condition)


def sum_or_zero(column):
    """Integer sum in which a group without values counts 0."""
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")


def zero(column):
    return F.coalesce(column, F.lit(0))


def round_ratio(num, den, scale):
    """num / den rounded half away from zero; NULL where den is not positive.

    Integer arithmetic: (2*10^n*|a| + b) div 2b, then one exact division.
    """
    num, den = num.cast("long"), den.cast("long")
    power = 10**scale
    safe = F.when(den > 0, den)
    scaled = F.call_function("div", F.abs(num) * (2 * power) + safe, safe * 2)
    return F.signum(num) * scaled / F.lit(float(power))


def share(num, den):
    """num / den, and 0 where the denominator is missing or not positive."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def to_number(column):
    """Text to a number; missing or unreadable text counts 0."""
    return F.coalesce(column.try_cast("double"), F.lit(0.0))


# Hundredths of a point per unit.
POINT_WEIGHTS = {
    "passing_yards": 4,
    "passing_tds": 400,
    "interceptions": -200,
    "rushing_yards": 10,
    "rushing_tds": 600,
    "receiving_yards": 10,
    "receiving_tds": 600,
    "receptions": 100,
    "fumbles_lost": -200,
}


def fantasy_cents(df, fumbles=True, missing="fail"):
    """Fantasy points in hundredths, exact for whole yards and counts.

    A column that the frame lacks fails, unless ``missing="zero"`` counts it 0.
    """
    names = [n for n in POINT_WEIGHTS if fumbles or n != "fumbles_lost"]
    absent = [n for n in names if n not in df.columns]
    if absent and missing != "zero":
        raise ValueError(f"points need {', '.join(absent)}")
    terms = [
        f"{POINT_WEIGHTS[n]} * coalesce(cast({n} AS bigint), 0)" for n in names if n not in absent
    ]
    return F.expr(" + ".join(terms or ["0L"]))


def points_from_cents(cents):
    return cents.cast("double") / F.lit(100.0)


def fantasy_points_full(df, missing="fail"):
    """The batch formula, with two points off per fumble lost."""
    return points_from_cents(fantasy_cents(df, missing=missing))


def fantasy_points_or_stored(df, stored="fantasy_points", missing="fail"):
    """The stored points unless NULL or 0, else the formula without fumbles."""
    fresh = points_from_cents(fantasy_cents(df, fumbles=False, missing=missing))
    if stored not in df.columns:
        return fresh
    value = F.col(stored).cast("double")
    return F.when(value != 0, value).otherwise(fresh)


def total_tds(df):
    """Passing + rushing + receiving touchdowns, NULL counting 0."""
    names = ("passing_tds", "rushing_tds", "receiving_tds")
    return sum((zero(F.col(n).cast("long")) for n in names), F.lit(0).cast("long"))


def percentile_label(percentile):
    """``Top 5%`` for percentile 95.x; the fraction is cut, not rounded."""
    return F.concat(F.lit("Top "), (100 - percentile.cast("int")).cast("string"), F.lit("%"))
