"""Season and week of a calendar date."""

from pyspark.sql import functions as F

# January and February belong to the previous season, a season
# starts on 5 September, weeks are capped at 18.
SEASON_FIRST_MONTH = 3
SEASON_START_MONTH, SEASON_START_DAY = 9, 5
LAST_WEEK = 18


def season_of(date):
    early = F.when(F.month(date) < SEASON_FIRST_MONTH, 1).otherwise(0)
    return (F.year(date) - early).cast("int")


def week_of(date):
    """1 before the season opens, then full weeks since the opening, at most 18."""
    opening = F.make_date(season_of(date), F.lit(SEASON_START_MONTH), F.lit(SEASON_START_DAY))
    days = F.datediff(date, opening)
    week = F.call_function("div", days, F.lit(7)) + 1
    return F.when(days < 0, 1).otherwise(F.least(week, F.lit(LAST_WEEK))).cast("int")
