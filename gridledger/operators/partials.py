"""Season sums kept up to date by signed changes of weeks.

A partial is one row per player, season and team: additive sums from which the season
row follows. Lines that come are added, lines that go are taken away, so a season is
brought up to date from its changed weeks and its partials, without its other weeks.
Everything is summed exactly (whole numbers, or decimals of what a mean is taken over),
so any order of changes ends in what a rebuild gives.

The latest week cannot be found by adding and taking away. A partial therefore carries
the sum of 2^week over its lines: as a player has one line per week and team, its bits
are the weeks present. Lines that repeat a week, or were never added, show in the count
of the bits and fail the job.
"""

from functools import reduce

from pyspark.sql import functions as F

from gridledger.functions.numeric import points_from_cents, sum_or_zero, zero
from gridledger.operators import roles
from gridledger.operators.dims import enrich_roster
from gridledger.operators.usage import SEASON_SUMS

KEYS = ["gsis_id", "season", "team_id"]
#: Weekly column -> season column, for those that older lines may lack.
RENAMED = {"sacks": "sacks_taken", "fumbles_lost": "fumbles_lost"}
SUMS = [*SEASON_SUMS, *RENAMED.values()]
LAST_WEEK = 61
_EXACT = "decimal(28,18)"
_SUMMED = [*SUMS, "cents", *[f"sum_{c}" for c in roles.SEASON_MEANS], "week_bits", "weeks"]


def week_partials(lines):
    """Partials of weekly lines (``usage.weekly_stats``, with ``fumbles_lost`` if known).

    Lines without player, season or team are left out; missing values count 0.
    """
    bit = F.expr(f"CASE WHEN week BETWEEN 0 AND {LAST_WEEK} THEN shiftleft(1L, week) ELSE 0L END")
    extra = {out: c for c, out in RENAMED.items()}
    sums = {c: extra.get(c, c) for c in SUMS}
    return lines.dropna(subset=KEYS).groupBy(*KEYS).agg(
        *[
            (sum_or_zero(c) if c in lines.columns or out not in extra else F.lit(0).cast("long")).alias(out)
            for out, c in sums.items()
        ],
        F.sum(F.round(zero(F.col("fantasy_points")) * 100).cast("long")).alias("cents"),
        *[F.sum(zero(F.col(c)).cast(_EXACT)).alias(f"sum_{c}") for c in roles.SEASON_MEANS],
        F.sum(bit).alias("week_bits"),
        F.count(F.lit(1)).alias("weeks"),
    )


def _negative(partials):
    return partials.withColumns({c: -F.col(c) for c in _SUMMED})


def _added(frames):
    rows = reduce(lambda a, b: a.unionByName(b), frames)
    return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in _SUMMED])


def week_changes(before, after):
    """Signed partials that lead from the stored lines of some weeks to their new ones;
    players whose lines stayed as they were have none."""
    moved = _added([_negative(week_partials(before)), week_partials(after)])
    return moved.filter(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in _SUMMED]))


def merged(partials, changes):
    """Partials with signed changes added; players without a line left are gone."""
    return _added([partials, changes]).filter("weeks <> 0")


def season_rows(partials, roster=None):
    """The season table's rows, as ``usage.season_table`` gives them from all weeks."""
    known = F.bit_count("week_bits") == F.col("weeks")
    problem = F.concat(
        F.lit("weekly lines repeated or never stored: player "), F.col("gsis_id").cast("string"),
        F.lit(" season "), F.col("season").cast("string"),
    )
    last = F.when(known, F.length(F.bin("week_bits")) - 1).otherwise(F.raise_error(problem).cast("int"))
    table = partials.select(
        *KEYS, *SUMS,
        *[(F.col(f"sum_{c}").cast("double") / F.col("weeks")).alias(c) for c in roles.SEASON_MEANS],
        points_from_cents(F.col("cents")).alias("fantasy_points"),
        last.alias("last_week"),
        "weeks",
    )
    return table if roster is None else enrich_roster(table, roster)
