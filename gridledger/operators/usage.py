"""Weekly usage metrics and the weekly -> season rollup."""

from pyspark.sql import functions as F

from gridledger import schemas
from gridledger.functions.numeric import (
    count_where,
    fantasy_points_full,
    points_from_cents,
    share,
    sum_or_zero,
    zero,
)
from gridledger.operators import roles
from gridledger.operators.clean import align, rename_present
from gridledger.operators.dims import enrich_roster
from gridledger import fixed_values as fv

TEAM_WEEK = ["team_id", "season", "week"]


def target_counts(plays):
    """Targets (rows with a receiver) and receptions by player-week and team."""
    lines = roles.receiving_weekly(plays)
    return lines.select("gsis_id", "season", "week", "team_id", "targets", "receptions")


def team_week(plays):
    """Team air yards and targets by week, in one pass.

    Every play with type ``pass`` is a team target, with or without a receiver.
    """
    keyed = plays.withColumn("team_id", F.col("posteam")).dropna(subset=TEAM_WEEK)
    return keyed.groupBy(*TEAM_WEEK).agg(
        sum_or_zero("air_yards").alias("team_air_yards"),
        count_where(F.col("play_type") == "pass").alias("team_targets"),
    )


def team_week_air_yards(plays):
    return team_week(plays).select(*TEAM_WEEK, "team_air_yards")


def with_team_context(lines, team_totals):
    """Left join on team and week; both sides are already grouped."""
    return lines.join(team_totals, TEAM_WEEK, "left")


def _with_metrics(joined):
    shares = joined.withColumns(
        {
            "target_share": share(F.col("targets"), F.col("team_targets")),
            "air_yards_share": share(F.col("receiving_air_yards"), F.col("team_air_yards")),
        }
    )
    wopr = F.lit(1.5) * F.col("target_share") + F.lit(0.7) * F.col("air_yards_share")
    return shares.withColumn("wopr", wopr)


def usage_metrics(lines, team_totals):
    """target_share, air_yards_share and WOPR = 1.5 ts + 0.7 ays."""
    return _with_metrics(with_team_context(lines, team_totals))


def player_weekly_usage(plays, with_points=True):
    """All roles by player-week with usage metrics, missing EPA as 0.

    The team is the one the player lined up for, for rushers as well. Plays are
    read once for the players' lines and the teams' totals.
    """
    lines = _with_metrics(roles.weekly_lines(plays, team_totals=True))
    points = fantasy_points_full(lines) if with_points else F.lit(0.0)
    means = {name: zero(F.col(name)) for name in roles.WEEK_MEANS}
    return lines.withColumns(means | {"fantasy_points": points})


def weekly_stats(plays, with_points=True):
    """The 24-column weekly table."""
    lines = player_weekly_usage(plays, with_points)
    return lines.select(*fv.WEEKLY_STATS_COLUMNS)


def align_history(history):
    """Pre-aggregated weekly history renamed and aligned to the weekly table."""
    return align(rename_present(history, fv.HISTORY_RENAMES), schemas.WEEKLY_STATS)


SEASON_SUMS = [
    "passing_yards", "passing_tds", "interceptions", "rushing_yards", "rushing_tds",
    "receiving_yards", "receiving_tds", "receptions",
]


def season_rollup(weekly):
    """Season sums, and plain means of the weekly EPA, WOPR and target share."""
    keys = ["gsis_id", "season", "team_id"]
    return weekly.dropna(subset=keys).groupBy(*keys).agg(
        *[sum_or_zero(c).alias(c) for c in SEASON_SUMS],
        *[F.avg(c).alias(c) for c in roles.SEASON_MEANS],
    )


def season_table(weekly, roster=None):
    """The whole season row from weekly lines: sums, means, points, latest week.

    One rule for every job that writes the season table. ``sacks`` and
    ``fumbles_lost`` count 0 where the weekly lines (such as older history) do
    not have them; points are the sum of the weeks' points, in hundredths. Rows
    of exactly zero points stay, as EPA and usage are theirs all the same.
    """
    keys = ["gsis_id", "season", "team_id"]
    cents = F.round(zero(F.col("fantasy_points")) * 100).cast("long")
    rows = weekly.dropna(subset=keys)
    extra = {"sacks_taken": "sacks", "fumbles_lost": "fumbles_lost"}
    table = rows.groupBy(*keys).agg(
        *[sum_or_zero(c).alias(c) for c in SEASON_SUMS],
        *[
            (sum_or_zero(c) if c in weekly.columns else F.lit(0).cast("long")).alias(out)
            for out, c in extra.items()
        ],
        *[F.avg(zero(F.col(c))).alias(c) for c in roles.SEASON_MEANS],
        points_from_cents(F.sum(cents)).alias("fantasy_points"),
        F.max("week").alias("last_week"),
        F.count(F.lit(1)).alias("weeks"),
    )
    return table if roster is None else enrich_roster(table, roster)
