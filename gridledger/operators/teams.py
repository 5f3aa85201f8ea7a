"""Team season totals from plays."""

from pyspark.sql import functions as F

from gridledger.functions.numeric import sum_or_zero
from gridledger.operators.clean import not_null

DEFENSE_SUMS = {
    "def_sacks_made": "sack",
    "def_interceptions": "interception",
    "def_fumbles_recovered": "fumble_lost",
}

OFFENSE_SUMS = {
    "off_total_yards": "yards_gained",
    "off_total_tds": "touchdown",
    "off_sacks_allowed": "sack",
    "off_fumbles_lost": "fumble_lost",
    "off_interceptions": "interception",
}


def _team_sums(plays, team, sums):
    keyed = not_null(plays.withColumn("team_id", F.col(team)), ["team_id", "season"])
    return keyed.groupBy("team_id", "season").agg(
        *[sum_or_zero(source).alias(out) for out, source in sums.items()]
    )


def team_defense(plays):
    return _team_sums(plays, "defteam", DEFENSE_SUMS)


def team_offense(plays):
    return _team_sums(plays, "posteam", OFFENSE_SUMS)


def team_season(plays):
    """Defence and offence side by side; a team seen on one side only gets 0s.

    Each play yields one row for either side and all are grouped once, in
    place of two grouped tables and a full outer join.
    """
    sides = F.array(
        F.struct(F.lit("off").alias("side"), F.col("posteam").alias("team_id")),
        F.struct(F.lit("def").alias("side"), F.col("defteam").alias("team_id")),
    )
    lines = plays.filter(F.col("season").isNotNull()).select("*", F.inline(sides))
    lines = not_null(lines, ["team_id"])

    def on(side, source):
        return sum_or_zero(F.when(F.col("side") == side, F.col(source)))

    return lines.groupBy("team_id", "season").agg(
        *[on("def", source).alias(out) for out, source in DEFENSE_SUMS.items()],
        *[on("off", source).alias(out) for out, source in OFFENSE_SUMS.items()],
    )


def season_teams(team_stats, season):
    """The teams of a season, sorted."""
    return (
        team_stats.filter(F.col("season") == season).select("team_id").distinct().orderBy("team_id")
    )


def team_stats_for(team_stats, team, season):
    return team_stats.filter((F.col("team_id") == team) & (F.col("season") == season))
