"""Play-by-play to player lines.

A play counts for up to three players: passer, rusher, receiver. Instead of
three grouped tables merged by full outer joins, each play is exploded into
its role rows and grouped once: one scan, one shuffle of pre-summed rows.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridledger.functions.numeric import fantasy_points_full
from gridledger.operators.clean import drop_empty_lines
from gridledger.operators.dims import enrich_roster

ROLES = ("passer", "rusher", "receiver")

# Output column -> (role, play column). Summed; a player without that role gets 0.
SEASON_SUMS = {
    "passing_yards": ("passer", "passing_yards"),
    "passing_tds": ("passer", "pass_touchdown"),
    "interceptions": ("passer", "interception"),
    "sacks_taken": ("passer", "sack"),
    "rushing_yards": ("rusher", "rushing_yards"),
    "rushing_tds": ("rusher", "rush_touchdown"),
    "fumbles_lost": ("rusher", "fumble_lost"),
    "receiving_yards": ("receiver", "receiving_yards"),
    "receiving_tds": ("receiver", "pass_touchdown"),
    "receptions": ("receiver", "complete_pass"),
}

WEEK_SUMS = {
    "completions": ("passer", "complete_pass"),
    "attempts": ("passer", "pass_attempt"),
    "passing_yards": ("passer", "passing_yards"),
    "passing_tds": ("passer", "pass_touchdown"),
    "interceptions": ("passer", "interception"),
    "sacks": ("passer", "sack"),
    "passing_air_yards": ("passer", "air_yards"),
    "carries": ("rusher", "rush_attempt"),
    "rushing_yards": ("rusher", "rushing_yards"),
    "rushing_tds": ("rusher", "rush_touchdown"),
    "fumbles_lost": ("rusher", "fumble_lost"),
    "receptions": ("receiver", "complete_pass"),
    "receiving_yards": ("receiver", "receiving_yards"),
    "receiving_tds": ("receiver", "pass_touchdown"),
    "receiving_air_yards": ("receiver", "air_yards"),
    "receiving_yards_after_catch": ("receiver", "yards_after_catch"),
}

# Means skip missing values and are zero only where a line has no value at all.
WEEK_MEANS = {
    "passing_epa": ("passer", "epa"),
    "passing_cpoe": ("passer", "cpoe"),
    "rushing_epa": ("rusher", "epa"),
    "receiving_epa": ("receiver", "epa"),
}

PASSING, RUSHING, RECEIVING = "passer", "rusher", "receiver"
# A line of the offence as a whole, without a player.
TEAM = "team"


def role_lines(plays, keys, roles=ROLES, team_line=False):
    """One row per (play, player involved), with ``role`` and ``gsis_id``.

    Rows without an id or without one of the keys are dropped, as grouping on
    missing keys would invent a player. ``team_line`` adds a row per play for
    the offence, with no id.
    """
    named = all(f"{r}_player_name" in plays.columns for r in roles)
    entries = []
    for role in roles:
        fields = [F.lit(role).alias("role"), F.col(f"{role}_player_id").alias("gsis_id")]
        if named:
            fields.append(F.col(f"{role}_player_name").alias("player_name"))
        entries.append(F.struct(*fields))
    if team_line:
        nobody = [F.lit(None).cast(plays.schema[f"{roles[0]}_player_id"].dataType).alias("gsis_id")]
        nobody += [F.lit(None).cast("string").alias("player_name")] if named else []
        entries.append(F.struct(F.lit(TEAM).alias("role"), *nobody))
    lines = plays.dropna(subset=list(keys)).select("*", F.inline(F.array(*entries)))
    return lines.filter(F.col("gsis_id").isNotNull() | (F.col("role") == TEAM))


def _by_role(lines, role, source):
    """SQL text of a play column where the line has that role."""
    return f"CASE WHEN role = '{role}' THEN {source if source in lines.columns else 'NULL'} END"


def _sums(lines, sums):
    return [
        F.expr(f"cast(coalesce(sum({_by_role(lines, *spec)}), 0) AS bigint) AS {out}")
        for out, spec in sums.items()
    ]


def _means(lines, means):
    return [
        F.expr(f"avg(cast({_by_role(lines, *spec)} AS double)) AS {out}")
        for out, spec in means.items()
    ]


def _group(lines, keys, sums):
    """Group by id and keys; ``last_week`` is kept where teams are told apart.

    Text minima force a sort-based aggregate, so with names present the wide
    rows are first summed by (id, keys, name) in a hash aggregate and the name
    is settled on the already summed rows.
    """
    aggregates = _sums(lines, sums)
    latest = []
    if "team_id" in keys and "week" in lines.columns:
        latest = [F.max("week").alias("last_week")]
    if "player_name" not in lines.columns:
        return lines.groupBy("gsis_id", *keys).agg(*aggregates, *latest)
    by_name = lines.groupBy("gsis_id", *keys, "player_name").agg(*aggregates, *latest)
    merged = [F.sum(c).alias(c) for c in sums]
    merged += [F.max("last_week").alias("last_week")] if latest else []
    return by_name.groupBy("gsis_id", *keys).agg(F.min("player_name").alias("player_name"), *merged)


def _with_team(plays, by):
    return plays.withColumn("team_id", F.col("posteam")) if "team_id" in by else plays


def join_roles(plays, by=("season", "team_id"), roles=ROLES):
    """Player totals over the roles by (id, *by); 0 where a role is absent."""
    plays = _with_team(plays, by)
    lines = role_lines(plays, by, roles)
    wanted = {out: spec for out, spec in SEASON_SUMS.items() if spec[0] in roles}
    return _group(lines, list(by), wanted)


def passing_season(plays, by=("season", "team_id")):
    return join_roles(plays, by, (PASSING,))


def rushing_season(plays, by=("season", "team_id")):
    return join_roles(plays, by, (RUSHING,))


def receiving_season(plays, by=("season", "team_id")):
    return join_roles(plays, by, (RECEIVING,))


def player_season_stats(plays, roster=None, by=("season", "team_id")):
    """Season lines with fantasy points; lines of exactly zero points are dropped."""
    stats = join_roles(plays, by)
    if roster is not None:
        stats = enrich_roster(stats, roster)
    return drop_empty_lines(stats.withColumn("fantasy_points", fantasy_points_full(stats)))


def weekly_lines(plays, roles=ROLES, targets="rows", team_totals=False):
    """Player-week lines by (id, season, week, team).

    ``targets="rows"`` counts plays with that receiver, ``"attempts"`` those
    with a pass-attempt flag. ``team_totals`` adds the team's air yards and
    targets of the week to every line, from the same scan: plays also count
    for a line without an id, whose sums a window over the team's week (its
    players and that line) hands to the others.
    """
    by = ("season", "week", "team_id")
    plays = _with_team(plays, by)
    lines = role_lines(plays, by, roles, team_totals).drop("player_name")

    def of_roles(measures):
        return {out: spec for out, spec in measures.items() if spec[0] in roles}

    aggregates = _sums(lines, of_roles(WEEK_SUMS)) + _means(lines, of_roles(WEEK_MEANS))
    if RECEIVING in roles:
        is_target = F.col("role") == RECEIVING
        if targets == "attempts":
            is_target = is_target & F.col("pass_attempt").isNotNull()
        aggregates.append(F.count_if(is_target).alias("targets"))
    if not team_totals:
        return lines.groupBy("gsis_id", *by).agg(*aggregates)
    of_team = F.col("role") == TEAM
    aggregates += [
        F.coalesce(F.sum(F.when(of_team, F.col("air_yards"))), F.lit(0)).cast("long").alias("_air"),
        F.count_if(of_team & (F.col("play_type") == "pass")).alias("_targets"),
    ]
    grouped = lines.groupBy("gsis_id", *by).agg(*aggregates)
    week = Window.partitionBy("team_id", "season", "week")
    return (
        grouped.withColumns(
            {
                "team_air_yards": F.max(F.when(F.col("gsis_id").isNull(), F.col("_air"))).over(week),
                "team_targets": F.max(F.when(F.col("gsis_id").isNull(), F.col("_targets"))).over(week),
            }
        )
        .filter(F.col("gsis_id").isNotNull())
        .drop("_air", "_targets")
    )


def passing_weekly(plays):
    return weekly_lines(plays, (PASSING,))


def rushing_weekly(plays):
    return weekly_lines(plays, (RUSHING,))


def receiving_weekly(plays, targets="rows"):
    return weekly_lines(plays, (RECEIVING,), targets)


# Means of weekly values, weighted by the weeks behind them when teams are joined.
SEASON_MEANS = ("passing_epa", "rushing_epa", "receiving_epa", "wopr", "target_share")


def collapse_teams(stats):
    """One row per (player, season): sums over teams, team of the latest week.

    Needs ``last_week``; where teams share it the greater team id stays. Whole
    numbers are summed. Means (see SEASON_MEANS) need ``weeks``, the number of
    weekly lines they were taken over, and stay means over all of them.
    """
    if "last_week" not in stats.columns:
        raise ValueError("the latest team needs last_week")
    means = [c for c in SEASON_MEANS if c in stats.columns]
    if means and "weeks" not in stats.columns:
        raise ValueError("joining means of several teams needs weeks")
    counts = [
        f.name
        for f in stats.schema.fields
        if f.dataType.typeName() in ("long", "integer")
        and f.name not in ("gsis_id", "season", "team_id", "last_week")
    ]
    latest = F.max(F.struct(F.col("last_week").alias("week"), F.col("team_id").alias("team_id")))
    totals = stats.groupBy("gsis_id", "season").agg(
        latest["team_id"].alias("team_id"),
        *[F.sum(c).alias(c) for c in counts],
        *[(F.sum(F.col(c) * F.col("weeks")) / F.sum("weeks")).alias(c) for c in means],
    )
    return totals.withColumn("fantasy_points", fantasy_points_full(totals))
