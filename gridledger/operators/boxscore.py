"""Season totals from weekly box scores."""

from functools import reduce

from pyspark.sql import functions as F

from gridledger.functions.numeric import column_or, round_ratio, sum_or_zero
from gridledger.operators.clean import union_seasons, where

PLAYER_TEAM_SEASON = ["player_id", "team_id", "season"]
PLAYER_SEASON = ["player_id", "season"]


def _longest(df, name):
    return column_or(df, name, dtype="int")


def _exact(df, name):
    """Ratings of up to four decimals, added up exactly."""
    return column_or(df, name, dtype="double").cast("decimal(18,4)")


def _mean2(name):
    """The mean of summed ratings with two decimals."""
    lines = F.col(f"_n_{name}")
    mean = F.col(f"_sum_{name}").cast("decimal(28,4)") / lines.cast("decimal(10,0)")
    return F.round(F.when(lines > 0, mean).cast("decimal(22,8)"), 2).cast("double").alias(name)


def _latest_team(resolved):
    """(aggregates, the latest week's team from them); of several the greatest.

    Two ints are compared as one long, which a hash aggregate can keep; with a struct all
    rows would be sorted. As in a struct, a missing week or team is least.
    """
    kinds = [resolved.schema[c].dataType.typeName() for c in ("week", "team_id")]
    if kinds != ["integer", "integer"]:
        return {"_latest": F.struct("week", "team_id")}, F.col("_latest")["team_id"]
    place = F.col("team_id").cast("long") + 2**31
    both = F.shiftleft(F.col("week").cast("long"), 32) + place
    found = F.when(
        F.shiftright("_latest", 32) == F.col("_week"),
        F.pmod(F.col("_latest"), F.lit(2**32)) - 2**31,
    )
    team = F.when(F.col("_week").isNull(), F.col("_team")).otherwise(found.cast("int"))
    return {"_latest": both, "_week": F.col("week"), "_team": F.col("team_id")}, team


def _season(resolved, by, totals, longest=(), means=()):
    """Group by the keys; without the team as key, keep the latest week's team. A total
    stays NULL when no week has a value.

    Weeks are counted as bits of a number per 64 weeks, so that lines of a season are added
    up before they move; a distinct count would move every week of every player.
    """
    latest, team = ({}, None) if "team_id" in by else _latest_team(resolved)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("week", F.lit(64)).cast("int"))
    weeks = F.bit_or(bit)
    sums = {c: column_or(resolved, c, dtype="long").cast("long") for c in totals}
    sums |= {f"_sum_{c}": _exact(resolved, c) for c in means}
    largest = {c: _longest(resolved, c) for c in longest} | latest
    counts = {f"_n_{c}": _exact(resolved, c) for c in means}
    parts = resolved.groupBy(*by, F.shiftright("week", 6).alias("_block")).agg(
        F.bit_count(weeks).alias("_games"),
        *[F.sum(value).alias(c) for c, value in sums.items()],
        *[F.count(value).alias(c) for c, value in counts.items()],
        *[F.max(value).alias(c) for c, value in largest.items()],
    )
    whole = parts.groupBy(*by).agg(
        F.coalesce(F.sum("_games"), F.lit(0)).cast("long").alias("games_played"),
        *[F.sum(c).alias(c) for c in [*sums, *counts]],
        *[F.max(c).alias(c) for c in largest],
    )
    return whole.select(
        *by, "games_played", *totals, *[_mean2(c) for c in means], *longest,
        *([] if team is None else [team.alias("team_id")]),
    )


def box_passing(resolved, by=PLAYER_TEAM_SEASON):
    """Passing season totals; the input comes from ``resolve_dims``.

    ``by=PLAYER_SEASON`` gives one row per player and season, as an upsert on
    that key needs.
    """
    totals = [
        "completions", "attempts", "passing_yards", "passing_tds", "interceptions",
        "sacks", "sack_yards", "first_downs", "fourth_qtr_comebacks", "game_winning_drives",
    ]
    grouped = _season(
        resolved, by, totals, longest=["longest_pass"], means=["passer_rating", "qbr"]
    )
    pct = round_ratio(F.col("completions"), F.col("attempts"), 4)
    return grouped.withColumn("completion_pct", pct)


def box_rushing(resolved, by=PLAYER_TEAM_SEASON):
    totals = ["carries", "rushing_yards", "rushing_tds"]
    grouped = _season(resolved, by, totals, longest=["longest_rush"])
    yards, games = F.col("rushing_yards"), F.col("games_played")
    return grouped.withColumns(
        {
            "yards_per_carry": round_ratio(yards, F.col("carries"), 2),
            "rushing_yards_per_game": round_ratio(yards, games, 1),
        }
    )


def box_receiving(resolved, by=PLAYER_TEAM_SEASON):
    totals = ["targets", "receptions", "receiving_yards", "receiving_tds"]
    grouped = _season(resolved, by, totals, longest=["longest_reception"])
    yards, games = F.col("receiving_yards"), F.col("games_played")
    return grouped.withColumns(
        {
            "yards_per_reception": round_ratio(yards, F.col("receptions"), 2),
            "receptions_per_game": round_ratio(F.col("receptions"), games, 1),
            "receiving_yards_per_game": round_ratio(yards, games, 1),
        }
    )


def team_totals(passing, rushing, teams):
    """Team offence and yards allowed by season.

    Each weekly row counts once for its team and once for its opponent; one
    grouping replaces four grouped tables and their joins. Teams without
    passing rows of their own are left out.
    """
    pass_columns = ["passing_yards", "passing_tds", "interceptions", "sacks"]
    rush_columns = ["rushing_yards", "rushing_tds"]
    weekly = union_seasons(
        [
            passing.select("team", "opponent", "season", "week", *pass_columns,
                           F.lit("pass").alias("kind")),
            rushing.select("team", "opponent", "season", "week", *rush_columns,
                           F.lit("rush").alias("kind")),
        ]
    )
    sides = F.array(
        F.struct(F.lit("off").alias("side"), F.col("team").alias("name")),
        F.struct(F.lit("def").alias("side"), F.col("opponent").alias("name")),
    )
    lines = weekly.select("*", F.inline(sides)).filter(F.col("name").isNotNull())
    off, dfn = F.col("side") == "off", F.col("side") == "def"

    def total(condition, column, alias):
        return F.sum(F.when(condition, F.col(column))).cast("long").alias(alias)

    by_name = lines.groupBy("name", "season").agg(
        F.countDistinct(F.when(off & (F.col("kind") == "pass"), F.col("week")))
        .cast("long")
        .alias("off_games_played"),
        total(off, "passing_yards", "off_passing_yards"),
        total(off, "rushing_yards", "off_rushing_yards"),
        total(off, "passing_tds", "off_passing_tds"),
        total(off, "rushing_tds", "off_rushing_tds"),
        total(off, "interceptions", "off_interceptions_thrown"),
        total(dfn, "passing_yards", "def_passing_yards_allowed"),
        total(dfn, "rushing_yards", "def_rushing_yards_allowed"),
        total(dfn, "passing_tds", "def_passing_tds_allowed"),
        total(dfn, "rushing_tds", "def_rushing_tds_allowed"),
        total(dfn, "sacks", "def_sacks_made"),
    )

    def both(a, b):
        return F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0))

    played = by_name.filter(F.col("off_games_played") > 0).withColumns(
        {
            "off_total_yards": both("off_passing_yards", "off_rushing_yards"),
            "def_total_yards_allowed": both(
                "def_passing_yards_allowed", "def_rushing_yards_allowed"
            ),
        }
    )
    return played.join(teams.select("name", "team_id"), "name").drop("name")


def player_weekly_rollup(passing, season=None, week=None, rushing=None, receiving=None):
    """Weekly rows whose totals come from passing only.

    With the other two categories given, ``all_touchdowns`` and ``all_yards``
    add the player's totals over all three. Every table is read once: the three
    are stacked and grouped, and keys without a passing row are left out, so
    there is one row per (player, team, season, week).
    """
    keys = ["player_id", "team_id", "season", "week"]
    chosen = where(passing, season=season, week=week)
    if rushing is None or receiving is None:
        return chosen.select(
            *keys, "passing_yards", "passing_tds", "interceptions",
            F.col("passing_tds").alias("total_touchdowns"),
            F.col("passing_yards").alias("total_yards"),
        )
    parts = [
        where(df, season=season, week=week).select(
            *keys, F.lit(kind).alias("kind"), F.col(f"{kind}_yards").alias("yards"),
            F.col(f"{kind}_tds").alias("tds"),
            (F.col("interceptions") if kind == "passing" else F.lit(None)).cast("long").alias("ints"),
        )
        for kind, df in (("passing", passing), ("rushing", rushing), ("receiving", receiving))
    ]
    threw = F.col("kind") == "passing"
    grouped = reduce(lambda a, b: a.unionByName(b), parts).groupBy(*keys).agg(
        F.count_if(threw).alias("rows"),
        F.sum(F.when(threw, F.col("yards"))).alias("passing_yards"),
        F.sum(F.when(threw, F.col("tds"))).alias("passing_tds"),
        F.sum("ints").alias("interceptions"),
        sum_or_zero("tds").alias("all_touchdowns"),
        sum_or_zero("yards").alias("all_yards"),
    )
    return grouped.filter("rows > 0").select(
        *keys, "passing_yards", "passing_tds", "interceptions",
        F.col("passing_tds").alias("total_touchdowns"),
        F.col("passing_yards").alias("total_yards"), "all_touchdowns", "all_yards",
    )


def union_padded(passing, rushing, receiving, keys):
    """The three weekly tables under each other, foreign yardage as 0."""
    metrics = ["passing_yards", "rushing_yards", "receiving_yards"]
    parts = [
        df.select(
            *keys,
            *[(F.col(m) if m == own else F.lit(0)).cast("long").alias(m) for m in metrics],
        )
        for own, df in zip(metrics, (passing, rushing, receiving))
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def three_way_totals(passing, rushing, receiving, season, key="player_id"):
    """Yardage totals over the three tables by player.

    ``stat_lines`` counts rows, so a game with carries and catches counts
    twice; ``games`` counts distinct weeks.
    """
    stacked = union_padded(
        *[where(df, season=season) for df in (passing, rushing, receiving)], [key, "week"]
    )
    return stacked.groupBy(key).agg(
        sum_or_zero("passing_yards").alias("passing_yards"),
        sum_or_zero("rushing_yards").alias("rushing_yards"),
        sum_or_zero("receiving_yards").alias("receiving_yards"),
        F.count("*").alias("stat_lines"),
        F.countDistinct("week").cast("long").alias("games"),
    )


def category_totals(weekly, players, metric, season, player_key=("gsis_id", "player_id")):
    """Season total of one metric by player."""
    dim_key, fact_key = player_key
    facts = (
        where(weekly, season=season)
        .groupBy(F.col(fact_key).alias("_key"))
        .agg(F.sum(metric).cast("long").alias("value"))
    )
    people = players.select(
        F.col(dim_key).alias("_key"), F.col("gsis_id").alias("player_id"), "name",
        F.col("team_id").alias("team"),
    )
    return facts.join(people, "_key").drop("_key")
