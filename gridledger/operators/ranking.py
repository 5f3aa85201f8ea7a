"""Leaderboards, boards and other top-n queries.

Each is ORDER BY + LIMIT, so every task keeps only its n best rows; the rank
is numbered afterwards on the n rows that are left. Missing values sort last
and ties are settled by id.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger.functions.numeric import fantasy_points_or_stored, zero
from gridledger.operators.boxscore import category_totals
from gridledger.operators.clean import pick_column, where, with_rank
from gridledger.operators.dims import players_with_points, with_player


def top_n(df, value, n, tie="gsis_id"):
    """The n best rows with a running ``rank``."""
    order = [F.col(value).desc_nulls_last(), F.col(tie).asc()]
    return with_rank(df.orderBy(*order).limit(n), order)


def top_n_per_group(df, group, value, n, tie="gsis_id", out="rank"):
    """The n best rows of every group; groups are cut to n before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.col(value).desc_nulls_last(), F.col(tie).asc())
    return df.withColumn(out, F.row_number().over(order)).filter(F.col(out) <= n)


def leaders(stats, players, category, season, n=5):
    """Player leaderboard; an unknown category means passing yards."""
    column = pick_column(fv.LEADER_CATEGORIES, category, fv.LEADER_DEFAULT)
    facts = where(stats, season=season).select("gsis_id", zero(F.col(column)).alias("value"))
    joined = with_player(facts, players, columns=("name", "team_id", "headshot_url"))
    return top_n(joined, "value", n).select(
        "rank", "gsis_id", "name", F.col("team_id").alias("team"), "value",
        F.col("headshot_url").alias("image"),
    )


def team_leaders(team_stats, metric="off_total_yards", season=2025, n=5):
    """Team leaderboard; unknown metrics mean total yards."""
    column = pick_column(fv.TEAM_METRICS, metric, fv.TEAM_METRIC_DEFAULT)
    facts = where(team_stats, season=season).select(
        F.col("team_id").alias("team"), F.col(column).alias("value"), "season"
    )
    return top_n(facts, "value", n, tie="team").select("rank", "team", "value", "season")


def _ranked_rows(stats, players, season, column):
    """Rows with the ranked value and the points shown next to it."""
    facts = where(stats, season=season)
    facts = facts.withColumns(
        {"val": F.col(column), "fantasy": fantasy_points_or_stored(facts)}
    ).select("gsis_id", "val", "fantasy")
    return with_player(facts, players)


_RANKING_OUT = ["position", "rank", "gsis_id", "name", "team_id", "val", "fantasy"]


def rankings(stats, players, position=None, metric="fantasy_points", season=2025, n=5):
    """Leaders of one position (or all); metrics other than yardages mean points."""
    column = pick_column(fv.RANKING_METRICS, metric, fv.RANKING_DEFAULT)
    people = where(players, position=position)
    return top_n(_ranked_rows(stats, people, season, column), "val", n).select(*_RANKING_OUT)


def rankings_by_position(stats, players, metric="fantasy_points", season=2025, n=5):
    """The same for every position at once."""
    column = pick_column(fv.RANKING_METRICS, metric, fv.RANKING_DEFAULT)
    rows = _ranked_rows(stats, players, season, column)
    return top_n_per_group(rows, "position", "val", n).select(*_RANKING_OUT)


def draft_board(stats, players, season=2025, n=5):
    """Best n quarterbacks, runners and receivers in one grouped top-n."""
    people = where(players, position=fv.BOARD_POSITIONS)
    return rankings_by_position(stats, people, season=season, n=n)


def draft_suggestions(
    weekly_by_category, players, position, season, n=5, player_key=("gsis_id", "player_id")
):
    """Top season totals of the position's main metric; unknown positions: none.

    All players with rows in that category compete, whatever their position.
    """
    category, metric = pick_column(fv.DRAFT_CATEGORIES, position, (None, None))
    if category is None:
        nothing = F.lit(None).cast("long")
        totals = players.select(
            F.col("gsis_id").alias("player_id"), "name", F.col("team_id").alias("team"),
            nothing.alias("value"),
        ).limit(0)
    else:
        totals = category_totals(weekly_by_category[category], players, metric, season, player_key)
    return top_n(totals, "value", n, tie="player_id").select(
        "rank", "player_id", "name", "team", "value"
    )


def all_draft_suggestions(
    weekly_by_category, players, season, n=5, player_key=("gsis_id", "player_id")
):
    """The suggestion lists of every position, under each other."""
    lists = [
        draft_suggestions(weekly_by_category, players, position, season, n, player_key).select(
            F.lit(position).alias("position"), "*"
        )
        for position in fv.DRAFT_CATEGORIES
    ]
    return reduce(lambda a, b: a.unionByName(b), lists)


def known_players(players, stats, season):
    """All players at skill positions with that season's points: whom texts may name."""
    people = where(players, position=fv.SKILL_POSITIONS)
    return players_with_points(people, stats, season).select(
        "gsis_id", "name", "position", "team_id", "fantasy_points"
    )


def knowledge_base(players, stats, season, n=500):
    """The n best known players with their rank, those without points last."""
    ranked = top_n(known_players(players, stats, season), "fantasy_points", n)
    return ranked.select(
        F.col("rank").alias("kb_rank"), "gsis_id", "name", "position", "team_id", "fantasy_points"
    )


def latest_games(plays, n=5):
    """The n latest distinct games by season, week and teams."""
    order = [F.col("season").desc(), F.col("week").desc(), F.col("home_team"), F.col("away_team")]
    games = plays.select("season", "week", "home_team", "away_team").distinct()
    return games.orderBy(*order).limit(n)
