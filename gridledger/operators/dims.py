"""Dimension tables: semi and anti joins, new members, key resolution."""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger.operators import clean


def _members(df, key):
    """Distinct non-null keys: reduced on the map side before they move."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def semi_by_key(dim, facts, key, facts_key=None):
    """Members of the dimension that occur in the facts."""
    members = _members(facts, facts_key or key).toDF(key)
    return dim.join(members, key, "left_semi")


def anti_by_key(facts, dim, key, dim_key=None):
    """Distinct fact keys the dimension lacks; keys are reduced before the join."""
    known = _members(dim, dim_key or key).toDF(key)
    return _members(facts, key).join(known, key, "left_anti")


def add_missing(dim, facts, fact_key, key="name", id_column=None):
    """The dimension plus a row with position 'Unknown' per new member.

    Rows without a name, or without the id if there is an id column, create none.
    """
    if id_column is not None:
        facts = facts.filter(F.col(id_column).isNotNull())
    fresh = anti_by_key(facts.select(F.col(fact_key).alias(key)), dim, key)
    return dim.unionByName(
        fresh.withColumn("position", F.lit("Unknown")), allowMissingColumns=True
    )


def unique_rows(df, keys):
    """The same rows, failing the job if a key occurs twice.

    A window numbers the rows of a key instead of regrouping whole rows: it
    needs the shuffle by key that the join after it needs anyway.
    """
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    error = F.raise_error(F.concat(F.lit(f"{', '.join(keys)} not unique: "), shown))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1)))
    guard = F.when(F.col("_copy") > 1, error.cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("_copy", number).filter(guard).drop("_copy")


def resolve_dims(weekly, players, teams, player_key, team_key, check_unique=False):
    """Inner joins weekly -> players -> teams; keys are (dimension, fact) pairs.

    Adds ``player_id`` and ``team_id``. Join by name only where names are
    unique: ``check_unique`` makes a repeated name an error instead of a
    fan-out. The join strategy is left to the sizes seen at run time.
    """
    player_dim, player_fact = player_key
    team_dim, team_fact = team_key
    people = players.select(
        F.col(player_dim).alias("_player_key"), F.col("gsis_id").alias("player_id")
    )
    squads = teams.select(F.col(team_dim).alias("_team_key"), "team_id")
    if check_unique:
        people, squads = unique_rows(people, ["_player_key"]), unique_rows(squads, ["_team_key"])
    facts = weekly.withColumns(
        {"_player_key": F.col(player_fact), "_team_key": F.col(team_fact)}
    ).drop("player_id", "team_id")
    return facts.join(people, "_player_key").join(squads, "_team_key").drop(
        "_player_key", "_team_key"
    )


def enrich_roster(stats, roster, key="gsis_id"):
    """Left join of position and name; the roster's name wins, UNK if unknown."""
    name = "full_name" if "full_name" in roster.columns else "name"
    people = roster.select(
        key, F.col("position").alias("position"), F.col(name).alias("_roster_name")
    )
    joined = stats.drop("position").join(people, key, "left")
    known = [F.col("_roster_name")]
    if "player_name" in stats.columns:
        known.append(F.col("player_name"))
    named = joined.withColumn("player_name", F.coalesce(*known)).drop("_roster_name")
    return clean.with_default(named, "position", "UNK")


def with_player(stats, players, season=None, columns=("name", "position", "team_id")):
    """Inner join of stats and players on the id, optionally one season."""
    facts = clean.where(stats, season=season).drop(*columns, "player_name")
    return facts.join(players.select("gsis_id", *columns), "gsis_id")


def players_with_points(players, stats, season):
    """All players with that season's points, NULL where there are none."""
    facts = clean.where(stats, season=season).select("gsis_id", "fantasy_points")
    return players.join(facts, "gsis_id", "left")


def rebuild_directory(directory, stats):
    """Directory reduced to players with stats, renamed, blanks as ``N/A``."""
    active = semi_by_key(directory, stats, "gsis_id")
    return clean.fill_na_text(
        clean.rename_present(active, fv.DIRECTORY_RENAMES), fv.DIRECTORY_COLUMNS
    )


def distinct_sorted(df, columns):
    return df.select(*columns).distinct().orderBy(*columns)


def list_players(players, limit=50, key="gsis_id"):
    return players.orderBy(key).limit(limit)


def by_id(df, value, key="gsis_id"):
    return df.filter(F.col(key) == value).limit(1)


def search_players(players, query, limit=10):
    """Case-insensitive substring search; ``%`` and ``_`` act as wildcards."""
    # A backslash only escapes %, _ and itself; before anything else it is dropped.
    pattern = re.sub(r"(\\[%_\\])|\\(?!$)", lambda m: m.group(1) or "", query)
    return (
        players.filter(F.col("name").ilike(f"%{pattern}%"))
        .orderBy("name", "gsis_id")
        .limit(limit)
    )
