"""Weekly jobs: full rebuild, update of one season, box-score season tables.

All jobs work on a folder of stored tables: they stage the parts that they change,
check them while they are written, and then publish all of them at once
(``tables.publish``). A job that fails in between leaves everything as it was.
"""

from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger import schemas
from gridledger.operators import boxscore, clean, dims, partials, projection, quality, teams, usage
from gridledger.sources import tables
from gridledger.sources.plays import players_from_roster


#: What makes a part of a stored table: bytes written follow the seasons (weeks) touched.
SEASON_PARTS, WEEK_PARTS = ("season",), ("season", "week")


def rebuild_weekly(plays, history=None, with_points=True, extra=()):
    """The weekly table from plays, after any pre-aggregated history.

    ``extra`` names further columns of the weekly lines to keep after the 24.
    """
    lines = usage.player_weekly_usage(plays, with_points)
    schema = schemas.weekly_stats(extra)
    fresh = clean.align(lines, schema)
    if history is None:
        return fresh
    old = clean.align(clean.rename_present(history, fv.HISTORY_RENAMES), schema)
    return clean.union_seasons([old, fresh])


def season_rows(plays, roster):
    """The season table's rows for the seasons of the plays."""
    weekly = usage.player_weekly_usage(plays)
    return clean.align(usage.season_table(weekly, roster), schemas.SEASON_STATS)


def rebuild_all(spark, root, roster, history, plays):
    """Rebuild players, weekly, season and team-defence tables from scratch.

    The weekly table is staged first, and the season table rolled up from the
    staged rows. Fumbles are kept beside the weekly columns for it.
    """
    weekly_rows = rebuild_weekly(plays, history, extra=["fumbles_lost"])
    staged, _ = tables.stage(weekly_rows, root, "weekly_stats", SEASON_PARTS)
    frames = {
        "players": (players_from_roster(roster), ()),
        "team_season_stats": (clean.align(teams.team_season(plays), schemas.TEAM_SEASON_STATS), SEASON_PARTS),
    }
    if staged:
        weekly_rows = spark.read.schema(weekly_rows.schema).parquet(*[path for _, _, path, _ in staged])
    seasons = clean.align(usage.season_table(weekly_rows, roster), schemas.SEASON_STATS)
    frames["season_stats"] = (seasons, SEASON_PARTS)
    for name, (df, by) in frames.items():
        staged += tables.stage(df, root, name, by)[0]
    tables.publish(spark, root, tables.replaced(spark, root, staged))


def stage_season(spark, root, plays, roster, season):
    """One season's rows, staged in place of what is stored of it, also by none; the
    checks of what was written. Other seasons are neither read nor written. A season kept
    by its weeks (``stage_weeks``) is refused, as its sums would no longer be its rows'."""
    if tables.part_of((season,)) in tables.stored_parts(spark, root, "season_sums"):
        raise ValueError(f"season {season} is kept by its weeks; load them instead")
    fresh = season_rows(plays.filter(F.col("season") == season), roster)
    return tables.stage(
        fresh, root, "season_stats", SEASON_PARTS, scope=[(season,)], metrics=quality.season_metrics(season)
    )


def update_season(spark, root, plays, roster, season):
    """Rows of one season swapped into the season table; other seasons stay."""
    staged, _ = stage_season(spark, root, plays, roster, season)
    tables.publish(spark, root, staged)


#: What weekly lines are kept as where seasons are brought up to date by their weeks.
WEEK_LINES = schemas.weekly_stats(["fumbles_lost"])


def stage_weeks(spark, root, lines, roster, weeks=(), all_weeks=False):
    """Weekly lines staged in place of what is stored of their weeks; the seasons concerned
    are brought up to date from these weeks and their stored sums (``partials``).

    ``lines`` holds whole weeks, a player once per week and team. ``weeks`` are the
    (season, week) pairs that were reloaded: those without a line are withdrawn. Changes
    are taken against what is published, so weeks staged again after a failure, or for no
    reason, change nothing. Jobs on one season must come one after another, and a season
    that was stored without sums (``update_season``) is refused unless ``all_weeks`` says
    that the lines are all of it.

    Returns the rows for ``tables.publish`` (lines, sums, season rows, the projection's
    cross products) and the issues seen in the season rows. Fails if a line repeats a week.
    """
    staged, _ = tables.stage(clean.align(lines, WEEK_LINES), root, "weekly_lines", WEEK_PARTS, scope=weeks)
    if not staged:
        return [], {}
    parts = {part for _, part, _, _ in staged}
    # One entry per season touched; lines without a season belong to none.
    named = {part.split("=", 1)[1].split("-")[0] for part in parts}
    seasons = sorted(int(season) for season in named if season != "null")
    season_parts = {tables.part_of((season,)) for season in seasons}
    known = tables.stored_parts(spark, root, "season_sums")
    bare = sorted(season_parts & (tables.stored_parts(spark, root, "season_stats") - known))
    if bare and not all_weeks:
        raise ValueError(f"stored without sums, load all weeks of {', '.join(bare)} first")
    scope = [(season,) for season in seasons]
    change = partials.week_changes(
        tables.read_stored(spark, root, "weekly_lines", WEEK_LINES, parts),
        tables.read_staged(spark, staged, WEEK_LINES),
    )
    stored = tables.read_stored(spark, root, "season_sums", change.schema, season_parts)
    sums, _ = tables.stage(partials.merged(stored, change), root, "season_sums", SEASON_PARTS, scope=scope)
    rows = partials.season_rows(tables.read_staged(spark, sums, change.schema), roster)
    rows = clean.align(rows, schemas.SEASON_STATS)
    metrics = {"season_rows_without_key": quality.season_metrics(0)["season_rows_without_key"]}
    fresh, seen = tables.stage(rows, root, "season_stats", SEASON_PARTS, scope=scope, metrics=metrics)
    products = projection.cross_products(tables.read_staged(spark, fresh, schemas.SEASON_STATS))
    fitted, _ = tables.stage(products, root, "projection_products", SEASON_PARTS, scope=scope)
    return staged + sums + fresh + fitted, seen


def load_weeks(spark, root, lines, roster, weeks=(), all_weeks=False):
    """Weeks staged by ``stage_weeks``, checked and published at once."""
    staged, issues = stage_weeks(spark, root, lines, roster, weeks, all_weeks)
    quality.gate_observed(issues)
    tables.publish(spark, root, staged)


def stored_projection(spark, root):
    """The projection fitted to all stored seasons, from one row of sums per season."""
    return projection.fit_products(tables.read_current(spark, root, "projection_products"))


def box_season_tables(passing, rushing, receiving, players, squads, player_key, team_key):
    """The three season tables at (player, season) and the team totals."""

    def resolved(weekly):
        return dims.resolve_dims(weekly, players, squads, player_key, team_key)

    by = boxscore.PLAYER_SEASON
    return {
        "passing": boxscore.box_passing(resolved(passing), by),
        "rushing": boxscore.box_rushing(resolved(rushing), by),
        "receiving": boxscore.box_receiving(resolved(receiving), by),
        "team": boxscore.team_totals(passing, rushing, squads),
    }


#: Keys, the columns the original job refreshes, and what makes a stored part.
UPSERTS = {
    "passing": (["player_id", "season"], fv.PASSING_UPDATES, SEASON_PARTS),
    "rushing": (["player_id", "season"], fv.RUSHING_UPDATES, SEASON_PARTS),
    "receiving": (["player_id", "season"], fv.RECEIVING_UPDATES, SEASON_PARTS),
    "team": (["team_id", "season"], fv.TEAM_UPDATES, SEASON_PARTS),
    "player_week": (["player_id", "team_id", "season", "week"], fv.PLAYER_WEEK_UPDATES, WEEK_PARTS),
}


def stage_merged(spark, root, fresh, refresh_all=True, metrics=None):
    """Fresh tables merged into the stored ones, part by part: seasons (weeks) that
    they have no row for are neither read nor written. Returns the rows for
    ``tables.publish`` and the ``metrics`` asked for by table.

    The fresh tables are grouped by their keys, so nothing is checked twice.
    ``refresh_all=False`` only refreshes the columns the original job does and
    leaves the others as they were stored.
    """
    staged, seen = [], {}
    for name, df in fresh.items():
        keys, listed, by = UPSERTS[name]
        rows, found = tables.merge_parts(
            spark, root, name, df, keys, by, None if refresh_all else listed, check=False,
            metrics=(metrics or {}).get(name),
        )
        staged += rows
        seen |= found
    return staged, seen


def upsert_season_tables(spark, root, fresh, refresh_all=True):
    """Merge the fresh tables and publish them together."""
    staged, _ = stage_merged(spark, root, fresh, refresh_all)
    tables.publish(spark, root, staged)


def weekly_update(spark, root, plays, roster, season, fresh, players, weeks=None):
    """One week's job: season rows from plays, season tables from box scores.

    Everything is staged and checked by the same execution, then published at once.
    Nothing is published if a check fails. What is stored was checked when it was
    written; only the players are looked at for themselves.

    With ``weeks``, the season's weeks that came or were corrected, only their plays are
    looked at, and the season rows follow from stored sums (``stage_weeks``).
    """
    checks = {"rushing": quality.negative_yards_metric(), "passing": quality.stale_passers_metric()}
    staged, issues = stage_merged(spark, root, fresh, metrics=checks)
    if weeks is None:
        rows, seen = stage_season(spark, root, plays, roster, season)
        seen = quality.season_failures(seen)
    else:
        come = plays.filter((F.col("season") == season) & F.col("week").isin(list(weeks)))
        lines = usage.player_weekly_usage(come)
        rows, seen = stage_weeks(spark, root, lines, roster, [(season, week) for week in weeks])
    nameless = quality.null_names(players).first()["issues"]
    quality.gate_observed(issues | {"null_names": nameless} | seen)
    tables.publish(spark, root, staged + rows)
