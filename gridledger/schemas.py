"""Declared schemas; readers never infer types."""

from pyspark.sql import types as T

_LONG, _INT, _DOUBLE, _STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _struct(**fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


PLAYS = _struct(
    game_id=_STRING,
    home_team=_STRING,
    away_team=_STRING,
    season=_INT,
    week=_INT,
    posteam=_STRING,
    defteam=_STRING,
    play_type=_STRING,
    passer_player_id=_STRING,
    passer_player_name=_STRING,
    rusher_player_id=_STRING,
    rusher_player_name=_STRING,
    receiver_player_id=_STRING,
    receiver_player_name=_STRING,
    passing_yards=_DOUBLE,
    rushing_yards=_DOUBLE,
    receiving_yards=_DOUBLE,
    yards_gained=_DOUBLE,
    air_yards=_DOUBLE,
    yards_after_catch=_DOUBLE,
    epa=_DOUBLE,
    cpoe=_DOUBLE,
    pass_touchdown=_DOUBLE,
    rush_touchdown=_DOUBLE,
    touchdown=_DOUBLE,
    interception=_DOUBLE,
    fumble_lost=_DOUBLE,
    sack=_DOUBLE,
    complete_pass=_DOUBLE,
    pass_attempt=_DOUBLE,
    rush_attempt=_DOUBLE,
)

ROSTER = _struct(
    gsis_id=_STRING,
    full_name=_STRING,
    position=_STRING,
    team=_STRING,
    headshot_url=_STRING,
    espn_id=_STRING,
    sleeper_id=_STRING,
    yahoo_id=_STRING,
)

PLAYERS = _struct(
    gsis_id=_STRING,
    name=_STRING,
    position=_STRING,
    team_id=_STRING,
    headshot_url=_STRING,
    espn_id=_STRING,
    sleeper_id=_STRING,
    yahoo_id=_STRING,
)

WEEKLY_STATS = _struct(
    gsis_id=_STRING,
    season=_INT,
    week=_INT,
    team_id=_STRING,
    completions=_LONG,
    attempts=_LONG,
    passing_yards=_LONG,
    passing_tds=_LONG,
    interceptions=_LONG,
    sacks=_LONG,
    passing_epa=_DOUBLE,
    carries=_LONG,
    rushing_yards=_LONG,
    rushing_tds=_LONG,
    rushing_epa=_DOUBLE,
    targets=_LONG,
    receptions=_LONG,
    receiving_yards=_LONG,
    receiving_tds=_LONG,
    receiving_epa=_DOUBLE,
    wopr=_DOUBLE,
    target_share=_DOUBLE,
    air_yards_share=_DOUBLE,
    fantasy_points=_DOUBLE,
)

def weekly_stats(extra=()):
    """The weekly columns and further whole-number ones after them."""
    return T.StructType(WEEKLY_STATS.fields + [T.StructField(c, _LONG, True) for c in extra])


SEASON_STATS = _struct(
    gsis_id=_STRING,
    season=_INT,
    team_id=_STRING,
    player_name=_STRING,
    position=_STRING,
    passing_yards=_LONG,
    passing_tds=_LONG,
    interceptions=_LONG,
    sacks_taken=_LONG,
    passing_epa=_DOUBLE,
    rushing_yards=_LONG,
    rushing_tds=_LONG,
    fumbles_lost=_LONG,
    rushing_epa=_DOUBLE,
    receiving_yards=_LONG,
    receiving_tds=_LONG,
    receptions=_LONG,
    receiving_epa=_DOUBLE,
    wopr=_DOUBLE,
    target_share=_DOUBLE,
    fantasy_points=_DOUBLE,
    last_week=_INT,
    weeks=_LONG,
)

TEAM_SEASON_STATS = _struct(
    team_id=_STRING,
    season=_INT,
    def_sacks_made=_LONG,
    def_interceptions=_LONG,
    def_fumbles_recovered=_LONG,
    off_total_yards=_LONG,
    off_total_tds=_LONG,
    off_sacks_allowed=_LONG,
    off_fumbles_lost=_LONG,
    off_interceptions=_LONG,
)

_BOX_HEAD = dict(
    player_name=_STRING,
    pfr_player_id=_STRING,
    game_date=T.DateType(),
    team=_STRING,
    at_or_vs=_STRING,
    opponent=_STRING,
    game_outcome=_STRING,
)
_BOX_TAIL = dict(season=_INT, week=_INT)

BOX_SCORES = {
    "passing": _struct(
        **_BOX_HEAD,
        completions=_INT,
        attempts=_INT,
        passing_yards=_INT,
        passing_tds=_INT,
        interceptions=_INT,
        passer_rating=_DOUBLE,
        **_BOX_TAIL,
    ),
    "rushing": _struct(
        **_BOX_HEAD, carries=_INT, rushing_yards=_INT, rushing_tds=_INT, **_BOX_TAIL
    ),
    "receiving": _struct(
        **_BOX_HEAD, receptions=_INT, receiving_yards=_INT, receiving_tds=_INT, **_BOX_TAIL
    ),
}

ETL_STATE = _struct(
    source=_STRING, last_season=_INT, last_week=_INT, updated_at=T.TimestampType()
)
