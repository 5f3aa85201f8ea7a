"""SQL equivalents of the registered queries, for a second engine to check.

Views are shared as WITH lists; the definitions mirror ``views.py``. Patterns, words
and sentences are written out here once more, so that a wrong one in the library
does not go wrong on both sides alike.
"""

# Fixed values, as the library states them in its own words.
TEMPLATES = [
    "Trade {x} for {y}",
    "{x} vs {y}",
    "Top QB this year",
    "Who is {x}?",
    "How many touchdowns did {x} score in 1998?",
    "{x}",
    "compare {x} and {y}",
    "did {x_last} rush better last year",
    "How many points did {x_first} score",
    "tell me about the weather",
    "Which receiver is best, {x} or {y}?",
    "trade {x_last} for {y_first}",
    "{x_last} , {y} or {x}",
    "how did {y} throw two years ago",
    "show me {x} running in 2000",
]
TRADE = "trade\\s+(.+?)\\s+for\\s+(.+)"
LIST_WORDS = ("top", "best", "draft", "leader")
COMPARE_MARKERS = (" vs ", " or ", "compare ", " better")
COMPARE_SPLIT = "\\s+(?:vs\\.?|or|and|,)\\s+"
POSITION_WORDS = (
    ("QB", ("qb", "quarterback")), ("RB", ("rb", "running")), ("WR", ("wr", "receiver")),
    ("TE", ("te", "tight")),
)
INTENTS = (
    ("ranking", "who (should|do) i draft|who (are|is) (the )?best|top (\\d+)?|leaders|rank"
                "|which .* (are|is) best"),
    ("compare", "compare| vs | or |better|draft .* (or|vs)"),
    ("search", "who is|tell me about|show me|stats for"),
)
METRICS = (
    ("deep ball", "passing_yards"), ("passing", "passing_yards"), ("rushing", "rushing_yards"),
    ("receiving", "receiving_yards"), ("fantasy", "fantasy_points"), ("scoring", "touchdowns"),
)
ANSWER_INTENTS = (
    ("touchdowns", ("touchdown", " td")), ("rushing", ("rush", "run")),
    ("passing", ("pass", "throw")), ("receiving", ("receiv", "catch")),
    ("points", ("point", "score")),
)
WEEKLY_NUMBERS = (
    "completions, attempts, passing_yards, passing_tds, interceptions, sacks, carries, "
    "rushing_yards, rushing_tds, targets, receptions, receiving_yards, receiving_tds, "
    "fantasy_points"
)
FEATURES = (
    "passing_yards", "passing_tds", "rushing_yards", "rushing_tds", "receiving_yards", "receptions",
)

PLAYERS = """players AS (
  SELECT s_suppkey AS gsis_id, p_name AS name,
         CASE p_type WHEN 'ECONOMY' THEN 'QB' WHEN 'SMALL' THEN 'RB' WHEN 'STANDARD' THEN 'RB'
                     WHEN 'PROMO' THEN 'TE' ELSE 'WR' END AS position,
         s_nationkey AS team_id,
         'headshots/' || CAST(s_suppkey AS VARCHAR) AS headshot_url
  FROM supplier JOIN part ON p_partkey = s_suppkey)"""

MESSY = """messy AS (
  SELECT gsis_id, CASE WHEN gsis_id % 13 <> 4 THEN name END AS name,
    CASE WHEN gsis_id % 7 <> 3 THEN position END AS position, team_id, headshot_url
  FROM players)"""

TEAMS = "teams AS (SELECT n_nationkey AS team_id, n_name AS name FROM nation)"

PLAYS = """raw AS (
  SELECT l.*, s.s_nationkey AS posteam, c.c_nationkey AS defteam,
         CAST(trunc(l_quantity) AS INT) AS yards,
         l_returnflag = 'A' AS target, l_returnflag = 'R' AS run,
         l_returnflag = 'A' AND l_linestatus = 'F' AS complete,
         l_returnflag = 'N' AND l_linenumber <= 3 AS sacked
  FROM lineitem l
  LEFT JOIN supplier s ON s_suppkey = l_suppkey
  LEFT JOIN orders o ON o_orderkey = l_orderkey
  LEFT JOIN customer c ON c_custkey = o_custkey),
plays AS (
  SELECT CAST(year(l_shipdate) AS INT) AS season,
         CAST((dayofyear(l_shipdate) - 1) // 7 + 1 AS INT) AS week,
         posteam, defteam,
         CASE WHEN run THEN 'run' ELSE 'pass' END AS play_type,
         CASE WHEN NOT run THEN l_suppkey END AS passer_player_id,
         CASE WHEN run THEN l_suppkey END AS rusher_player_id,
         CASE WHEN target THEN (l_suppkey + l_partkey) % (SELECT count(*) FROM supplier) END
           AS receiver_player_id,
         CASE WHEN complete THEN yards END AS passing_yards,
         CASE WHEN run THEN yards - 5 END AS rushing_yards,
         CASE WHEN complete THEN yards END AS receiving_yards,
         CASE WHEN complete THEN yards WHEN run THEN yards - 5 ELSE 0 END AS yards_gained,
         CASE WHEN target THEN 3 * l_linenumber END AS air_yards,
         CASE WHEN complete THEN yards % 7 END AS yards_after_catch,
         CASE WHEN l_tax <> 0 THEN CAST(CAST(l_discount AS DECIMAL(5,2)) - 0.05 AS DOUBLE) END AS epa,
         CASE WHEN l_discount <> 0 THEN CAST(CAST(l_tax AS DECIMAL(5,2)) - 0.04 AS DOUBLE) END AS cpoe,
         CAST(complete AND l_linenumber = 1 AS INT) AS pass_touchdown,
         CAST(run AND l_linenumber = 1 AS INT) AS rush_touchdown,
         CAST((complete OR run) AND l_linenumber = 1 AS INT) AS touchdown,
         CAST(target AND l_linestatus = 'O' AND l_linenumber = 2 AS INT) AS interception,
         CAST(run AND l_linenumber = 7 AS INT) AS fumble_lost,
         CAST(sacked AS INT) AS sack,
         CAST(complete AS INT) AS complete_pass,
         CAST(NOT run AND NOT sacked AS INT) AS pass_attempt,
         CAST(run AS INT) AS rush_attempt
  FROM raw)"""


def _points(prefix="", fumbles=True):
    lost = f" - 200*{prefix}fumbles_lost" if fumbles else ""
    p = prefix
    return (
        f"CAST(4*{p}passing_yards + 400*{p}passing_tds - 200*{p}interceptions"
        f" + 10*{p}rushing_yards + 600*{p}rushing_tds + 10*{p}receiving_yards"
        f" + 600*{p}receiving_tds + 100*{p}receptions{lost} AS DOUBLE) / 100"
    )


def _sum(expression, alias):
    return f"CAST(coalesce(sum({expression}), 0) AS BIGINT) AS {alias}"




def _role_merge(name, keys, extra_week=False):
    """The three grouped tables merged by full outer joins, the textbook way."""
    id_list = ", ".join(keys)
    select_keys = ", ".join(
        f"coalesce(p.{k}, r.{k}, c.{k}) AS {k}" for k in ["gsis_id", *keys]
    )
    source = {"team_id": "posteam AS team_id"}
    key_columns = ", ".join(source.get(k, k) for k in keys)
    group = ", ".join(["1", *[str(i + 2) for i in range(len(keys))]])
    not_null = " AND ".join(f"{'posteam' if k == 'team_id' else k} IS NOT NULL" for k in keys)
    last = ", max(week) AS last_week" if extra_week else ""
    using = ", ".join(["gsis_id", *keys])
    week = ", greatest(p.last_week, r.last_week, c.last_week) AS last_week" if extra_week else ""
    on_pr = " AND ".join(f"p.{k} = r.{k}" for k in ["gsis_id", *keys])
    on_c = " AND ".join(f"coalesce(p.{k}, r.{k}) = c.{k}" for k in ["gsis_id", *keys])
    return f"""{name}_p AS (
  SELECT passer_player_id AS gsis_id, {key_columns}, {_sum('passing_yards', 'passing_yards')},
    {_sum('pass_touchdown', 'passing_tds')}, {_sum('interception', 'interceptions')},
    {_sum('sack', 'sacks_taken')}{last}
  FROM plays WHERE passer_player_id IS NOT NULL AND {not_null} GROUP BY {group}),
{name}_r AS (
  SELECT rusher_player_id AS gsis_id, {key_columns}, {_sum('rushing_yards', 'rushing_yards')},
    {_sum('rush_touchdown', 'rushing_tds')}, {_sum('fumble_lost', 'fumbles_lost')}{last}
  FROM plays WHERE rusher_player_id IS NOT NULL AND {not_null} GROUP BY {group}),
{name}_c AS (
  SELECT receiver_player_id AS gsis_id, {key_columns}, {_sum('receiving_yards', 'receiving_yards')},
    {_sum('pass_touchdown', 'receiving_tds')}, {_sum('complete_pass', 'receptions')}{last}
  FROM plays WHERE receiver_player_id IS NOT NULL AND {not_null} GROUP BY {group}),
{name}_m AS (
  SELECT {select_keys},
    coalesce(passing_yards, 0) AS passing_yards, coalesce(passing_tds, 0) AS passing_tds,
    coalesce(interceptions, 0) AS interceptions, coalesce(sacks_taken, 0) AS sacks_taken,
    coalesce(rushing_yards, 0) AS rushing_yards, coalesce(rushing_tds, 0) AS rushing_tds,
    coalesce(fumbles_lost, 0) AS fumbles_lost, coalesce(receiving_yards, 0) AS receiving_yards,
    coalesce(receiving_tds, 0) AS receiving_tds, coalesce(receptions, 0) AS receptions{week}
  FROM {name}_p p FULL JOIN {name}_r r ON {on_pr} FULL JOIN {name}_c c ON {on_c}),
{name} AS (
  SELECT *, {_points()} AS fantasy_points FROM {name}_m WHERE {_points()} <> 0)"""


TEAM_LINES = _role_merge("team_lines", ["season", "team_id"], extra_week=True)
STATS = _role_merge("stats", ["season"])

WEEKLY = f"""team_week AS (
  SELECT posteam AS team_id, season, week, {_sum('air_yards', 'team_air_yards')},
         count(*) FILTER (play_type = 'pass') AS team_targets
  FROM plays WHERE posteam IS NOT NULL GROUP BY 1, 2, 3),
wp AS (
  SELECT passer_player_id AS gsis_id, season, week, posteam AS team_id,
    {_sum('complete_pass', 'completions')}, {_sum('pass_attempt', 'attempts')},
    {_sum('passing_yards', 'passing_yards')}, {_sum('pass_touchdown', 'passing_tds')},
    {_sum('interception', 'interceptions')}, {_sum('sack', 'sacks')},
    {_sum('air_yards', 'passing_air_yards')}, avg(epa) AS passing_epa, avg(cpoe) AS passing_cpoe
  FROM plays WHERE passer_player_id IS NOT NULL GROUP BY 1, 2, 3, 4),
wr AS (
  SELECT rusher_player_id AS gsis_id, season, week, posteam AS team_id,
    {_sum('rush_attempt', 'carries')}, {_sum('rushing_yards', 'rushing_yards')},
    {_sum('rush_touchdown', 'rushing_tds')}, {_sum('fumble_lost', 'fumbles_lost')},
    avg(epa) AS rushing_epa
  FROM plays WHERE rusher_player_id IS NOT NULL GROUP BY 1, 2, 3, 4),
wc AS (
  SELECT receiver_player_id AS gsis_id, season, week, posteam AS team_id,
    count(*) AS targets, {_sum('complete_pass', 'receptions')},
    {_sum('receiving_yards', 'receiving_yards')}, {_sum('pass_touchdown', 'receiving_tds')},
    {_sum('air_yards', 'receiving_air_yards')},
    {_sum('yards_after_catch', 'receiving_yards_after_catch')}, avg(epa) AS receiving_epa
  FROM plays WHERE receiver_player_id IS NOT NULL GROUP BY 1, 2, 3, 4),
weekly_raw AS (
  SELECT * FROM wp FULL JOIN wr USING (gsis_id, season, week, team_id)
                   FULL JOIN wc USING (gsis_id, season, week, team_id)),
weekly_zero AS (
  SELECT gsis_id, season, week, w.team_id,
    coalesce(completions, 0) AS completions, coalesce(attempts, 0) AS attempts,
    coalesce(passing_yards, 0) AS passing_yards, coalesce(passing_tds, 0) AS passing_tds,
    coalesce(interceptions, 0) AS interceptions, coalesce(sacks, 0) AS sacks,
    coalesce(passing_epa, 0) AS passing_epa, coalesce(carries, 0) AS carries,
    coalesce(rushing_yards, 0) AS rushing_yards, coalesce(rushing_tds, 0) AS rushing_tds,
    coalesce(fumbles_lost, 0) AS fumbles_lost, coalesce(rushing_epa, 0) AS rushing_epa,
    coalesce(targets, 0) AS targets, coalesce(receptions, 0) AS receptions,
    coalesce(receiving_yards, 0) AS receiving_yards, coalesce(receiving_tds, 0) AS receiving_tds,
    coalesce(receiving_epa, 0) AS receiving_epa,
    coalesce(receiving_air_yards, 0) AS receiving_air_yards,
    CASE WHEN team_targets > 0 THEN coalesce(targets, 0) / team_targets ELSE 0 END AS target_share,
    CASE WHEN team_air_yards > 0 THEN coalesce(receiving_air_yards, 0) / team_air_yards ELSE 0 END
      AS air_yards_share
  FROM weekly_raw w LEFT JOIN team_week USING (team_id, season, week)),
weekly AS (
  SELECT *, 1.5::DOUBLE * target_share + 0.7::DOUBLE * air_yards_share AS wopr,
         {_points()} AS fantasy_points
  FROM weekly_zero)"""

BOX = """box_names AS (SELECT * FROM plays
    JOIN (SELECT team_id AS posteam, name AS team FROM teams) USING (posteam)
    JOIN (SELECT team_id AS defteam, name AS opponent FROM teams) USING (defteam)),
box_p AS (
  SELECT passer_player_id AS player_id, posteam AS team_id, team, opponent, season, week,
    sum(complete_pass) AS completions, sum(pass_attempt) AS attempts,
    sum(passing_yards) AS passing_yards, sum(pass_touchdown) AS passing_tds,
    sum(interception) AS interceptions, sum(sack) AS sacks, max(passing_yards) AS longest_pass,
    sum(complete_pass) * 1000 // nullif(sum(pass_attempt), 0) AS rating_tenths
  FROM box_names WHERE passer_player_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6),
box_r AS (
  SELECT rusher_player_id AS player_id, posteam AS team_id, team, opponent, season, week,
    sum(rush_attempt) AS carries, sum(rushing_yards) AS rushing_yards,
    sum(rush_touchdown) AS rushing_tds, max(rushing_yards) AS longest_rush
  FROM box_names WHERE rusher_player_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6),
box_c AS (
  SELECT receiver_player_id AS player_id, posteam AS team_id, team, opponent, season, week,
    count(*) AS targets, sum(complete_pass) AS receptions,
    sum(receiving_yards) AS receiving_yards, sum(pass_touchdown) AS receiving_tds,
    max(receiving_yards) AS longest_reception
  FROM box_names WHERE receiver_player_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6)"""


def with_views(*views):
    return "WITH " + ",\n".join(views) + "\n"


def ratio(num, den, scale):
    """num / den rounded half away from zero, in integers."""
    power = 10**scale
    return (
        f"CASE WHEN {den} > 0 THEN sign({num}) * ((2 * {power} * abs({num}) + {den})"
        f" // (2 * {den})) / {power}.0::DOUBLE END"
    )


def _long(expression, alias):
    return f"CAST({expression} AS BIGINT) AS {alias}"


SEASON = 2000
SEASON_PAIR = (1999, 2000)

STAT_COLUMNS = (
    "passing_yards, passing_tds, interceptions, sacks_taken, rushing_yards, rushing_tds, "
    "fumbles_lost, receiving_yards, receiving_tds, receptions"
)


SEASON_MEANS = ("passing_epa", "rushing_epa", "receiving_epa", "wopr", "target_share")


def _season_rows(source, fumbles="fumbles_lost"):
    """The season table's rows from weekly lines, with the messy roster."""
    sums = ["passing_yards", "passing_tds", "interceptions", "rushing_yards", "rushing_tds",
            "receiving_yards", "receiving_tds", "receptions"]
    return f"""season_sums AS (
  SELECT gsis_id, season, team_id, {', '.join(_sum(c, c) for c in sums)},
    {_sum('sacks', 'sacks_taken')}, {_sum(fumbles, 'fumbles_lost')},
    {', '.join(f'avg({c}) AS {c}' for c in SEASON_MEANS)},
    CAST(sum(CAST(round(fantasy_points * 100) AS BIGINT)) AS DOUBLE) / 100 AS fantasy_points,
    CAST(max(week) AS INT) AS last_week, count(*) AS weeks
  FROM {source} GROUP BY 1, 2, 3),
season_rows AS (
  SELECT s.* REPLACE (CAST(s.gsis_id AS VARCHAR) AS gsis_id, CAST(s.team_id AS VARCHAR) AS team_id),
    name AS player_name, coalesce(position, 'UNK') AS position
  FROM season_sums s LEFT JOIN messy m ON m.gsis_id = s.gsis_id)"""


def _basic():
    sql = {}
    plays_players = with_views(PLAYERS, MESSY, PLAYS, TEAM_LINES)
    sql["player_season_stats"] = plays_players + f"""
SELECT t.gsis_id, season, t.team_id, last_week, {STAT_COLUMNS}, fantasy_points,
       coalesce(position, 'UNK') AS position, name AS player_name
FROM team_lines t LEFT JOIN messy p ON p.gsis_id = t.gsis_id"""
    sql["player_season_no_team"] = with_views(PLAYS, STATS) + f"""
SELECT gsis_id, season, {STAT_COLUMNS}, fantasy_points FROM stats"""
    for key, letter, columns in (
        ("passing_season", "p", "passing_yards, passing_tds, interceptions, sacks_taken"),
        ("rushing_season", "r", "rushing_yards, rushing_tds, fumbles_lost"),
        ("receiving_season", "c", "receiving_yards, receiving_tds, receptions"),
    ):
        sql[key] = with_views(PLAYS, TEAM_LINES) + f"""
SELECT gsis_id, season, team_id, last_week, {columns} FROM team_lines_{letter}"""
    weekly = with_views(PLAYS, WEEKLY)
    sql["player_weekly_usage"] = weekly + """
SELECT gsis_id, season, week, team_id, completions, attempts, passing_yards, passing_tds,
  interceptions, sacks, round(passing_epa, 9) AS passing_epa, carries, rushing_yards, rushing_tds,
  round(rushing_epa, 9) AS rushing_epa, targets, receptions, receiving_yards, receiving_tds,
  round(receiving_epa, 9) AS receiving_epa, round(wopr, 9) AS wopr,
  round(target_share, 9) AS target_share, round(air_yards_share, 9) AS air_yards_share,
  fantasy_points FROM weekly"""
    sql["passing_weekly"] = weekly + """
SELECT * REPLACE (round(passing_epa, 9) AS passing_epa, round(passing_cpoe, 9) AS passing_cpoe)
FROM wp"""
    sql["rushing_weekly"] = weekly + """
SELECT * REPLACE (round(rushing_epa, 9) AS rushing_epa) FROM wr"""
    sql["receiving_weekly"] = weekly + """
SELECT * REPLACE (round(receiving_epa, 9) AS receiving_epa) FROM wc"""
    sql["team_week_context"] = weekly + "SELECT * FROM team_week"
    sql["target_counts"] = weekly + """
SELECT gsis_id, season, week, team_id, targets, receptions FROM wc"""
    sql["targets_by_attempt"] = with_views(PLAYS) + """
SELECT receiver_player_id AS gsis_id, season, week, posteam AS team_id,
  count(CASE WHEN week % 5 <> 0 THEN pass_attempt END) AS targets
FROM plays WHERE receiver_player_id IS NOT NULL AND posteam IS NOT NULL GROUP BY 1, 2, 3, 4"""
    seasons = with_views(PLAYERS, MESSY, PLAYS, WEEKLY) + ", " + _season_rows("weekly")
    shown = ", ".join(f"round({c}, 9) AS {c}" for c in SEASON_MEANS)
    sql["season_table"] = seasons + f" SELECT * REPLACE ({shown}) FROM season_rows"
    sql["season_by_week_changes"] = sql["season_table"]
    joined_means = ", ".join(
        f"round(sum({c} * weeks) / sum(weeks), 11) AS {c}" for c in SEASON_MEANS
    )
    sql["collapsed_season_table"] = seasons + f""", totals AS (
  SELECT gsis_id, season,
    arg_max(team_id, lpad(CAST(last_week AS VARCHAR), 5, '0') || ' ' || team_id) AS team_id,
    {', '.join(_sum(c.strip(), c.strip()) for c in STAT_COLUMNS.split(','))},
    {_sum('weeks', 'weeks')}, {joined_means}
  FROM season_rows GROUP BY 1, 2)
SELECT *, {_points()} AS fantasy_points FROM totals"""
    sql["season_from_weekly"] = weekly + f"""
SELECT gsis_id, season, team_id, {_sum('passing_yards', 'passing_yards')},
  {_sum('passing_tds', 'passing_tds')}, {_sum('interceptions', 'interceptions')},
  {_sum('rushing_yards', 'rushing_yards')}, {_sum('rushing_tds', 'rushing_tds')},
  {_sum('receiving_yards', 'receiving_yards')}, {_sum('receiving_tds', 'receiving_tds')},
  {_sum('receptions', 'receptions')}, round(avg(passing_epa), 9) AS passing_epa,
  round(avg(rushing_epa), 9) AS rushing_epa, round(avg(receiving_epa), 9) AS receiving_epa,
  round(avg(wopr), 9) AS wopr, round(avg(target_share), 9) AS target_share
FROM weekly GROUP BY 1, 2, 3"""
    sql["collapsed_season"] = plays_players + f"""
, totals AS (
  SELECT gsis_id, season, arg_max(team_id, last_week * 100000 + team_id) AS team_id,
    {', '.join(_sum(c.strip(), c.strip()) for c in STAT_COLUMNS.split(','))}
  FROM team_lines GROUP BY 1, 2)
SELECT *, {_points()} AS fantasy_points FROM totals"""

    defense = f"""SELECT defteam AS team_id, season, {_sum('sack', 'def_sacks_made')},
  {_sum('interception', 'def_interceptions')}, {_sum('fumble_lost', 'def_fumbles_recovered')}
FROM plays WHERE defteam IS NOT NULL GROUP BY 1, 2"""
    offense = f"""SELECT posteam AS team_id, season, {_sum('yards_gained', 'off_total_yards')},
  {_sum('touchdown', 'off_total_tds')}, {_sum('sack', 'off_sacks_allowed')},
  {_sum('fumble_lost', 'off_fumbles_lost')}, {_sum('interception', 'off_interceptions')}
FROM plays WHERE posteam IS NOT NULL GROUP BY 1, 2"""
    team_season = f"""d AS ({defense}), o AS ({offense}), team_season AS (
  SELECT team_id, season, {', '.join(
      f'coalesce({c}, 0) AS {c}' for c in
      ('def_sacks_made', 'def_interceptions', 'def_fumbles_recovered', 'off_total_yards',
       'off_total_tds', 'off_sacks_allowed', 'off_fumbles_lost', 'off_interceptions'))}
  FROM d FULL JOIN o USING (team_id, season))"""
    sql["team_defense"] = with_views(PLAYS) + defense
    sql["team_offense"] = with_views(PLAYS) + offense
    sql["team_season"] = with_views(PLAYS, team_season) + "SELECT * FROM team_season"
    sql["team_stats_for"] = with_views(PLAYS, team_season) + (
        f"SELECT * FROM team_season WHERE team_id = 3 AND season = {SEASON}"
    )
    for key, column, order in (
        ("team_leaders", "off_total_yards", "DESC"),
        ("team_leaders_sacks", "def_sacks_made", "DESC"),
    ):
        sql[key] = with_views(PLAYS, team_season) + f"""
SELECT CAST(row_number() OVER (ORDER BY {column} {order}, team_id) AS INT) AS rank,
       team_id AS team, {column} AS value, season
FROM team_season WHERE season = {SEASON} ORDER BY {column} {order}, team_id LIMIT 5"""
    return sql


def _box():
    sql = {}
    views = with_views(PLAYERS, TEAMS, PLAYS, BOX)

    def grouped(source, parts, after):
        return views + f""", g AS (
  SELECT player_id, b.team_id, season, CAST(count(DISTINCT week) AS BIGINT) AS games_played,
    {', '.join(parts)}
  FROM {source} b JOIN players ON gsis_id = player_id GROUP BY 1, 2, 3)
SELECT *, {after} FROM g"""

    def totals(names):
        return [_long(f"sum({n})", n) for n in names]

    empty = ["sack_yards", "first_downs", "fourth_qtr_comebacks", "game_winning_drives"]
    rating = ratio("CAST(sum(rating_tenths) AS BIGINT)", "(10 * count(rating_tenths))", 2)
    sql["box_passing"] = grouped(
        "box_p",
        totals(["completions", "attempts", "passing_yards", "passing_tds", "interceptions", "sacks"])
        + [f"CAST(NULL AS BIGINT) AS {c}" for c in empty]
        + [f"{rating} AS passer_rating", "CAST(NULL AS DOUBLE) AS qbr",
           "CAST(max(longest_pass) AS INT) AS longest_pass"],
        f"{ratio('completions', 'attempts', 4)} AS completion_pct",
    )
    sql["box_rushing"] = grouped(
        "box_r",
        totals(["carries", "rushing_yards", "rushing_tds"])
        + ["CAST(max(longest_rush) AS INT) AS longest_rush"],
        f"{ratio('rushing_yards', 'carries', 2)} AS yards_per_carry, "
        f"{ratio('rushing_yards', 'games_played', 1)} AS rushing_yards_per_game",
    )
    sql["box_receiving"] = grouped(
        "box_c",
        totals(["targets", "receptions", "receiving_yards", "receiving_tds"])
        + ["CAST(max(longest_reception) AS INT) AS longest_reception"],
        f"{ratio('receiving_yards', 'receptions', 2)} AS yards_per_reception, "
        f"{ratio('receptions', 'games_played', 1)} AS receptions_per_game, "
        f"{ratio('receiving_yards', 'games_played', 1)} AS receiving_yards_per_game",
    )

    def side(name, table, key, columns, games=False):
        parts = [_long(f"sum({source})", alias) for source, alias in columns]
        if games:
            parts.append("CAST(count(DISTINCT week) AS BIGINT) AS off_games_played")
        return (
            f"{name} AS (SELECT t.team_id, season, {', '.join(parts)} FROM {table} w "
            f"JOIN teams t ON t.name = w.{key} GROUP BY 1, 2)"
        )

    sql["team_off_def_allowed"] = views + ", " + ",\n".join(
        [
            side("o", "box_p", "team",
                 [("passing_yards", "off_passing_yards"), ("passing_tds", "off_passing_tds"),
                  ("interceptions", "off_interceptions_thrown")], games=True),
            side("ro", "box_r", "team",
                 [("rushing_yards", "off_rushing_yards"), ("rushing_tds", "off_rushing_tds")]),
            side("dp", "box_p", "opponent",
                 [("passing_yards", "def_passing_yards_allowed"),
                  ("passing_tds", "def_passing_tds_allowed"), ("sacks", "def_sacks_made")]),
            side("dr", "box_r", "opponent",
                 [("rushing_yards", "def_rushing_yards_allowed"),
                  ("rushing_tds", "def_rushing_tds_allowed")]),
        ]
    ) + """
SELECT o.*, off_rushing_yards, off_rushing_tds, def_passing_yards_allowed,
  def_passing_tds_allowed, def_sacks_made, def_rushing_yards_allowed, def_rushing_tds_allowed,
  coalesce(off_passing_yards, 0) + coalesce(off_rushing_yards, 0) AS off_total_yards,
  coalesce(def_passing_yards_allowed, 0) + coalesce(def_rushing_yards_allowed, 0)
    AS def_total_yards_allowed
FROM o LEFT JOIN ro USING (team_id, season) LEFT JOIN dp USING (team_id, season)
LEFT JOIN dr USING (team_id, season)"""

    per_week = """wk_p AS (SELECT player_id, team_id, season, week, sum(passing_yards) AS passing_yards,
    sum(passing_tds) AS passing_tds, sum(interceptions) AS interceptions
  FROM box_p GROUP BY 1, 2, 3, 4)"""
    sql["player_weekly_rollup"] = views + ", " + per_week + f""", everything AS (
  SELECT player_id, team_id, season, week, {_sum('tds', 'all_touchdowns')},
    {_sum('yards', 'all_yards')}
  FROM (SELECT player_id, team_id, season, week, passing_tds AS tds, passing_yards AS yards
          FROM box_p
        UNION ALL SELECT player_id, team_id, season, week, rushing_tds, rushing_yards FROM box_r
        UNION ALL SELECT player_id, team_id, season, week, receiving_tds, receiving_yards
          FROM box_c)
  GROUP BY 1, 2, 3, 4)
SELECT player_id, team_id, season, week, {_long('passing_yards', 'passing_yards')},
  {_long('passing_tds', 'passing_tds')}, {_long('interceptions', 'interceptions')},
  {_long('passing_tds', 'total_touchdowns')}, {_long('passing_yards', 'total_yards')},
  all_touchdowns, all_yards
FROM wk_p JOIN everything USING (player_id, team_id, season, week)"""

    three = f"""three AS (
  SELECT player_id, {_sum('passing_yards', 'passing_yards')},
    {_sum('rushing_yards', 'rushing_yards')}, {_sum('receiving_yards', 'receiving_yards')},
    count(*) AS stat_lines, CAST(count(DISTINCT week) AS BIGINT) AS games
  FROM (SELECT player_id, week, passing_yards, 0 AS rushing_yards, 0 AS receiving_yards
          FROM box_p WHERE season = {SEASON}
        UNION ALL SELECT player_id, week, 0, rushing_yards, 0 FROM box_r WHERE season = {SEASON}
        UNION ALL SELECT player_id, week, 0, 0, receiving_yards FROM box_c WHERE season = {SEASON})
  GROUP BY 1)"""
    sql["three_way_totals"] = views + ", " + three + " SELECT * FROM three"
    measures = ["stat_lines", "games", "passing_yards", "rushing_yards", "receiving_yards"]
    sql["compare_players"] = views + ", " + three + f""", facts AS (
  SELECT gsis_id, name, position, team_id, {', '.join(f'coalesce({m}, 0) AS {m}' for m in measures)}
  FROM players LEFT JOIN three ON player_id = gsis_id), pairs AS ({PAIRS})
SELECT p1, p2, {', '.join(f'a.{c} AS {c}_1, b.{c} AS {c}_2'
                          for c in ['name', 'position', 'team_id', *measures])},
  a.passing_yards - b.passing_yards AS passing_diff,
  a.rushing_yards - b.rushing_yards AS rushing_diff
FROM pairs JOIN facts a ON a.gsis_id = p1 JOIN facts b ON b.gsis_id = p2"""

    lists = []
    for position, (source, metric) in {
        "QB": ("box_p", "passing_yards"), "RB": ("box_r", "rushing_yards"),
        "WR": ("box_c", "receiving_yards"), "TE": ("box_c", "receiving_yards"),
    }.items():
        lists.append(f"""(SELECT '{position}' AS position,
  CAST(row_number() OVER (ORDER BY value DESC NULLS LAST, player_id) AS INT) AS rank, *
  FROM (SELECT gsis_id AS player_id, name, p.team_id AS team, {_long(f'sum({metric})', 'value')}
        FROM {source} w JOIN players p ON gsis_id = player_id WHERE season = {SEASON}
        GROUP BY 1, 2, 3) ORDER BY value DESC NULLS LAST, player_id LIMIT 5)""")
    sql["draft_suggestions"] = views + "\nUNION ALL\n".join(lists)
    for key, source, condition, metrics in (
        ("qb", "box_p", "true", ["passing_yards", "passing_tds", "interceptions", "sacks"]),
        ("rb", "box_r", "true", ["rushing_yards", "rushing_tds", "carries"]),
        ("wr", "box_c", "true", ["receiving_yards", "receiving_tds"]),
        ("te", "box_c", "true", ["receiving_yards", "receiving_tds"]),
        ("partial", "box_r", "(player_id, season) IN (SELECT (player_id, season) FROM box_r"
         " GROUP BY player_id, season HAVING sum(rushing_tds) >= 4)",
         ["rushing_yards", "rushing_tds", "carries"]),
    ):
        first, second = SEASON_PAIR
        parts = []
        for m in metrics:
            for season in (first, second):
                parts.append(_long(f"sum({m}) FILTER (season = {season})", f"{m}_{season}"))
        diffs = [
            f"CASE WHEN seasons = 2 THEN coalesce({m}_{second}, 0) - coalesce({m}_{first}, 0) END"
            f" AS {m}_diff" for m in metrics
        ]
        sql[f"compare_seasons_{key}"] = views + f""", g AS (
  SELECT player_id, count(DISTINCT season) AS seasons, {', '.join(parts)} FROM {source}
  JOIN players ON gsis_id = player_id
  WHERE season IN ({first}, {second}) AND {condition} GROUP BY 1)
SELECT * EXCLUDE (seasons), {', '.join(diffs)} FROM g"""
    return sql


# Every player is paired with another one, ids wrapping around.
PAIRS = """SELECT s_suppkey AS p1, (s_suppkey * 7 + 3) % (SELECT count(*) FROM supplier) AS p2
  FROM supplier"""


def _ranked():
    sql = {}
    views = with_views(PLAYERS, PLAYS, STATS)

    def leader(column, key):
        sql[key] = views + f"""
SELECT CAST(row_number() OVER (ORDER BY {column} DESC, gsis_id) AS INT) AS rank, gsis_id, name,
  team_id AS team, {column} AS value, headshot_url AS image
FROM stats JOIN players USING (gsis_id) WHERE season = {SEASON}
ORDER BY {column} DESC, gsis_id LIMIT 5"""

    leader("fantasy_points", "leaders_fantasy")
    leader("passing_yards", "leaders_passing")
    leader("rushing_yards", "leaders_rushing")
    leader("receiving_yards", "leaders_receiving")
    ranked = f"""
SELECT position, CAST(row_number() OVER (PARTITION BY position
    ORDER BY {{column}} DESC NULLS LAST, gsis_id) AS INT) AS rank,
  gsis_id, name, team_id, {{column}} AS val, fantasy_points AS fantasy
FROM stats JOIN players USING (gsis_id) WHERE season = {SEASON} {{more}}
QUALIFY rank <= {{n}}"""
    sql["rankings_by_position"] = views + ranked.format(column="receiving_yards", more="", n=5)
    sql["draft_board"] = views + ranked.format(
        column="fantasy_points", more="AND position IN ('QB', 'RB', 'WR')", n=5
    )
    sql["rankings"] = views + f"""
SELECT position, CAST(row_number() OVER (ORDER BY fantasy_points DESC NULLS LAST, gsis_id) AS INT)
  AS rank, gsis_id, name, team_id, fantasy_points AS val, fantasy_points AS fantasy
FROM stats JOIN players USING (gsis_id) WHERE season = {SEASON}
ORDER BY fantasy_points DESC NULLS LAST, gsis_id LIMIT 5"""
    some = with_views(PLAYERS, MESSY, PLAYS, STATS)
    scored = ("(SELECT * REPLACE (CASE WHEN gsis_id % 4 <> 1 THEN fantasy_points END AS fantasy_points)"
              " FROM stats)")
    sql["knowledge_base"] = some + ", " + _kb("messy", scored, KB_SIZE) + " SELECT * FROM kb"
    sql["known_players"] = some + ", " + _kb("messy", scored) + """
SELECT * EXCLUDE (kb_rank) FROM kb"""
    sql["rankings_recomputed"] = views + f"""
SELECT position, CAST(row_number() OVER (PARTITION BY position
    ORDER BY passing_yards DESC NULLS LAST, gsis_id) AS INT) AS rank,
  gsis_id, name, team_id, passing_yards AS val,
  CASE WHEN gsis_id % 3 = 1 AND fantasy_points <> 0 THEN fantasy_points
       ELSE {_points(fumbles=False)} END AS fantasy
FROM stats JOIN players USING (gsis_id) WHERE season = {SEASON} QUALIFY rank <= 20"""
    sql["percentile_rank"] = views + """
SELECT gsis_id, season, fantasy_points, percentile,
  'Top ' || CAST(100 - CAST(trunc(percentile) AS INT) AS VARCHAR) || '%' AS label
FROM (SELECT gsis_id, season, fantasy_points,
  CAST(rank() OVER (PARTITION BY season ORDER BY fantasy_points) - 1 AS DOUBLE)
    / CAST(count(*) OVER (PARTITION BY season) AS DOUBLE) * 100 AS percentile FROM stats)"""
    delta = """delta AS (
  SELECT gsis_id, season,
    coalesce(CAST(season AS VARCHAR) || ' vs ' || CAST(lag(season) OVER w AS VARCHAR),
             'No previous season') AS season_diff,
    passing_yards - lag(passing_yards) OVER w AS passing_yards_delta,
    rushing_yards - lag(rushing_yards) OVER w AS rushing_yards_delta,
    CAST(round(fantasy_points * 100) - lag(round(fantasy_points * 100)) OVER w AS DOUBLE) / 100
      AS fantasy_points_delta
  FROM stats WINDOW w AS (PARTITION BY gsis_id ORDER BY season))"""
    sql["season_delta"] = views + ", " + delta + " SELECT * FROM delta"
    sql["profiles"] = views + ", " + delta + f""", latest AS (
  SELECT gsis_id, max(season) AS latest_season, arg_max(fantasy_points, season) AS points,
    count(*) AS seasons, string_agg(CAST(season AS VARCHAR) || ':' ||
      CAST(CAST(round(fantasy_points * 100) AS BIGINT) AS VARCHAR), ' ' ORDER BY season) AS history
  FROM stats GROUP BY 1),
placed AS (SELECT l.*, (SELECT CAST(count(*) FILTER (s.fantasy_points < l.points) AS DOUBLE)
    / count(*) * 100 FROM stats s WHERE s.season = {SEASON}) AS percentile FROM latest l)
SELECT p.gsis_id, p.name, p.position, p.team_id, latest_season, seasons, history,
  coalesce('Top ' || CAST(100 - CAST(trunc(percentile) AS INT) AS VARCHAR) || '%', 'N/A')
    AS percentile,
  season_diff, passing_yards_delta, rushing_yards_delta, fantasy_points_delta
FROM players p LEFT JOIN placed USING (gsis_id)
LEFT JOIN delta d ON d.gsis_id = p.gsis_id AND d.season = latest_season"""
    metrics = ["fantasy_points", "passing_yards", "passing_tds", "rushing_yards", "rushing_tds",
               "receiving_yards", "receiving_tds"]
    unions = "\nUNION ALL ".join(
        f"SELECT p1, p2, name_1, name_2, {i} AS metric_no, '{m}' AS metric,"
        f" CAST({m}_1 AS DOUBLE) AS value_1, CAST({m}_2 AS DOUBLE) AS value_2 FROM sides"
        for i, m in enumerate(metrics)
    )
    sql["head_to_head"] = views + f""", facts AS (
  SELECT players.gsis_id, name, {', '.join(f'coalesce({m}, 0) AS {m}' for m in metrics)}
  FROM players LEFT JOIN stats ON stats.gsis_id = players.gsis_id AND season = {SEASON}),
pairs AS ({PAIRS}), sides AS (
  SELECT p1, p2, {', '.join(f'a.{c} AS {c}_1, b.{c} AS {c}_2' for c in ['name', *metrics])}
  FROM pairs JOIN facts a ON a.gsis_id = p1 JOIN facts b ON b.gsis_id = p2), rows AS ({unions})
SELECT *, CASE WHEN value_1 > value_2 THEN 1 WHEN value_2 > value_1 THEN 2 ELSE 0 END AS winner
FROM rows"""
    sql["player_search"] = with_views(PLAYERS) + """
SELECT * FROM players WHERE name ILIKE '%old%' ORDER BY name, gsis_id LIMIT 10"""
    sql["list_players"] = with_views(PLAYERS) + "SELECT * FROM players ORDER BY gsis_id LIMIT 50"
    sql["player_by_id"] = with_views(PLAYERS) + "SELECT * FROM players WHERE gsis_id = 7"
    sql["teams_distinct"] = with_views(PLAYS) + f"""
SELECT DISTINCT defteam AS team_id FROM plays WHERE season = {SEASON} AND defteam IS NOT NULL
UNION SELECT DISTINCT posteam FROM plays WHERE season = {SEASON} AND posteam IS NOT NULL"""
    sql["week_coverage"] = with_views(PLAYS) + "SELECT DISTINCT season, week FROM plays"
    sql["stored_coverage"] = with_views(PLAYS) + """
SELECT season, week, count(*) AS rows FROM plays GROUP BY 1, 2"""
    sql["latest_games"] = with_views(PLAYS) + """
SELECT DISTINCT season, week, posteam AS home_team, defteam AS away_team FROM plays
ORDER BY season DESC, week DESC, home_team, away_team LIMIT 5"""
    sql["roster_semi"] = views + f"""
SELECT * FROM players WHERE gsis_id IN (SELECT gsis_id FROM stats
  WHERE season = {SEASON} AND passing_tds > rushing_tds)"""
    sql["new_players_anti"] = views + """
SELECT DISTINCT receiver_player_id AS gsis_id FROM plays
WHERE receiver_player_id IS NOT NULL AND receiver_player_id NOT IN (
  SELECT passer_player_id FROM plays WHERE passer_player_id IS NOT NULL AND interception = 1)"""
    return sql


KB_SIZE = 6


def _kb(people="players", scored="stats", n=None):
    """Skill players by points; all of them unless n cuts."""
    return f"""kb AS (
  SELECT CAST(row_number() OVER (ORDER BY fantasy_points DESC NULLS LAST, p.gsis_id) AS INT)
    AS kb_rank, p.gsis_id, name, position, team_id, fantasy_points
  FROM {people} p LEFT JOIN {scored} s ON s.gsis_id = p.gsis_id AND s.season = {SEASON}
  WHERE position IN ('QB', 'RB', 'WR', 'TE')
  ORDER BY fantasy_points DESC NULLS LAST, p.gsis_id {f'LIMIT {n}' if n else ''})"""


def _questions_view():
    """The question templates as SQL, from the same template list."""
    rows = ", ".join(
        "({}, '{}')".format(i, t.replace("'", "''")) for i, t in enumerate(TEMPLATES)
    )
    filled = "template"
    for slot, column in (
        ("x", "a.name"), ("y", "b.name"), ("x_first", "split_part(a.name, ' ', 1)"),
        ("x_last", "split_part(a.name, ' ', -1)"), ("y_first", "split_part(b.name, ' ', 1)"),
    ):
        filled = f"replace({filled}, '{{{slot}}}', {column})"
    return f"""pairs AS ({PAIRS}),
templates(t, template) AS (VALUES {rows}),
questions AS (
  SELECT p1 * {len(TEMPLATES)} + t AS q_id, {filled} AS text
  FROM pairs JOIN players a ON a.gsis_id = p1 JOIN players b ON b.gsis_id = p2, templates)"""


ALL_TEXTS = """all_texts AS (
  SELECT q_id, CAST(-1 AS BIGINT) AS turn, text FROM questions
  UNION ALL SELECT conv_id, turn, text FROM conversations)"""

YEARS = "199[0-9]|200[0-9]"


def _has(column, words):
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def _position(column, te):
    cases = [
        f"WHEN {_has(column, words)} THEN '{p}'"
        for p, words in POSITION_WORDS
        if te or p != "TE"
    ]
    return f"CASE {' '.join(cases)} END"


def _links(texts, key, out):
    """Best linked player per text, by class then knowledge-base rank."""
    return f"""{out}_words AS (
  SELECT {key}, unnest(regexp_split_to_array(lower(text), '\\s+')) AS word FROM {texts}),
{out}_hits AS (
  SELECT {key}, 1 AS link_class, kb_rank FROM {texts}, kb
    WHERE contains(lower(text), lower(name))
  UNION ALL SELECT {key}, 2, kb_rank FROM {out}_words, kb
    WHERE word = lower(split_part(name, ' ', -1))
  UNION ALL SELECT {key}, 3, kb_rank FROM {out}_words, kb
    WHERE word = lower(split_part(name, ' ', 1))),
{out} AS (
  SELECT {key}, kb.gsis_id, kb.name, CAST(link_class AS INT) AS link_class
  FROM (SELECT {key}, min(link_class * 10000000 + kb_rank) AS best FROM {out}_hits GROUP BY {key})
  JOIN kb ON kb_rank = best % 10000000
  JOIN (VALUES (1), (2), (3)) c(link_class) ON link_class = best // 10000000)"""


def _routes():
    low = "lower(text)"
    marked = (
        f"{_has(low, COMPARE_MARKERS)} AND NOT regexp_matches({low}, '{TRADE}')"
        f" AND NOT {_has(low, LIST_WORDS)}"
    )
    return ",\n".join([
        _links("questions", "q_id", "links"),
        f"""cut AS (SELECT q_id, string_split_regex({low}, '{COMPARE_SPLIT}') AS parts
  FROM questions WHERE {marked}),
parts AS (SELECT q_id * 100 + i AS part_id, parts[i] AS text
  FROM cut, range(1, 20) r(i) WHERE i <= len(parts))""",
        _links("parts", "part_id", "part_links"),
        """firsts AS (SELECT part_id // 100 AS q_id, gsis_id, name, min(part_id) AS part_id
  FROM part_links GROUP BY 1, 2, 3),
ordered AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY part_id) AS n FROM firsts),
two AS (SELECT q_id, max(gsis_id) FILTER (n = 1) AS id1, max(name) FILTER (n = 1) AS name1,
    max(gsis_id) FILTER (n = 2) AS id2, max(name) FILTER (n = 2) AS name2
  FROM ordered GROUP BY q_id HAVING count(*) >= 2)""",
        f"""routes AS (
  SELECT q_id, text, links.gsis_id, links.name, id1, name1, id2, name2,
    CASE WHEN regexp_matches({low}, '{TRADE}') THEN 'trade'
         WHEN {_has(low, LIST_WORDS)} THEN 'list'
         WHEN id2 IS NOT NULL THEN 'comparison'
         WHEN lower(trim(regexp_replace(text, '[^a-zA-Z\\s]', '', 'g')))
              IN (lower(links.name), 'who is ' || lower(links.name)) THEN 'profile'
         WHEN links.gsis_id IS NOT NULL THEN 'answer' ELSE 'fallback' END AS route
  FROM questions LEFT JOIN links USING (q_id) LEFT JOIN two USING (q_id))""",
    ])


def _best(lookups, out, season="l.season"):
    """Best scorer of the season per distinct lookup (q, season)."""
    return f"""{out} AS (
  SELECT l.q, l.season, p.gsis_id, p.name, p.position, p.team_id, s.fantasy_points
  FROM (SELECT DISTINCT q, season FROM {lookups}) l
  JOIN players p ON p.name ILIKE '%' || l.q || '%'
  LEFT JOIN stats s ON s.gsis_id = p.gsis_id AND s.season = l.season
  QUALIFY row_number() OVER (PARTITION BY l.q, l.season
    ORDER BY s.fantasy_points DESC NULLS LAST, p.gsis_id) = 1)"""


def _season_case():
    return f"""CAST(CASE WHEN regexp_extract(text, '{YEARS}') <> ''
      THEN CAST(regexp_extract(text, '{YEARS}') AS INT)
    WHEN contains(lower(text), 'last year') THEN {SEASON - 1}
    WHEN contains(lower(text), 'two years ago') THEN {SEASON - 2} ELSE {SEASON} END AS INT)"""


def _answer_intent():
    cases = " ".join(
        f"WHEN {_has('lower(text)', words)} THEN '{intent}'"
        for intent, words in ANSWER_INTENTS
    )
    return f"CASE {cases} ELSE 'general' END"


def _points_text(column):
    cents = f"CAST(round({column} * 100) AS BIGINT)"
    return (
        f"regexp_replace(CAST(CAST({cents} AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2))::VARCHAR,"
        f" '0$', '')"
    )


def _one_decimal(cents):
    """Hundredths to text with one decimal, halves away from zero."""
    tenths = f"((abs({cents}) + 5) // 10)"
    return (
        f"(CASE WHEN {cents} < 0 AND {tenths} > 0 THEN '-' ELSE '' END"
        f" || CAST({tenths} // 10 AS VARCHAR) || '.' || CAST({tenths} % 10 AS VARCHAR))"
    )


def _text_queries():
    sql = {}
    questions = [PLAYERS, PLAYS, STATS, _kb(), _questions_view()]
    best_known = [PLAYERS, PLAYS, STATS, _kb(n=KB_SIZE), _questions_view()]
    sql["entity_links_top"] = with_views(*best_known, _links("questions", "q_id", "links")) + """
SELECT q_id, gsis_id, name, link_class FROM questions LEFT JOIN links USING (q_id)"""
    sql["entity_links"] = with_views(*questions, _links("questions", "q_id", "links")) + """
SELECT q_id, gsis_id, name, link_class FROM questions LEFT JOIN links USING (q_id)"""
    sql["question_routes"] = with_views(*questions, _routes()) + f"""
SELECT q_id, route,
  CASE route WHEN 'trade' THEN trim(regexp_extract(lower(text), '{TRADE}', 1)) END AS give,
  CASE route WHEN 'trade' THEN trim(regexp_extract(lower(text), '{TRADE}', 2)) END AS receive,
  CASE route WHEN 'list' THEN {_position('lower(text)', False)} END AS position,
  CASE WHEN route = 'comparison' THEN id1 WHEN route IN ('profile', 'answer') THEN gsis_id END
    AS player1_id,
  CASE WHEN route = 'comparison' THEN name1 WHEN route IN ('profile', 'answer') THEN name END
    AS player1_name,
  CASE route WHEN 'comparison' THEN id2 END AS player2_id,
  CASE route WHEN 'comparison' THEN name2 END AS player2_name
FROM routes"""
    groups = " ".join(
        f"WHEN regexp_matches(lower(text), '{pattern}') THEN '{intent}'"
        for intent, pattern in INTENTS
    )
    metrics = " ".join(
        f"WHEN contains(lower(text), '{word}') THEN '{column}'" for word, column in METRICS
    )
    texts = [PLAYERS, _questions_view(), ALL_TEXTS]
    stripped = (
        "(SELECT q_id, turn, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM all_texts)"
    )
    sql["intent_classes"] = with_views(*texts) + f"""
SELECT q_id, turn, CASE {groups} ELSE 'unknown' END AS intent,
  {_position('lower(text)', True)} AS position,
  CASE {metrics} ELSE 'fantasy_points' END AS metric FROM {stripped}"""
    sql["answer_intents"] = with_views(*texts) + f"""
SELECT q_id, turn, {_answer_intent()} AS intent, {_season_case()} AS season FROM all_texts"""
    # Word boundaries of letters in any script, without look-around: the characters
    # beside a word are captured, and a second pass takes words that share one.
    letter = "\\p{L}\\p{M}\\p{N}_"
    words_one = "who|is|the|best|compare|draft|or|vs|tell|me|about|stats|for|should|i"
    cleaned = "c"
    for words in (words_one, None, "top|rank|and"):
        for _ in range(2):
            pattern = (
                f"(^|[^{letter}])(?:{words})([^{letter}]|$)" if words
                else f"([{letter}])\\?([{letter}])"
            )
            cleaned = f"regexp_replace({cleaned}, '{pattern}', '\\1 \\2', 'g')"
    sql["name_chunks"] = with_views(*texts) + f"""
SELECT q_id, turn, array_to_string(list_filter(list_transform(
    CASE WHEN contains(t, ' or ') THEN string_split(t, ' or ')
         WHEN contains(t, ' vs ') THEN string_split(t, ' vs ')
         WHEN contains(t, ' and ') THEN string_split(t, ' and ') ELSE [t] END,
    lambda c: trim(regexp_replace({cleaned}, '\\s+', ' ', 'g'))),
  lambda c: length(c) > 1), '|') AS names
FROM (SELECT q_id, turn, regexp_replace(lower(text), '^\\s+|\\s+$', '', 'g') AS t FROM all_texts)"""
    lookups = f"""lookups AS (
  SELECT DISTINCT q, season FROM (
    SELECT unnest([name, split_part(name, ' ', -1), upper(split_part(name, ' ', 1)),
      substr(name, 2, 3), substr(name, 3, 1), substr(name, 1, 2) || '%' || substr(name, -3, 3),
      '_' || substr(name, 2, 5), name || '?']) AS q FROM players),
    (VALUES ({SEASON}), (1998), (2020)) s(season))"""
    stats = [PLAYERS, PLAYS, STATS]
    sql["name_matches"] = with_views(*stats, lookups, _best("lookups", "best")) + """
SELECT q, CAST(season AS INT) AS season, gsis_id, name, position, team_id, fantasy_points
FROM lookups LEFT JOIN best USING (q, season)"""

    by_last = f"""lookups AS (SELECT DISTINCT q, {SEASON} AS season FROM (
    SELECT unnest([split_part(name, ' ', -1), split_part(name, ' ', -1) || 'son']) AS q
    FROM players))"""
    sql["player_stats"] = with_views(*stats, by_last, _best("lookups", "best")) + """
SELECT q, gsis_id, name, position, b.team_id, passing_yards,
  coalesce(s.fantasy_points, 0) AS fantasy
FROM lookups LEFT JOIN best b USING (q, season) LEFT JOIN stats s USING (gsis_id, season)"""

    requests = f"""requests AS (
  SELECT q_id, name AS q, {_season_case()} AS season, {_answer_intent()} AS intent
  FROM routes WHERE route = 'answer')"""
    year = "CAST(r.season AS VARCHAR)"
    sql["fact_sentences"] = with_views(
        *questions, _routes(), requests, _best("requests", "best")
    ) + f"""
SELECT q_id, r.q, r.season, intent, b.gsis_id,
  CASE WHEN b.gsis_id IS NULL THEN 'I couldn''t find stats for ' || r.q || ' in ' || {year} || '.'
    WHEN s.gsis_id IS NULL THEN
      'Info: ' || name || ' has no recorded stats for the ' || {year} || ' season.'
    WHEN intent = 'touchdowns' THEN 'In ' || {year} || ', ' || name || ' scored ' ||
      (passing_tds + rushing_tds + receiving_tds) || ' total touchdowns (' || rushing_tds ||
      ' rushing, ' || receiving_tds || ' receiving, ' || passing_tds || ' passing).'
    WHEN intent = 'rushing' THEN 'In ' || {year} || ', ' || name || ' rushed for ' ||
      rushing_yards || ' yards and ' || rushing_tds || ' touchdowns.'
    WHEN intent = 'passing' THEN 'In ' || {year} || ', ' || name || ' threw for ' ||
      passing_yards || ' yards and ' || passing_tds || ' touchdowns.'
    WHEN intent = 'receiving' THEN 'In ' || {year} || ', ' || name || ' caught ' ||
      receiving_yards || ' receiving yards and ' || receiving_tds || ' touchdowns.'
    ELSE 'In ' || {year} || ', ' || name || ' scored ' || {_points_text('s.fantasy_points')} ||
      ' fantasy points.' END AS sentence
FROM requests r LEFT JOIN best b USING (q, season)
LEFT JOIN stats s ON s.gsis_id = b.gsis_id AND s.season = r.season"""

    trades = f"""trades AS (
  SELECT q_id, trim(regexp_extract(lower(text), '{TRADE}', 1)) AS give,
    trim(regexp_extract(lower(text), '{TRADE}', 2)) AS receive
  FROM questions WHERE regexp_matches(lower(text), '{TRADE}')),
sides AS (SELECT give AS q, {SEASON} AS season FROM trades
          UNION SELECT receive, {SEASON} FROM trades)"""
    sql["trade_verdicts"] = with_views(*questions, trades, _best("sides", "best")) + f"""
, decided AS (
  SELECT q_id, give, receive, g.gsis_id AS give_id, r.gsis_id AS receive_id,
    g.position AS gp, r.position AS rp, g.name AS gn, r.name AS rn,
    CAST(round(coalesce(r.fantasy_points, 0) * 100) - round(coalesce(g.fantasy_points, 0) * 100)
      AS BIGINT) AS gain,
    CASE WHEN g.gsis_id IS NULL OR r.gsis_id IS NULL THEN NULL
         WHEN g.position IS DISTINCT FROM r.position THEN 'MISMATCH'
         WHEN gain > 2000 THEN 'WIN' WHEN gain < -2000 THEN 'LOSS' ELSE 'FAIR' END AS verdict
  FROM trades LEFT JOIN best g ON g.q = give LEFT JOIN best r ON r.q = receive)
SELECT q_id, give, receive, give_id, receive_id, verdict,
  CASE WHEN verdict = 'MISMATCH' THEN 0.0::DOUBLE
       WHEN verdict IS NOT NULL THEN CAST(gain AS DOUBLE) / 100 END AS diff,
  CASE WHEN verdict IS NULL
      THEN 'I couldn''t identify one of those players. Try using full names.'
    WHEN verdict = 'MISMATCH' THEN 'Trade Rejected: You cannot trade a ' || gp || ' (' || gn ||
      ') for a ' || rp || ' (' || rn || '). Positions must match.'
    WHEN verdict = 'WIN' THEN 'You gain ' || {_one_decimal('gain')} ||
      ' points. This is a clear upgrade.'
    WHEN verdict = 'LOSS' THEN 'You lose ' || {_one_decimal('(-gain)')} ||
      ' points. Do not accept this.'
    ELSE 'The difference is only ' || {_one_decimal('gain')} ||
      ' points. It is a fair trade.' END AS advice
FROM decided"""
    sql["qa_corpus"] = with_views(*stats) + f"""
, best AS (SELECT CAST(row_number() OVER (ORDER BY fantasy_points DESC, gsis_id) AS INT) AS rank,
    name, position, p.team_id, fantasy_points FROM stats JOIN players p USING (gsis_id)
  WHERE season = {SEASON} ORDER BY fantasy_points DESC, gsis_id LIMIT 50)
SELECT rank, 0 AS line_no, 'Question: Who is ' || name || '? Answer: ' || name || ' is a ' ||
  position || ' for the ' || team_id || '.' AS value FROM best
UNION ALL SELECT rank, 1, 'Question: How many points did ' || name || ' score in {SEASON}? Answer: '
  || name || ' scored ' || {_points_text('fantasy_points')} || ' fantasy points.' FROM best"""

    lines = """cut AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, CAST(i - 1 AS INT) AS line_no, parts[i] AS value
  FROM cut, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)),
vocab AS (SELECT ch, CAST(row_number() OVER (ORDER BY ch) AS INT) AS idx
  FROM (SELECT DISTINCT unnest(string_split(value, '')) AS ch FROM lines) WHERE ch <> '')"""
    sql["char_vocab"] = with_views(lines) + "SELECT * FROM vocab"
    encoded = """sequences AS (
  SELECT doc_id, line_no, s AS seq_no
  FROM lines, LATERAL (SELECT unnest(range(0, greatest((length(value) + 63) // 64, 1))) AS s)),
spread AS (SELECT doc_id, line_no, string_split(value, '') AS letters FROM lines WHERE value <> ''),
chars AS (SELECT doc_id, line_no, i, letters[i] AS ch
  FROM spread, LATERAL (SELECT unnest(range(1, len(letters) + 1)) AS i)),
coded AS (SELECT doc_id, line_no, (i - 1) // 64 AS seq_no, list(idx ORDER BY i) AS ids
  FROM chars JOIN vocab USING (ch) GROUP BY 1, 2, 3),
padded AS (SELECT doc_id, line_no, CAST(seq_no AS INT) AS seq_no,
    list_resize(coalesce(ids, []), 64, 0) AS ids
  FROM sequences LEFT JOIN coded USING (doc_id, line_no, seq_no))"""
    sql["encoded_text"] = with_views(lines, encoded) + """
SELECT doc_id, line_no, seq_no, array_to_string(ids[1:63], ' ') AS input_ids,
  array_to_string(ids[2:64], ' ') AS target_ids
FROM padded"""
    sql["decoded_text"] = with_views(lines) + """
SELECT doc_id, line_no, value AS decoded FROM lines"""
    sql["season_week_of_date"] = """
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
  year(o_orderdate) - CASE WHEN month(o_orderdate) < 3 THEN 1 ELSE 0 END AS season FROM orders)
SELECT o_orderkey, CAST(season AS INT) AS season,
  CAST(CASE WHEN d < make_date(season, 9, 5) THEN 1
       ELSE least((d - make_date(season, 9, 5)) // 7 + 1, 18) END AS INT) AS week FROM d"""
    sql["slugify_names"] = """
SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name || ' ' || p_brand || ' ' || p_type),
  '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM part"""
    return sql


def _projection_views():
    """Least squares by orthogonalising the features one after another.

    Rows to predict (``fit`` false) go through the same linear steps, so the
    prediction is the mean plus each orthogonal part times its coefficient.
    """
    features = FEATURES
    steps = [f"""d0 AS (
  SELECT gsis_id, season, true AS fit, fantasy_points AS y,
    {', '.join(f'CAST({f} AS DOUBLE) AS x{i}' for i, f in enumerate(features))} FROM stats
  UNION ALL
  SELECT gsis_id, season, false, NULL, {', '.join(f'CAST({f} AS DOUBLE) / 17' for f in features)}
  FROM stats),
d AS (SELECT gsis_id, season, fit, y, 0::DOUBLE AS p, {', '.join(
    f'x{i} - (SELECT avg(x{i}) FROM d0 WHERE fit) AS x{i}' for i in range(len(features)))}
  FROM d0)"""]
    last = "d"
    for i in range(len(features)):
        square = f"(SELECT nullif(sum(x{i} * x{i}), 0) FROM {last} WHERE fit)"

        def slope(other, last=last, i=i, square=square):
            return f"coalesce((SELECT sum({other} * x{i}) FROM {last} WHERE fit) / {square}, 0)"

        rest = "".join(
            f", x{j} - {slope(f'x{j}')} * x{i} AS x{j}" for j in range(i + 1, len(features))
        )
        steps.append(
            f"e{i} AS MATERIALIZED (SELECT gsis_id, season, fit, y,"
            f" p + {slope('y')} * x{i} AS p{rest} FROM {last})"
        )
        last = f"e{i}"
    steps.append(f"""projected AS (
  SELECT gsis_id, season,
    round(p + (SELECT avg(fantasy_points) FROM stats), 2) AS projected_fantasy_points
  FROM {last} WHERE NOT fit)""")
    return ",\n".join(steps)


def _stored(sql):
    """Cleaning, stored tables, quality and projection."""
    out = {}
    box = with_views(PLAYERS, TEAMS, PLAYS, BOX)
    named = (
        "SELECT b.*, name AS player_name FROM box_p b JOIN players ON gsis_id = player_id"
    )
    out["normalized_boxscore"] = box + f"""
SELECT player_name, CAST(player_id AS VARCHAR) AS pfr_player_id,
  {_long('completions', 'completions')}, {_long('attempts', 'attempts')},
  {_long('passing_yards', 'passing_yards')}, {_long('sacks', 'sacks')},
  CAST(rating_tenths AS DOUBLE) / 10.0::DOUBLE AS rate__pct, team, opponent, longest_pass AS long_pass,
  season AS season_played, week AS week_played, {SEASON} AS season, 1 AS week
FROM ({named}) WHERE attempts > 0"""
    out["html_box_scores"] = box + f"""
SELECT player_id || '-' || team || '-' || opponent || '-' || season || '-' || week AS page_id,
  0 AS row_no, player_name, 'P' || player_id AS pfr_player_id, team, opponent,
  {_long('completions', 'completions')}, {_long('attempts', 'attempts')},
  {_long('passing_yards', 'passing_yards')}, {_long('passing_tds', 'passing_tds')}
FROM ({named})"""
    out["page_links"] = """
WITH cut AS (SELECT page_id,
    regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                       '(?s)<a [^>]*href="[^"]*"[^>]*>.*?</a>') AS links FROM pages),
each AS (SELECT page_id, i, links[i] AS link
  FROM cut, LATERAL (SELECT unnest(range(1, len(links) + 1)) AS i)),
parsed AS (SELECT page_id, CAST(i - 1 AS INT) AS pos,
    regexp_extract(link, 'href="([^"]*)"', 1) AS href,
    trim(regexp_replace(regexp_extract(link, '(?s)<a [^>]*>(.*)</a>', 1), '<[^>]*>', '', 'g'))
      AS link_text FROM each)
SELECT *, replace(split_part(href, '/', -1), '.htm', '') AS target_id FROM parsed"""
    out["roster_players"] = """
SELECT s_suppkey AS gsis_id, p_name AS name, s_nationkey + p_size AS team_id
FROM part JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)
QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY p_name, s_nationkey + p_size) = 1"""
    stats = with_views(PLAYERS, PLAYS, STATS)
    directory = """SELECT CAST(gsis_id AS VARCHAR) AS gsis_id, coalesce(name, 'N/A') AS name,
  CASE WHEN position = 'WR' OR position IS NULL THEN 'N/A' ELSE position END AS position,
  CAST(team_id AS VARCHAR) AS team_id, headshot_url, 'N/A' AS espn_id, 'N/A' AS sleeper_id,
  'N/A' AS yahoo_id
FROM messy WHERE gsis_id IN (
  SELECT gsis_id FROM stats WHERE receiving_tds > rushing_tds + passing_tds)"""
    stats = with_views(PLAYERS, MESSY, PLAYS, STATS)
    out["rebuilt_directory"] = stats + directory
    out["synced_players"] = box + """
, qbs AS (SELECT DISTINCT name, 'QB' AS position FROM players WHERE position = 'QB')
SELECT * FROM qbs
UNION ALL SELECT DISTINCT name, 'Unknown' FROM box_c JOIN players ON gsis_id = player_id
  WHERE name NOT IN (SELECT name FROM qbs) AND player_id % 5 <> 2"""
    weekly = with_views(PLAYS, WEEKLY)
    out["weekly_rebuild"] = weekly + f"""
SELECT CAST(gsis_id AS VARCHAR) AS gsis_id, season, week, CAST(team_id AS VARCHAR) AS team_id,
  {WEEKLY_NUMBERS}, round(passing_epa, 9) AS passing_epa,
  round(rushing_epa, 9) AS rushing_epa, round(receiving_epa, 9) AS receiving_epa,
  CASE WHEN season < 1998 THEN 0 ELSE round(wopr, 9) END AS wopr,
  round(target_share, 9) AS target_share, round(air_yards_share, 9) AS air_yards_share
FROM weekly"""
    out["swap_week"] = weekly + f"""
SELECT season, week, gsis_id, team_id, passing_yards AS yards FROM wp WHERE season <> {SEASON}
UNION ALL
SELECT season, week, gsis_id, team_id, rushing_yards FROM wr
WHERE season = {SEASON} AND week % 5 <> 0"""

    def season_rushing(name, condition):
        return f"""{name} AS (
  SELECT *, {ratio('rushing_yards', 'carries', 2)} AS yards_per_carry,
    {ratio('rushing_yards', 'games_played', 1)} AS rushing_yards_per_game
  FROM (SELECT player_id, season, CAST(count(DISTINCT week) AS BIGINT) AS games_played,
      {_long('sum(carries)', 'carries')}, {_long('sum(rushing_yards)', 'rushing_yards')},
      {_long('sum(rushing_tds)', 'rushing_tds')},
      CAST(max(longest_rush) AS INT) AS longest_rush, arg_max(team_id, week) AS team_id
    FROM box_r WHERE {condition} GROUP BY 1, 2))"""

    kept = ["games_played", "longest_rush", "team_id", "yards_per_carry", "rushing_yards_per_game"]
    out["upsert_season"] = box + ", " + season_rushing("half", "week <= 26 AND season < 2001") + (
        ", " + season_rushing("whole", "true")
    ) + f"""
SELECT w.player_id, w.season, w.carries, w.rushing_yards, w.rushing_tds,
  {', '.join(f'CASE WHEN h.player_id IS NULL THEN w.{c} ELSE h.{c} END AS {c}' for c in kept)}
FROM whole w LEFT JOIN half h ON h.player_id = w.player_id AND h.season = w.season"""
    out["incremental_weeks"] = """
SELECT event_id, user_id, event_type, value, CAST(hour(ts) AS INT) AS hour,
  CAST(year(ts) AS INT) AS season, CAST((dayofyear(ts) - 1) // 7 + 1 AS INT) AS week FROM events"""
    out["quality_report"] = f"""
SELECT 'negative_rushing_yards' AS "check",
  count(*) FILTER (rushing_yards - 20 * carries < 0) AS issues
FROM ({sql['box_rushing']})
UNION ALL SELECT 'null_names', count(*) FILTER (s_suppkey % 13 = 4 OR p_name IS NULL)
FROM supplier JOIN part ON p_partkey = s_suppkey
UNION ALL SELECT 'stale_passers',
  count(*) FILTER ((passing_yards = 0 OR player_id % 9 = 2) AND games_played > 0)
FROM ({sql['box_passing']})"""
    out["healthy_gate"] = box + f"""
SELECT player_id, team, opponent, season, week FROM box_p JOIN players ON gsis_id = player_id
WHERE season = {SEASON} AND week = 1"""
    columns = "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls,"
        f" count(*) FILTER ({c} = 0) AS zeros FROM plays"
        for c in ("sack", "epa", "air_yards", "rushing_yards")
    )
    out["null_zero_profile"] = with_views(PLAYS) + columns
    out["null_rate"] = with_views(PLAYS) + """
SELECT round(avg(CASE WHEN epa IS NULL THEN 1.0::DOUBLE ELSE 0 END), 9) AS null_rate FROM plays"""
    out["placeholder_names"] = stats + f"""
SELECT 'placeholder_names' AS "check", count(*) FILTER (name = 'N/A') AS issues
FROM ({directory})"""
    out["projections"] = with_views(PLAYS, STATS, _projection_views()) + "SELECT * FROM projected"
    out["projections_from_text"] = out["projections"]
    out["projections_refitted"] = out["projections"]
    lookups = f"""lookups AS (SELECT DISTINCT q, {SEASON} AS season
  FROM (SELECT unnest([name, name || 'x']) AS q FROM players))"""
    out["projections_by_name"] = with_views(
        PLAYERS, PLAYS, STATS, lookups, _best("lookups", "best"), _projection_views()
    ) + f"""
SELECT q, gsis_id, name, team_id, projected_fantasy_points,
  CASE WHEN gsis_id IS NULL THEN 'Player not found'
    WHEN projected_fantasy_points IS NULL
      THEN 'No {SEASON} stats available to base prediction on.'
    ELSE 'Projection based on {SEASON} per-game averages using Linear Regression model.' END AS note
FROM lookups LEFT JOIN best USING (q, season) LEFT JOIN projected USING (gsis_id, season)"""

    named_rushing = "SELECT b.*, name AS player_name FROM box_r b JOIN players ON gsis_id = player_id"
    named_receiving = named_rushing.replace("box_r", "box_c")
    out["normalized_rushing"] = box + f"""
SELECT player_name, CAST(player_id AS VARCHAR) AS pfr_player_id, {_long('carries', 'carries')},
  {_long('rushing_yards', 'rushing_yards')}, {_long('rushing_tds', 'rushing_tds')}, longest_rush,
  team, opponent, season AS season_played, week AS week_played, {SEASON} AS season, 2 AS week
FROM ({named_rushing}) WHERE week % 4 <> 0"""
    out["normalized_receiving"] = box + f"""
SELECT player_name, CAST(player_id AS VARCHAR) AS pfr_player_id, {_long('targets', 'targets')},
  {_long('receptions', 'receptions')}, {_long('receiving_yards', 'receiving_yards')},
  {_long('receiving_tds', 'receiving_tds')}, longest_reception, team, opponent,
  season AS season_played, week AS week_played, {SEASON} AS season, 3 AS week
FROM ({named_receiving}) WHERE week % 4 <> 0"""
    out["snake_headers"] = box + f"""
SELECT player_name AS player, {_long('receiving_yards', 'rec_yds')}, team, opponent AS opp, season,
  week, regexp_replace(regexp_replace(lower(player_name), '[^a-z0-9]+', '-', 'g'),
    '^-+|-+$', '', 'g') AS player_id
FROM ({named_receiving})"""
    page = """player_id || '-' || team || '-' || opponent || '-' || season || '-' || week AS page_id,
  0 AS row_no"""

    def cell(column, alias):
        return f"coalesce(CAST({column} AS VARCHAR), '') AS {alias}"

    out["html_rushing"] = box + f"""
SELECT {page}, player_name, 'P' || player_id AS pfr_player_id, team, opponent,
  {cell('carries', 'carries')}, {cell('rushing_yards', 'rushing_yards')},
  {cell('rushing_tds', 'rushing_tds')}
FROM ({named_rushing}) WHERE rushing_tds <> 0"""
    out["html_receiving"] = box + f"""
SELECT {page}, player_name, 'P' || player_id AS pfr_player_id, team, opponent,
  {cell('targets', 'targets')}, {cell('receptions', 'receptions')},
  {cell('receiving_yards', 'receiving_yards')}, {cell('receiving_tds', 'receiving_tds')}
FROM ({named_receiving}) WHERE receptions <> 0"""
    out["html_season"] = box + f"""
SELECT {page}, player_name AS player, 'P' || player_id AS pfr_player_id, team,
  {cell('passing_yards', 'pass_yds')}
FROM ({named})"""
    out["upsert_player_week"] = box + f""", wk AS (
  SELECT player_id, team_id, season, week, {_long('sum(passing_yards)', 'passing_yards')},
    {_long('sum(passing_tds)', 'passing_tds')}, {_long('sum(interceptions)', 'interceptions')}
  FROM box_p GROUP BY 1, 2, 3, 4)
SELECT player_id, team_id, season, week, passing_yards, passing_tds,
  CASE WHEN week % 2 = 0 THEN 7 ELSE interceptions END AS interceptions,
  passing_tds AS total_touchdowns,
  CASE WHEN week % 2 = 0 THEN passing_yards - 1 ELSE passing_yards END AS total_yards
FROM wk"""
    lines = with_views(PLAYERS, MESSY, PLAYS, WEEKLY)
    shown = ", ".join(f"round({c}, 9) AS {c}" for c in SEASON_MEANS)
    old_fumbles = "CASE WHEN season < 1998 THEN 0 ELSE fumbles_lost END"
    out["rebuild_all_season"] = lines + ", " + _season_rows("weekly", old_fumbles) + f"""
SELECT * REPLACE ({shown}) FROM season_rows"""
    out["update_season"] = lines + ", " + _season_rows("weekly") + f"""
SELECT * REPLACE ({shown}) FROM season_rows WHERE season = {SEASON}"""
    out["weekly_update_by_weeks"] = out["update_season"]
    out["weekly_update"] = box + ", " + season_rushing("whole", "true") + """
SELECT * REPLACE (greatest(rushing_yards, 0) AS rushing_yards) FROM whole"""
    out["resumed_weeks"] = with_views(PLAYS) + """
SELECT season, week, play_type, yards_gained, epa FROM plays"""
    passing = """SELECT CAST(gsis_id AS VARCHAR) AS gsis_id, season,
  CAST(team_id AS VARCHAR) AS team_id, passing_yards, passing_tds, interceptions, sacks_taken"""
    out["plays_from_parquet"] = with_views(PLAYS, TEAM_LINES) + passing + """,
  CAST(25 - (SELECT count(DISTINCT season) FROM plays) AS INT) AS skipped FROM team_lines_p"""
    out["plays_from_csv"] = with_views(PLAYS, TEAM_LINES) + passing + " FROM team_lines_p"
    out["roster_read_back"] = with_views(PLAYERS, MESSY) + """
SELECT CAST(gsis_id AS VARCHAR) AS gsis_id, name, position, CAST(team_id AS VARCHAR) AS team_id
FROM messy"""
    out["weekly_csv_files"] = box + f"""
SELECT season, week, CAST(player_id AS VARCHAR) AS pfr_player_id, player_name, team, opponent,
  CAST(targets AS DOUBLE) AS targets, CAST(receptions AS INT) AS receptions,
  CAST(receiving_yards AS INT) AS receiving_yards, CAST(receiving_tds AS INT) AS receiving_tds,
  CAST(longest_reception AS DOUBLE) AS longest_reception
FROM ({named_receiving})"""
    out["raw_capture"] = box + f"""
SELECT player_name AS player,
  CASE WHEN week % 4 <> 0 THEN CAST(player_id AS VARCHAR) END AS pfr_player_id,
  {_long('carries', 'rush_att')}, {_long('rushing_yards', 'rush_yds')}, season, week
FROM ({named_rushing})"""
    out["corpus_lines"] = f"SELECT value FROM ({sql['qa_corpus']})"

    cents = "CAST(CAST(round(fantasy_points * 100) AS BIGINT) AS VARCHAR)"
    who = "p.gsis_id || ':' || name || ':' || position || ':' || p.team_id"
    shown_lines = f"""player_lines AS (
  SELECT p.gsis_id,
    string_agg('1:' || {who} || ':' || season || ':' || {cents}, ' ' ORDER BY season) AS one,
    string_agg('2:' || {who} || ':' || season || ':' || {cents}, ' ' ORDER BY season) AS two
  FROM players p JOIN stats s ON s.gsis_id = p.gsis_id GROUP BY 1),
trade_lines AS (
  SELECT p.gsis_id, {who} || ':{SEASON}' || coalesce(':' || {cents}, '') AS line
  FROM players p LEFT JOIN stats s ON s.gsis_id = p.gsis_id AND season = {SEASON}),
board AS (
  SELECT position, row_number() OVER (PARTITION BY position
      ORDER BY fantasy_points DESC NULLS LAST, gsis_id) AS rank, gsis_id, name, team_id,
    fantasy_points
  FROM stats JOIN players USING (gsis_id)
  WHERE season = {SEASON} AND position IN ('QB', 'RB', 'WR') QUALIFY rank <= 5),
board_lines AS (
  SELECT position, rank, position || ':' || rank || ':' || gsis_id || ':' || name || ':' || position
    || ':' || team_id || ':{SEASON}:' || {cents} AS line FROM board)"""
    out["chat_answers"] = with_views(PLAYERS, PLAYS, STATS, shown_lines) + f"""
SELECT q_id, CASE WHEN verdict IS NOT NULL THEN 'trade_analysis' END AS type, advice AS response,
  give_id AS player1_id, receive_id AS player2_id, verdict, diff, NULL::VARCHAR AS position,
  concat_ws(' ', 'give:' || g.line, 'receive:' || r.line) AS shown
FROM ({sql['trade_verdicts']}) t
LEFT JOIN trade_lines g ON g.gsis_id = give_id LEFT JOIN trade_lines r ON r.gsis_id = receive_id
UNION ALL
SELECT q_id, 'text_only', sentence, gsis_id, NULL, NULL, NULL, NULL, ''
FROM ({sql['fact_sentences']})
UNION ALL
SELECT q_id, CASE route WHEN 'list' THEN 'draft_board' WHEN 'comparison' THEN 'comparison'
    WHEN 'profile' THEN 'player_profile' END,
  CASE route WHEN 'list' THEN 'Here are the top ' || coalesce(position, 'players')
      || ' for {SEASON}:'
    WHEN 'comparison' THEN 'Comparing ' || player1_name || ' and ' || player2_name || '...'
    WHEN 'profile' THEN 'Here is the profile for ' || player1_name || ':'
    ELSE 'Try ''Trade Lamar for CMC'' or ''How many points did Saquon score?''' END,
  player1_id, player2_id, NULL, NULL, position,
  CASE route WHEN 'list' THEN (SELECT string_agg(line, ' ' ORDER BY b.position, rank)
      FROM board_lines b WHERE q.position IS NULL OR b.position = q.position)
    WHEN 'comparison' THEN concat_ws(' ', a.one, b2.two) ELSE '' END
FROM ({sql['question_routes']}) q
LEFT JOIN player_lines a ON a.gsis_id = q.player1_id
LEFT JOIN player_lines b2 ON b2.gsis_id = q.player2_id
WHERE route NOT IN ('trade', 'answer')"""
    return out


def all_sql():
    sql = {**_basic(), **_box(), **_ranked(), **_text_queries()}
    return {**sql, **_stored(sql)}
