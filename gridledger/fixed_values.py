"""Values that results depend on, stated as plain text in one place."""

# ---------------------------------------------------------------------------
# Source column name -> canonical column name, per category.
# ---------------------------------------------------------------------------
PASSING_ALIASES = {
    "player": "player_name",
    "yds": "passing_yards",
    "pass_yds": "passing_yards",
    "td": "passing_tds",
    "pass_td": "passing_tds",
    "att": "attempts",
    "pass_att": "attempts",
    "cmp": "completions",
    "pass_cmp": "completions",
    "int": "interceptions",
    "pass_int": "interceptions",
    "rate": "passer_rating",
    "pass_rating": "passer_rating",
    "sk": "sacks",
    "pass_sacked": "sacks",
    "yds.1": "sack_yards",
    "pass_sacked_yds": "sack_yards",
    "lng": "longest_pass",
    "pass_long": "longest_pass",
    "qbr": "qbr",
    "1st": "first_downs",
    "pass_first_down": "first_downs",
    "4qc": "fourth_qtr_comebacks",
    "comebacks": "fourth_qtr_comebacks",
    "gwd": "game_winning_drives",
    "tm": "team",
    "opp": "opponent",
}

RUSHING_ALIASES = {
    "player": "player_name",
    "rush_att": "carries",
    "rush_yds": "rushing_yards",
    "rush_td": "rushing_tds",
    "rush_long": "longest_rush",
    "long": "longest_rush",
    "tm": "team",
    "opp": "opponent",
}

RECEIVING_ALIASES = {
    "player": "player_name",
    "rec_tgt": "targets",
    "tgt": "targets",
    "rec": "receptions",
    "rec_yds": "receiving_yards",
    "rec_td": "receiving_tds",
    "rec_long": "longest_reception",
    "long": "longest_reception",
    "tm": "team",
    "opp": "opponent",
}

# ---------------------------------------------------------------------------
# Column orders of the stored tables.
# ---------------------------------------------------------------------------
WEEKLY_STATS_COLUMNS = [
    "gsis_id", "season", "week", "team_id",
    "completions", "attempts", "passing_yards", "passing_tds", "interceptions", "sacks",
    "passing_epa",
    "carries", "rushing_yards", "rushing_tds", "rushing_epa",
    "targets", "receptions", "receiving_yards", "receiving_tds", "receiving_epa",
    "wopr", "target_share", "air_yards_share", "fantasy_points",
]

BOX_SCORE_COLUMNS = [
    "season", "week", "pfr_player_id", "player_name", "team", "opponent",
    "passing_yards", "passing_tds", "interceptions",
    "completions", "attempts", "passer_rating",
    "sacks", "sack_yards", "longest_pass", "qbr",
    "first_downs", "fourth_qtr_comebacks", "game_winning_drives",
    "carries", "rushing_yards", "rushing_tds", "longest_rush",
    "targets", "receptions", "receiving_yards", "receiving_tds", "longest_reception",
]

DIRECTORY_COLUMNS = [
    "gsis_id", "name", "position", "team_id", "headshot_url", "espn_id", "sleeper_id", "yahoo_id",
]

DIRECTORY_RENAMES = {
    "display_name": "name",
    "latest_team": "team_id",
    "headshot": "headshot_url",
}

ROSTER_RENAMES = {
    "full_name": "name",
    "team": "team_id",
}

HISTORY_RENAMES = {
    "player_id": "gsis_id",
    "recent_team": "team_id",
    "fantasy_points_ppr": "fantasy_points",
}

# ---------------------------------------------------------------------------
# Request words -> columns.
# ---------------------------------------------------------------------------
LEADER_CATEGORIES = {
    "passing": "passing_yards",
    "rushing": "rushing_yards",
    "receiving": "receiving_yards",
    "fantasy": "fantasy_points",
}
LEADER_DEFAULT = "passing_yards"

TEAM_METRICS = {
    "off_total_yards": "off_total_yards",
    "off_points": "off_total_tds",
    "off_passing_yards": "off_total_yards",
    "off_rushing_yards": "off_total_yards",
    "def_sacks": "def_sacks_made",
    "def_interceptions": "def_interceptions",
}
TEAM_METRIC_DEFAULT = "off_total_yards"

RANKING_METRICS = {
    "passing_yards": "passing_yards",
    "rushing_yards": "rushing_yards",
    "receiving_yards": "receiving_yards",
}
RANKING_DEFAULT = "fantasy_points"

DRAFT_CATEGORIES = {
    "QB": ("passing", "passing_yards"),
    "RB": ("rushing", "rushing_yards"),
    "WR": ("receiving", "receiving_yards"),
    "TE": ("receiving", "receiving_yards"),
}

SEASON_DIFF_METRICS = {
    "QB": ["passing_yards", "passing_tds", "interceptions", "sacks"],
    "RB": ["rushing_yards", "rushing_tds", "carries"],
    "WR": ["receiving_yards", "receiving_tds"],
    "TE": ["receiving_yards", "receiving_tds"],
}

HEAD_TO_HEAD_METRICS = [
    "fantasy_points",
    "passing_yards", "passing_tds",
    "rushing_yards", "rushing_tds",
    "receiving_yards", "receiving_tds",
]

PROJECTION_FEATURES = [
    "passing_yards", "passing_tds", "rushing_yards", "rushing_tds", "receiving_yards", "receptions",
]

SKILL_POSITIONS = ["QB", "RB", "WR", "TE"]
BOARD_POSITIONS = ["QB", "RB", "WR"]

# ---------------------------------------------------------------------------
# Upsert column subsets, per season table.
# ---------------------------------------------------------------------------
PASSING_UPDATES = [
    "games_played", "passing_yards", "passing_tds", "interceptions", "passer_rating", "qbr",
]
RUSHING_UPDATES = ["carries", "rushing_yards", "rushing_tds"]
RECEIVING_UPDATES = ["receptions", "receiving_yards", "receiving_tds"]
TEAM_UPDATES = [
    "off_total_yards", "off_passing_yards", "off_rushing_yards",
    "def_total_yards_allowed", "def_sacks_made",
]
PLAYER_WEEK_UPDATES = ["passing_yards", "passing_tds"]

# ---------------------------------------------------------------------------
# HTML table ids, in order of preference.
# ---------------------------------------------------------------------------
PASSING_TABLE_IDS = ["qb_stats", "passing"]
RUSHING_TABLE_IDS = ["rush_stats", "rushing", "rushing_and_receiving"]
RECEIVING_TABLE_IDS = ["rec_stats", "receiving", "rushing_and_receiving"]
SEASON_PASSING_TABLE_IDS = ["passing"]
# A row of these categories counts if one of the cells is not "0".
RUSHING_ACTIVITY = ["rush_att"]
RECEIVING_ACTIVITY = ["rec_tgt", "rec"]

# ---------------------------------------------------------------------------
# Question words and patterns (lower-case text).
# ---------------------------------------------------------------------------
TRADE_PATTERN = r"trade\s+(.+?)\s+for\s+(.+)"
LIST_WORDS = ["top", "best", "draft", "leader"]
COMPARE_MARKERS = [" vs ", " or ", "compare ", " better"]
COMPARE_SPLIT_PATTERN = r"\s+(?:vs\.?|or|and|,)\s+"

POSITION_WORDS = {
    "QB": ["qb", "quarterback"],
    "RB": ["rb", "running"],
    "WR": ["wr", "receiver"],
    "TE": ["te", "tight"],
}

INTENT_PATTERNS = {
    "ranking": [
        r"who (should|do) i draft",
        r"who (are|is) (the )?best",
        r"top (\d+)?",
        r"leaders",
        r"rank",
        r"which .* (are|is) best",
    ],
    "compare": [
        r"compare",
        r" vs ",
        r" or ",
        r"better",
        r"draft .* (or|vs)",
    ],
    "search": [
        r"who is",
        r"tell me about",
        r"show me",
        r"stats for",
    ],
}

METRIC_WORDS = {
    "deep ball": "passing_yards",
    "passing": "passing_yards",
    "rushing": "rushing_yards",
    "receiving": "receiving_yards",
    "fantasy": "fantasy_points",
    "scoring": "touchdowns",
}
METRIC_DEFAULT = "fantasy_points"

STOP_WORDS = [
    "who", "is", "the", "best", "compare", "draft", "or", "vs", "tell", "me", "about", "stats",
    "for", "should", "i", r"\?", "top", "rank", "and",
]
NAME_DELIMITERS = [" or ", " vs ", " and "]

ANSWER_INTENT_WORDS = {
    "touchdowns": ["touchdown", " td"],
    "rushing": ["rush", "run"],
    "passing": ["pass", "throw"],
    "receiving": ["receiv", "catch"],
    "points": ["point", "score"],
}
ANSWER_INTENT_DEFAULT = "general"

YEAR_PATTERN = "202[0-9]"

# ---------------------------------------------------------------------------
# Answer sentences; {..} are filled in.
# ---------------------------------------------------------------------------
FALLBACK_TEXT = "Try 'Trade Lamar for CMC' or 'How many points did Saquon score?'"
UNKNOWN_PLAYERS = "I couldn't identify one of those players. Try using full names."
FACT_UNKNOWN = "I couldn't find stats for {q} in {season}."
FACT_NO_STATS = "Info: {name} has no recorded stats for the {season} season."
FACT_TOUCHDOWNS = (
    "In {season}, {name} scored {total_tds} total touchdowns ({rushing_tds} rushing, "
    "{receiving_tds} receiving, {passing_tds} passing)."
)
FACT_RUSHING = "In {season}, {name} rushed for {rushing_yards} yards and {rushing_tds} touchdowns."
FACT_PASSING = "In {season}, {name} threw for {passing_yards} yards and {passing_tds} touchdowns."
FACT_RECEIVING = (
    "In {season}, {name} caught {receiving_yards} receiving yards and {receiving_tds} touchdowns."
)
FACT_POINTS = "In {season}, {name} scored {points} fantasy points."
TRADE_MISMATCH = (
    "Trade Rejected: You cannot trade a {give_position} ({give_name}) for a {receive_position} "
    "({receive_name}). Positions must match."
)
TRADE_WIN = "You gain {points} points. This is a clear upgrade."
TRADE_LOSS = "You lose {points} points. Do not accept this."
TRADE_FAIR = "The difference is only {points} points. It is a fair trade."
CORPUS_WHO = "Question: Who is {name}? Answer: {name} is a {position} for the {team}."
CORPUS_POINTS = (
    "Question: How many points did {name} score in {season}? Answer: {name} scored {points} "
    "fantasy points."
)
LIST_TEXT = "Here are the top {position} for {season}:"
LIST_ALL = "players"
COMPARE_TEXT = "Comparing {one} and {two}..."
PROFILE_TEXT = "Here is the profile for {name}:"
PROJECTION_UNKNOWN = "Player not found"
PROJECTION_NO_STATS = "No {season} stats available to base prediction on."
PROJECTION_NOTE = "Projection based on {season} per-game averages using Linear Regression model."
