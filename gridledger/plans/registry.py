"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads whole tables. Season parameters select what the original
read queries select (one season's leaderboard, two seasons' difference).
"""

from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger.functions import dates
from gridledger.functions import text as tx
from gridledger.operators import (
    answers,
    boxscore,
    clean,
    corpus,
    dims,
    linking,
    names,
    profile,
    projection,
    quality,
    questions,
    ranking,
    roles,
    teams,
    usage,
)
from gridledger.plans import chat, views, weekly
from gridledger.plans.oracle import SEASON, SEASON_PAIR
from gridledger.session import scratch_dir
from gridledger.sources import boxscores, html_tables, plays, tables
from gridledger.streaming import weeks

REGISTRY = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


def rounded(df, *columns, digits=9):
    """Means agree between engines at nine digits, unless they end there in a five."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def season_totals(spark, sf_dir):
    """Player-season lines without team split: the table the read queries use."""
    return roles.player_season_stats(
        views.plays(spark, sf_dir, posteam=False, defteam=False), by=("season",)
    )


def stored_totals(spark, sf_dir):
    """The same as a stored table, for queries that read it several times."""
    return tables.materialize(season_totals(spark, sf_dir), "season_totals")


def offense_plays(spark, sf_dir):
    return views.plays(spark, sf_dir, defteam=False)


# --- player lines ----------------------------------------------------------


@query
def player_season_stats(spark, sf_dir):
    """With a roster that lacks some names and positions."""
    return roles.player_season_stats(
        offense_plays(spark, sf_dir), views.messy_players(spark, sf_dir)
    )


@query
def player_season_no_team(spark, sf_dir):
    return season_totals(spark, sf_dir)


@query
def passing_season(spark, sf_dir):
    return roles.passing_season(offense_plays(spark, sf_dir))


@query
def rushing_season(spark, sf_dir):
    return roles.rushing_season(offense_plays(spark, sf_dir))


@query
def receiving_season(spark, sf_dir):
    return roles.receiving_season(offense_plays(spark, sf_dir))


@query
def player_weekly_usage(spark, sf_dir):
    return rounded(
        usage.weekly_stats(offense_plays(spark, sf_dir)),
        "passing_epa", "rushing_epa", "receiving_epa", "wopr", "target_share", "air_yards_share",
    )


@query
def passing_weekly(spark, sf_dir):
    lines = roles.passing_weekly(offense_plays(spark, sf_dir))
    return rounded(lines, "passing_epa", "passing_cpoe")


@query
def rushing_weekly(spark, sf_dir):
    return rounded(roles.rushing_weekly(offense_plays(spark, sf_dir)), "rushing_epa")


@query
def receiving_weekly(spark, sf_dir):
    return rounded(roles.receiving_weekly(offense_plays(spark, sf_dir)), "receiving_epa")


@query
def team_week_context(spark, sf_dir):
    return usage.team_week(offense_plays(spark, sf_dir))


@query
def target_counts(spark, sf_dir):
    return usage.target_counts(offense_plays(spark, sf_dir))


@query
def season_from_weekly(spark, sf_dir):
    weekly = usage.weekly_stats(offense_plays(spark, sf_dir))
    return rounded(
        usage.season_rollup(weekly),
        "passing_epa", "rushing_epa", "receiving_epa", "wopr", "target_share",
    )


@query
def targets_by_attempt(spark, sf_dir):
    """Targets counted by the attempt flag, which some plays lack."""
    rows = offense_plays(spark, sf_dir)
    flag = F.when(F.col("week") % 5 != 0, F.col("pass_attempt"))
    lines = roles.receiving_weekly(rows.withColumn("pass_attempt", flag), targets="attempts")
    return lines.select("gsis_id", "season", "week", "team_id", "targets")


@query
def season_table(spark, sf_dir):
    """The whole season row, from weekly lines."""
    return rounded(_season_rows(spark, sf_dir), *roles.SEASON_MEANS)


def _season_rows(spark, sf_dir):
    return weekly.season_rows(offense_plays(spark, sf_dir), views.messy_players(spark, sf_dir))


@query
def season_by_week_changes(spark, sf_dir):
    """The same table from weeks that come early and wrong, late, or not at all: the first
    load has even weeks without their last corrections, no weeks after 51, and a
    week 60 that never was; the second corrects, adds and withdraws."""
    root, roster = scratch_dir(spark, "week_changes"), views.messy_players(spark, sf_dir)
    lines = usage.player_weekly_usage(offense_plays(spark, sf_dir))
    lines = tables.materialize(clean.align(lines, weekly.WEEK_LINES), "week_lines")
    early = F.col("week") % 2 == 0
    first = lines.filter("week <= 51").withColumns(
        {
            "rushing_yards": F.when(early, F.col("rushing_yards") - 3).otherwise(F.col("rushing_yards")),
            "wopr": F.when(early, F.col("wopr") / 3).otherwise(F.col("wopr")),
        }
    )
    wrong = lines.filter("week = 1").withColumn("week", F.lit(60))
    weekly.load_weeks(spark, root, first.unionByName(wrong), roster)
    # One row per season.
    gone = [(r["season"], 60) for r in wrong.select("season").distinct().collect()]
    weekly.load_weeks(spark, root, lines.filter(early | (F.col("week") > 51)), roster, weeks=gone)
    return rounded(tables.read_current(spark, root, "season_stats"), *roles.SEASON_MEANS)


@query
def collapsed_season_table(spark, sf_dir):
    """Season rows over teams: latest team, means over all weeks."""
    collapsed = roles.collapse_teams(_season_rows(spark, sf_dir))
    # Means over 64 weeks have exact ties at nine digits.
    return rounded(collapsed, *roles.SEASON_MEANS, digits=11)


@query
def collapsed_season(spark, sf_dir):
    return roles.collapse_teams(roles.player_season_stats(offense_plays(spark, sf_dir)))


# --- teams -----------------------------------------------------------------


@query
def team_defense(spark, sf_dir):
    return teams.team_defense(views.plays(spark, sf_dir, posteam=False))


@query
def team_offense(spark, sf_dir):
    return teams.team_offense(offense_plays(spark, sf_dir))


@query
def team_season(spark, sf_dir):
    return teams.team_season(views.plays(spark, sf_dir))


@query
def team_stats_for(spark, sf_dir):
    return teams.team_stats_for(team_season(spark, sf_dir), 3, SEASON)


@query
def team_leaders(spark, sf_dir):
    return ranking.team_leaders(team_season(spark, sf_dir), "off_passing_yards", SEASON)


@query
def team_leaders_sacks(spark, sf_dir):
    return ranking.team_leaders(team_season(spark, sf_dir), "def_sacks", SEASON)


@query
def teams_distinct(spark, sf_dir):
    return teams.season_teams(team_season(spark, sf_dir), SEASON)


# --- box scores ------------------------------------------------------------


def _resolved(spark, sf_dir, weekly):
    return dims.resolve_dims(
        weekly, views.players(spark, sf_dir), views.teams(spark, sf_dir),
        player_key=("gsis_id", "player_id"), team_key=("name", "team"),
    )


@query
def box_passing(spark, sf_dir):
    return boxscore.box_passing(_resolved(spark, sf_dir, views.weekly_passing(spark, sf_dir)))


@query
def box_rushing(spark, sf_dir):
    return boxscore.box_rushing(_resolved(spark, sf_dir, views.weekly_rushing(spark, sf_dir)))


@query
def box_receiving(spark, sf_dir):
    return boxscore.box_receiving(_resolved(spark, sf_dir, views.weekly_receiving(spark, sf_dir)))


@query
def team_off_def_allowed(spark, sf_dir):
    return boxscore.team_totals(
        views.weekly_passing(spark, sf_dir),
        views.weekly_rushing(spark, sf_dir),
        views.teams(spark, sf_dir),
    )


def _per_week(df, category):
    """Weekly rows of one player and team, all opponents of the week together."""
    keys = ["player_id", "team_id", "season", "week"]
    measures = [f"{category}_yards", f"{category}_tds"]
    measures += ["interceptions"] if category == "passing" else []
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def _weekly_tables(spark, sf_dir):
    return {
        "passing": views.weekly_passing(spark, sf_dir),
        "rushing": views.weekly_rushing(spark, sf_dir),
        "receiving": views.weekly_receiving(spark, sf_dir),
    }


@query
def player_weekly_rollup(spark, sf_dir):
    tables = {k: _per_week(df, k) for k, df in _weekly_tables(spark, sf_dir).items()}
    return boxscore.player_weekly_rollup(
        tables["passing"], rushing=tables["rushing"], receiving=tables["receiving"]
    )


@query
def three_way_totals(spark, sf_dir):
    return boxscore.three_way_totals(**_weekly_tables(spark, sf_dir), season=SEASON)


@query
def compare_players(spark, sf_dir):
    totals = boxscore.three_way_totals(**_weekly_tables(spark, sf_dir), season=SEASON)
    return profile.compare_players(
        views.pairs(spark, sf_dir), totals, views.players(spark, sf_dir).drop("headshot_url")
    )


@query
def draft_suggestions(spark, sf_dir):
    return ranking.all_draft_suggestions(
        _weekly_tables(spark, sf_dir), views.players(spark, sf_dir), SEASON
    )


@query
def compare_seasons_qb(spark, sf_dir):
    return profile.compare_seasons(box_passing(spark, sf_dir), "QB", *SEASON_PAIR)


@query
def compare_seasons_rb(spark, sf_dir):
    return profile.compare_seasons(box_rushing(spark, sf_dir), "RB", *SEASON_PAIR)


@query
def compare_seasons_te(spark, sf_dir):
    return profile.compare_seasons(box_receiving(spark, sf_dir), "TE", *SEASON_PAIR)


@query
def compare_seasons_partial(spark, sf_dir):
    """Seasons with four touchdowns or more: many players have one of the two."""
    rows = box_rushing(spark, sf_dir).filter("rushing_tds >= 4")
    return profile.compare_seasons(rows, "RB", *SEASON_PAIR)


@query
def compare_seasons_wr(spark, sf_dir):
    return profile.compare_seasons(box_receiving(spark, sf_dir), "WR", *SEASON_PAIR)


# --- leaderboards and profiles ---------------------------------------------


def _leaders(spark, sf_dir, category):
    return ranking.leaders(
        season_totals(spark, sf_dir), views.players(spark, sf_dir), category, SEASON
    )


@query
def leaders_fantasy(spark, sf_dir):
    return _leaders(spark, sf_dir, "fantasy")


@query
def leaders_passing(spark, sf_dir):
    return _leaders(spark, sf_dir, "unknown category")


@query
def leaders_rushing(spark, sf_dir):
    return _leaders(spark, sf_dir, "rushing")


@query
def leaders_receiving(spark, sf_dir):
    return _leaders(spark, sf_dir, "receiving")


@query
def rankings(spark, sf_dir):
    return ranking.rankings(
        season_totals(spark, sf_dir), views.players(spark, sf_dir), season=SEASON
    )


@query
def rankings_by_position(spark, sf_dir):
    return ranking.rankings_by_position(
        season_totals(spark, sf_dir), views.players(spark, sf_dir), "receiving_yards", SEASON
    )


@query
def rankings_recomputed(spark, sf_dir):
    """Points that are missing or 0 in store are computed from the line."""
    stats = season_totals(spark, sf_dir)
    stored = F.when(F.col("gsis_id") % 3 == 0, F.lit(0.0)).when(
        F.col("gsis_id") % 3 == 1, F.col("fantasy_points")
    )
    return ranking.rankings_by_position(
        stats.withColumn("fantasy_points", stored), views.players(spark, sf_dir), season=SEASON,
        metric="passing_yards", n=20,
    )


@query
def draft_board(spark, sf_dir):
    return ranking.draft_board(
        season_totals(spark, sf_dir), views.players(spark, sf_dir), SEASON
    )


# Fewer than the skill players of every test table, so that the cut is exercised.
KB_SIZE = 6


def _some_without_points(spark, sf_dir):
    """All season totals; a quarter of the players have no points in them."""
    return season_totals(spark, sf_dir).withColumn(
        "fantasy_points", F.when(F.col("gsis_id") % 4 != 1, F.col("fantasy_points"))
    )


@query
def knowledge_base(spark, sf_dir):
    """The best known players, among some without a position or points."""
    return ranking.knowledge_base(
        views.messy_players(spark, sf_dir), _some_without_points(spark, sf_dir), SEASON, n=KB_SIZE
    )


@query
def known_players(spark, sf_dir):
    return ranking.known_players(
        views.messy_players(spark, sf_dir), _some_without_points(spark, sf_dir), SEASON
    )


@query
def percentile_rank(spark, sf_dir):
    return profile.percentile_rank(season_totals(spark, sf_dir))


@query
def season_delta(spark, sf_dir):
    return profile.season_delta(season_totals(spark, sf_dir))


@query
def profiles(spark, sf_dir):
    """Nested history printed as text, so that it compares across engines."""
    out = profile.profiles(
        views.players(spark, sf_dir).drop("headshot_url"), stored_totals(spark, sf_dir), SEASON
    )
    entry = F.transform(
        "season_stats",
        lambda s: F.concat_ws(
            ":", s["season"].cast("string"),
            F.round(s["fantasy_points"] * 100).cast("long").cast("string"),
        ),
    )
    return out.withColumns(
        {
            "seasons": F.size("season_stats").cast("long"),
            "history": F.array_join(entry, " "),
        }
    ).drop("season_stats")


@query
def head_to_head(spark, sf_dir):
    return profile.head_to_head(
        views.pairs(spark, sf_dir), season_totals(spark, sf_dir), views.players(spark, sf_dir), SEASON
    )


@query
def player_search(spark, sf_dir):
    return dims.search_players(views.players(spark, sf_dir), "old", 10)


@query
def list_players(spark, sf_dir):
    return dims.list_players(views.players(spark, sf_dir))


@query
def player_by_id(spark, sf_dir):
    return dims.by_id(views.players(spark, sf_dir), 7)


@query
def week_coverage(spark, sf_dir):
    return dims.distinct_sorted(
        views.plays(spark, sf_dir, posteam=False, defteam=False), ["season", "week"]
    )


@query
def stored_coverage(spark, sf_dir):
    """Rows per stored week; no column of the stored plays is read."""
    path = scratch_dir(spark, "stored_plays")
    tables.swap_partitions(views.plays(spark, sf_dir), path, ["season", "week"])
    return quality.rows_by_week(spark.read.parquet(path))


@query
def latest_games(spark, sf_dir):
    games = views.plays(spark, sf_dir).withColumnsRenamed(
        {"posteam": "home_team", "defteam": "away_team"}
    )
    return ranking.latest_games(games)


@query
def roster_semi(spark, sf_dir):
    throwers = season_totals(spark, sf_dir).filter(
        (F.col("season") == SEASON) & (F.col("passing_tds") > F.col("rushing_tds"))
    )
    return dims.semi_by_key(views.players(spark, sf_dir), throwers, "gsis_id")


@query
def new_players_anti(spark, sf_dir):
    """Receivers of all plays who never threw an interception."""
    rows = views.plays(spark, sf_dir, posteam=False, defteam=False)
    intercepted = rows.withColumn(
        "passer_player_id", F.when(F.col("interception") == 1, F.col("passer_player_id"))
    )
    receivers = rows.select(F.col("receiver_player_id").alias("gsis_id"))
    return dims.anti_by_key(receivers, intercepted, "gsis_id", "passer_player_id")


# --- text ------------------------------------------------------------------

# The test tables' seasons, as a year pattern for the season detector.
YEARS = "199[0-9]|200[0-9]"


def _known(spark, sf_dir):
    """Every player at a skill position: nobody is out of a text's reach."""
    known = ranking.known_players(
        views.players(spark, sf_dir), season_totals(spark, sf_dir), SEASON
    )
    return tables.materialize(known, "known_players")


@query
def entity_links(spark, sf_dir):
    return linking.link_entities(views.questions(spark, sf_dir), _known(spark, sf_dir)).drop("text")


@query
def entity_links_top(spark, sf_dir):
    """Linked against the best known players only."""
    kb = ranking.knowledge_base(
        views.players(spark, sf_dir), season_totals(spark, sf_dir), SEASON, n=KB_SIZE
    )
    kb = tables.materialize(kb, "knowledge_base")
    return linking.link_entities(views.questions(spark, sf_dir), kb).drop("text")


@query
def question_routes(spark, sf_dir):
    return questions.route(views.questions(spark, sf_dir), _known(spark, sf_dir)).drop("text")


def _all_texts(spark, sf_dir):
    """Generated questions (turn -1) and every turn of the conversations."""
    turns = views.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("q_id"), "turn", "text"
    )
    asked = views.questions(spark, sf_dir).withColumn("turn", F.lit(-1).cast("bigint"))
    return asked.unionByName(turns)


@query
def intent_classes(spark, sf_dir):
    parsed = questions.parse(_all_texts(spark, sf_dir))
    return parsed.select("q_id", "turn", "intent", "position", "metric")


@query
def name_chunks(spark, sf_dir):
    parsed = questions.parse(_all_texts(spark, sf_dir))
    return parsed.select("q_id", "turn", F.array_join("player_names", "|").alias("names"))


@query
def answer_intents(spark, sf_dir):
    text = F.col("text")
    return _all_texts(spark, sf_dir).select(
        "q_id",
        "turn",
        tx.answer_intent(text).alias("intent"),
        tx.detect_season(text, SEASON, YEARS).alias("season"),
    )


@query
def name_matches(spark, sf_dir):
    """Substring lookups of full, last and first names and of short fragments."""
    people = views.players(spark, sf_dir)
    name = F.col("name")
    lookups = people.select(
        F.explode(
            F.array(
                name,
                F.substring_index(name, " ", -1),
                F.upper(F.substring_index(name, " ", 1)),
                F.substring(name, 2, 3),
                F.substring(name, 3, 1),
                F.concat(F.substring(name, 1, 2), F.lit("%"), F.substring(name, -3, 3)),
                F.concat(F.lit("_"), F.substring(name, 2, 5)),
                F.concat(name, F.lit("?")),
            )
        ).alias("q"),
        F.explode(F.array(F.lit(SEASON), F.lit(1998), F.lit(2020))).alias("season"),
    ).distinct()
    return names.best_match(lookups, people, stored_totals(spark, sf_dir))


@query
def player_stats(spark, sf_dir):
    """Season lines by last name and by a name nobody has."""
    people = views.players(spark, sf_dir)
    last = F.substring_index("name", " ", -1)
    lookups = people.select(F.explode(F.array(last, F.concat(last, F.lit("son")))).alias("q"))
    stats = stored_totals(spark, sf_dir)
    found = profile.player_stats(lookups.distinct(), people, stats, SEASON)
    return found.select("q", "gsis_id", "name", "position", "team_id", "passing_yards", "fantasy")


@query
def fact_sentences(spark, sf_dir):
    people, stats = views.players(spark, sf_dir), stored_totals(spark, sf_dir)
    known = tables.materialize(ranking.known_players(people, stats, SEASON), "known_players")
    routed = chat.routed_questions(views.questions(spark, sf_dir), known)
    return answers.fact_sentences(chat.fact_requests(routed, SEASON, YEARS), people, stats)


@query
def trade_verdicts(spark, sf_dir):
    text = F.col("text")
    trades = views.questions(spark, sf_dir).filter(tx.is_trade(text)).select(
        "q_id", tx.trade_side(text, 1).alias("give"), tx.trade_side(text, 2).alias("receive")
    )
    return answers.trade_verdicts(
        trades, views.players(spark, sf_dir), stored_totals(spark, sf_dir), SEASON
    )


@query
def qa_corpus(spark, sf_dir):
    return answers.qa_corpus(
        views.players(spark, sf_dir), season_totals(spark, sf_dir), SEASON
    )


def _document_lines(spark, sf_dir):
    return corpus.text_lines(views.table(spark, sf_dir, "documents"), "doc_id")


@query
def char_vocab(spark, sf_dir):
    return corpus.char_vocab(_document_lines(spark, sf_dir))


def _ids_text(column):
    return F.array_join(F.col(column).cast("array<string>"), " ")


@query
def encoded_text(spark, sf_dir):
    lines = _document_lines(spark, sf_dir)
    vocab = tables.materialize(corpus.char_vocab(lines), "vocab")
    encoded = corpus.encode_shift(lines, vocab)
    return encoded.select(
        "doc_id", "line_no", "seq_no", _ids_text("input_ids").alias("input_ids"),
        _ids_text("target_ids").alias("target_ids"),
    )


@query
def decoded_text(spark, sf_dir):
    """Every line, encoded in sequences and put together again."""
    lines = _document_lines(spark, sf_dir)
    vocab = tables.materialize(corpus.char_vocab(lines), "vocab")
    decoded = corpus.decode(corpus.encode(lines, vocab), vocab)
    return corpus.join_sequences(decoded, ["doc_id", "line_no"])


@query
def season_week_of_date(spark, sf_dir):
    date = F.to_date("o_orderdate")
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.season_of(date).alias("season"), dates.week_of(date).alias("week")
    )


@query
def slugify_names(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select(
        "p_partkey",
        tx.slugify(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("slug"),
    )


@query
def chat_answers(spark, sf_dir):
    """With what each answer shows, printed as text."""
    people, stats = views.players(spark, sf_dir), stored_totals(spark, sf_dir)
    known = tables.materialize(ranking.known_players(people, stats, SEASON), "known_players")
    answered = chat.answer_questions(
        views.questions(spark, sf_dir), known, people, stats, SEASON, year_pattern=YEARS
    )
    cents = lambda i: F.round(i["fantasy_points"] * 100).cast("long").cast("string")
    line = F.transform(
        F.coalesce("items", F.array().cast(answered.schema["items"].dataType)),
        lambda i: F.concat_ws(
            ":", i["label"], i["rank"].cast("string"), i["gsis_id"], i["name"], i["position"],
            i["team_id"], i["season"].cast("string"), cents(i),
        ),
    )
    return answered.withColumn("shown", F.array_join(line, " ")).drop("items")


# --- cleaning and HTML -----------------------------------------------------


@query
def normalized_boxscore(spark, sf_dir):
    """Weekly passing under raw headers, cleaned back to canonical columns."""
    line = views.weekly_passing(spark, sf_dir)
    raw = line.select(
        F.col("player_name").alias("player"),
        F.when(F.col("attempts") > 0, F.col("player_id").cast("string")).alias("pfr_player_id"),
        F.col("completions").alias("pass_cmp"), F.col("attempts").alias("att"),
        F.col("interceptions").alias("cmp"), F.col("passing_yards").alias("yds"),
        F.col("sacks").alias("sk"), F.col("passer_rating").alias("Rate %"),
        F.col("team").alias("tm"), F.col("opponent").alias("opp"),
        F.col("longest_pass").alias("Long Pass+"), F.col("season").alias("season_played"),
        F.col("week").alias("week_played"),
    )
    return clean.normalize(raw, fv.PASSING_ALIASES, season=SEASON, week=1)


def _raw_headers(line, names):
    """Weekly lines under the headers of a source page."""
    return line.select(
        F.col("player_name").alias("player"),
        F.when(F.col("week") % 4 != 0, F.col("player_id").cast("string")).alias("pfr_player_id"),
        *[F.col(c).alias(header) for header, c in names.items()],
        F.col("season").alias("Season Played"), F.col("week").alias("week_played"),
    )


@query
def normalized_rushing(spark, sf_dir):
    raw = _raw_headers(
        views.weekly_rushing(spark, sf_dir),
        {"rush_att": "carries", "rush_yds": "rushing_yards", "rush_td": "rushing_tds",
         "long": "longest_rush", "rush_long": "carries", "tm": "team", "opp": "opponent"},
    )
    return clean.normalize(raw, fv.RUSHING_ALIASES, season=SEASON, week=2)


@query
def normalized_receiving(spark, sf_dir):
    raw = _raw_headers(
        views.weekly_receiving(spark, sf_dir),
        {"tgt": "targets", "rec": "receptions", "rec_yds": "receiving_yards",
         "rec_td": "receiving_tds", "rec_long": "longest_reception", "tm": "team", "opp": "opponent"},
    )
    return clean.normalize(raw, fv.RECEIVING_ALIASES, season=SEASON, week=3)


@query
def snake_headers(spark, sf_dir):
    """Slugs of names as ids, headers in snake case."""
    raw = views.weekly_receiving(spark, sf_dir).select(
        F.col("player_name").alias("Player"), F.col("receiving_yards").alias("Rec Yds"),
        F.col("team").alias("TEAM"), F.col("opponent").alias("Opp"), "season", "week",
    )
    return clean.slug_ids(raw)


def _page_rows(spark, sf_dir, category, table_ids, aliases, activity):
    _, _, stats = views.PAGE_KINDS[category]
    pages = views.box_pages(spark, sf_dir, category)
    cells = html_tables.category_rows(pages, table_ids, list(stats), activity)
    return clean.rename_present(cells, aliases)


@query
def html_rushing(spark, sf_dir):
    """Lines with a touchdown, as every line of the view has a carry."""
    return _page_rows(
        spark, sf_dir, "rushing", fv.RUSHING_TABLE_IDS, fv.RUSHING_ALIASES, ["rush_td"]
    )


@query
def html_receiving(spark, sf_dir):
    """Lines with a catch, as every line of the view has a target."""
    return _page_rows(
        spark, sf_dir, "receiving", fv.RECEIVING_TABLE_IDS, fv.RECEIVING_ALIASES, ["rec"]
    )


@query
def html_season(spark, sf_dir):
    """Season tables, hidden in comments and required."""
    pages = views.box_pages(spark, sf_dir, comments_only=True)
    rows = html_tables.season_table(pages, fv.SEASON_PASSING_TABLE_IDS)
    return html_tables.cell_columns(rows, ["player", "pfr_player_id", "team", "pass_yds"])


@query
def html_box_scores(spark, sf_dir):
    """Pages rendered from weekly lines, read back and cleaned."""
    rows = html_tables.extract_tables(views.box_pages(spark, sf_dir), fv.PASSING_TABLE_IDS)
    cells = html_tables.cell_columns(
        rows,
        ["player", "pfr_player_id", "team", "opp", "pass_cmp", "pass_att", "pass_yds", "pass_td"],
    )
    named = clean.rename_present(cells, fv.PASSING_ALIASES)
    counts = ["completions", "attempts", "passing_yards", "passing_tds"]
    return named.withColumns({c: F.col(c).try_cast("long") for c in counts})


@query
def page_links(spark, sf_dir):
    links = html_tables.page_links(views.table(spark, sf_dir, "pages"))
    return links.withColumn("target_id", tx.id_from_href(F.col("href")))


@query
def roster_players(spark, sf_dir):
    """A roster with repeated ids reduced to one row per player."""
    supplier, part = (views.table(spark, sf_dir, t) for t in ("supplier", "part"))
    count = supplier.agg(F.count("*")).scalar()
    rows = part.withColumn("s_suppkey", F.col("p_partkey") % count).join(supplier, "s_suppkey")
    roster = rows.select(
        F.col("s_suppkey").alias("gsis_id"), F.col("p_name").alias("full_name"),
        F.col("p_type").alias("position"), (F.col("s_nationkey") + F.col("p_size")).alias("team"),
    )
    return plays.players_from_roster(roster).select("gsis_id", "name", "team_id")


@query
def rebuilt_directory(spark, sf_dir):
    directory = views.messy_players(spark, sf_dir).select(
        "gsis_id", F.col("name").alias("display_name"), F.col("team_id").alias("latest_team"),
        F.col("headshot_url").alias("headshot"),
        F.when(F.col("position") != "WR", F.col("position")).alias("position"),
    )
    caught_most = season_totals(spark, sf_dir).filter("receiving_tds > rushing_tds + passing_tds")
    return dims.rebuild_directory(directory, caught_most)


@query
def synced_players(spark, sf_dir):
    """Directory of one position's names completed by the names seen weekly."""
    known = views.players(spark, sf_dir).filter(F.col("position") == "QB")
    known = known.groupBy("name").agg(F.max("position").alias("position"))
    seen = views.weekly_receiving(spark, sf_dir).withColumn(
        "pfr_player_id", F.when(F.col("player_id") % 5 != 2, F.col("player_id"))
    )
    return dims.add_missing(known, seen, "player_name", id_column="pfr_player_id")


# --- stored tables and incremental loads -----------------------------------


@query
def weekly_rebuild(spark, sf_dir):
    """History under its own column names, then the plays of later seasons."""
    all_plays = offense_plays(spark, sf_dir)
    old, new = all_plays.filter("season < 1998"), all_plays.filter("season >= 1998")
    history = usage.weekly_stats(old).drop("wopr").withColumnsRenamed(
        {"gsis_id": "player_id", "team_id": "recent_team", "fantasy_points": "fantasy_points_ppr"}
    )
    return rounded(
        weekly.rebuild_weekly(new, history),
        "passing_epa", "rushing_epa", "receiving_epa", "wopr", "target_share", "air_yards_share",
    )


@query
def swap_week(spark, sf_dir):
    """Stored weeks replaced by fresh ones where there are any."""
    path = scratch_dir(spark, "swap_week")
    rows = offense_plays(spark, sf_dir)
    keys = ["season", "week", "gsis_id", "team_id"]
    stale = roles.passing_weekly(rows).select(*keys, F.col("passing_yards").alias("yards"))
    fresh = roles.rushing_weekly(rows).select(*keys, F.col("rushing_yards").alias("yards"))
    tables.swap_partitions(stale, path, ["season", "week"])
    # Reloaded: the season's weeks. Every fifth of them has no rows any more.
    weeks_of = [(SEASON, week) for week in range(1, 54)]
    tables.swap_partitions(
        fresh.filter((F.col("season") == SEASON) & (F.col("week") % 5 != 0)), path,
        ["season", "week"], scope=weeks_of,
    )
    return spark.read.parquet(path).select(*keys, "yards")


@query
def upsert_season(spark, sf_dir):
    """Half-season totals in store, refreshed from the full season."""
    root = scratch_dir(spark, "upsert_season")
    resolved = _resolved(spark, sf_dir, views.weekly_rushing(spark, sf_dir))
    half = resolved.filter("week <= 26 AND season < 2001")
    for source in (half, resolved):
        fresh = boxscore.box_rushing(source, boxscore.PLAYER_SEASON)
        rows, _ = tables.merge_parts(
            spark, root, "rushing", fresh, boxscore.PLAYER_SEASON, weekly.SEASON_PARTS, fv.RUSHING_UPDATES
        )
        tables.publish(spark, root, rows)
    tables.prune(spark, root, keep=1)
    return tables.read_current(spark, root, "rushing")


@query
def upsert_player_week(spark, sf_dir):
    """Weekly rollups of half the weeks in store, refreshed by all of them."""
    root = scratch_dir(spark, "upsert_player_week")
    by_week = _per_week(views.weekly_passing(spark, sf_dir), "passing")
    half = by_week.filter("week % 2 = 0").withColumns(
        {"passing_yards": F.col("passing_yards") - 1, "interceptions": F.lit(7).cast("bigint")}
    )
    weekly.upsert_season_tables(spark, root, {"player_week": boxscore.player_weekly_rollup(half)})
    weekly.upsert_season_tables(
        spark, root, {"player_week": boxscore.player_weekly_rollup(by_week)}, refresh_all=False
    )
    return tables.read_current(spark, root, "player_week")


# --- jobs ------------------------------------------------------------------


def _seasons_of(rows, *seasons):
    return rows.filter(F.col("season").isin(*seasons))


@query
def rebuild_all_season(spark, sf_dir):
    """The season table after a full rebuild with older history."""
    root, all_plays = scratch_dir(spark, "rebuild_all"), offense_plays(spark, sf_dir)
    old, new = all_plays.filter("season < 1998"), all_plays.filter("season >= 1998")
    history = usage.weekly_stats(old).withColumnsRenamed(
        {"gsis_id": "player_id", "team_id": "recent_team", "fantasy_points": "fantasy_points_ppr"}
    )
    roster = views.messy_players(spark, sf_dir).withColumnRenamed("team_id", "team")
    weekly.rebuild_all(
        spark, root, roster, history,
        new.withColumn("defteam", F.lit(None).cast("int")),
    )
    return rounded(tables.read_current(spark, root, "season_stats"), *roles.SEASON_MEANS)


@query
def update_season(spark, sf_dir):
    """A season loaded from half its plays, then again from all of them; another
    season reloaded with nothing."""
    root, rows = scratch_dir(spark, "update_season"), offense_plays(spark, sf_dir)
    roster = views.messy_players(spark, sf_dir)
    for season in SEASON_PAIR:
        weekly.update_season(spark, root, rows.filter("week % 2 = 0"), roster, season)
    weekly.update_season(spark, root, rows, roster, SEASON)
    weekly.update_season(spark, root, rows.filter("season <> 1999"), roster, SEASON_PAIR[0])
    return rounded(tables.read_current(spark, root, "season_stats"), *roles.SEASON_MEANS)


@query
def weekly_update(spark, sf_dir):
    """Two weekly jobs; the rushing table that the second release names."""
    root = scratch_dir(spark, "weekly_update")
    people, squads = views.players(spark, sf_dir), views.teams(spark, sf_dir)
    rows = offense_plays(spark, sf_dir)
    # The box scores of the weeks are there before the jobs, as their files would be.
    scores = [
        tables.materialize(df, f"weekly_{kind}") for kind, df in _weekly_tables(spark, sf_dir).items()
    ]
    for until in (26, 53):
        lines = [df.filter(F.col("week") <= until) for df in scores]
        fresh = weekly.box_season_tables(
            *lines, people, squads, ("gsis_id", "player_id"), ("name", "team")
        )
        # Yards lost are no reason to stop here: the check is for whole seasons.
        fresh["rushing"] = fresh["rushing"].withColumn(
            "rushing_yards", F.greatest("rushing_yards", F.lit(0))
        )
        weekly.weekly_update(spark, root, rows, people, SEASON, fresh, people)
    return tables.read_current(spark, root, "rushing")


@query
def weekly_update_by_weeks(spark, sf_dir):
    """The season table after jobs on one season's weeks: the first half, then the second
    half with a corrected week, each with that part's plays only."""
    root = scratch_dir(spark, "weekly_update_by_weeks")
    people, rows = views.messy_players(spark, sf_dir), offense_plays(spark, sf_dir)
    healthy = views.players(spark, sf_dir)
    wrong = rows.withColumn("yards_gained", F.lit(0)).withColumn("passing_yards", F.lit(0))
    early = rows.filter("week < 26").unionByName(wrong.filter("week = 26"))
    for plays_, span in ((early, range(1, 27)), (rows, range(26, 54))):
        weekly.weekly_update(spark, root, plays_, people, SEASON, {}, healthy, weeks=span)
    return rounded(tables.read_current(spark, root, "season_stats"), *roles.SEASON_MEANS)


@query
def resumed_weeks(spark, sf_dir):
    """Plays loaded up to a week, then from the stored resume point on."""
    root = scratch_dir(spark, "resumed_weeks")
    rows = views.plays(spark, sf_dir, posteam=False, defteam=False).select(
        "season", "week", "play_type", "yards_gained", "epa"
    )
    target, state = f"{root}/plays", f"{root}/state"
    weeks.load_later_weeks(spark, rows.filter("season < 1998"), target, state, "plays")
    # What came before the resume point is not looked at again.
    late = rows.withColumn("epa", F.when(F.col("season") >= 1998, F.col("epa")))
    weeks.load_later_weeks(spark, late, target, state, "plays")
    weeks.load_later_weeks(spark, late, target, state, "plays")
    return spark.read.parquet(target).select(*rows.columns)


# --- readers and sinks -------------------------------------------------------

_PLAY_COLUMNS = [
    "season", "week", "posteam", "play_type", "passer_player_id", "passing_yards", "epa",
    "pass_touchdown", "interception", "sack",
]


def _season_files(spark, sf_dir, fmt, **options):
    """Plays in a folder per season, the season named twice: in path and rows."""
    root = scratch_dir(spark, f"plays_{fmt}")
    rows = offense_plays(spark, sf_dir).select(*_PLAY_COLUMNS)
    rows = rows.withColumn("file", F.col("season")).hint("rebalance", F.col("file"))
    rows.write.partitionBy("file").format(fmt).options(**options).save(root)
    return root + "/file={}"


def _passing_of(rows):
    return roles.passing_season(rows).drop("last_week")


@query
def plays_from_parquet(spark, sf_dir):
    """One file per season; the seasons without one are skipped."""
    template = _season_files(spark, sf_dir, "parquet")
    skipped = []
    rows = plays.read_seasons(spark, template, range(1985, 2010), skipped=skipped)
    return _passing_of(rows).withColumn("skipped", F.lit(len(skipped)))


@query
def plays_from_csv(spark, sf_dir):
    """The same from gzip CSV, spread after reading."""
    template = _season_files(spark, sf_dir, "csv", header="true", compression="gzip")

    def reader(spark, path):
        return plays.read_plays_csv(spark, path, columns=_PLAY_COLUMNS, partitions=4)

    return _passing_of(plays.read_seasons(spark, template, range(1985, 2010), reader))


@query
def roster_read_back(spark, sf_dir):
    """Rosters of two kinds and one that is missing."""
    root = scratch_dir(spark, "roster")
    people = views.messy_players(spark, sf_dir).select(
        "gsis_id", F.col("name").alias("full_name"), "position", F.col("team_id").alias("team")
    )
    people.filter("gsis_id % 2 = 0").write.parquet(f"{root}/even")
    people.filter("gsis_id % 2 = 1").write.option("header", True).csv(f"{root}/odd.csv")
    rosters = [plays.read_roster(spark, f"{root}/{n}") for n in ("even", "odd.csv", "absent")]
    return plays.players_from_roster(clean.union_seasons(rosters)).select(
        "gsis_id", "name", "position", "team_id"
    )


@query
def weekly_csv_files(spark, sf_dir):
    """Clean weekly files of two categories in one folder; one category is read."""
    root = scratch_dir(spark, "weekly_csv")
    for category in ("passing", "receiving"):
        rows = views.weekly(spark, sf_dir, category).withColumn(
            "pfr_player_id", F.col("player_id").cast("string")
        )
        rows.drop("player_id", "team_id").write.option("header", True).csv(f"{root}/{category}")
        boxscores.name_files(spark, f"{root}/{category}", f"{root}/clean", f"weekly_{category}")
    return boxscores.read_weekly(spark, f"{root}/clean", "receiving")


@query
def raw_capture(spark, sf_dir):
    """Raw rushing lines captured by season, week and category, then read back."""
    root = scratch_dir(spark, "raw_capture")
    rows = _raw_headers(
        views.weekly_rushing(spark, sf_dir), {"rush_att": "carries", "rush_yds": "rushing_yards"}
    ).withColumnsRenamed({"Season Played": "season", "week_played": "week"})
    boxscores.write_raw(rows, root, "rushing")
    return boxscores.read_raw(spark, root, rows.schema)


@query
def corpus_lines(spark, sf_dir):
    """The corpus written as lines of text and read again."""
    root = scratch_dir(spark, "corpus_lines")
    people = views.players(spark, sf_dir)
    lines = answers.qa_corpus(people, season_totals(spark, sf_dir), SEASON)
    tables.write_lines(lines.orderBy("rank", "line_no"), root)
    return spark.read.text(root)


@query
def incremental_weeks(spark, sf_dir):
    """Events delivered in two parts per week, loaded as they arrive."""
    base = scratch_dir(spark, "incremental_weeks")
    source, target, checkpoint = (f"{base}/{p}" for p in ("source", "target", "checkpoint"))
    ts = F.col("ts").cast("timestamp")
    events = views.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.hour(ts).alias("hour"),
        F.year(ts).alias("season"),
        (F.call_function("div", F.dayofyear(ts) - 1, F.lit(7)) + 1).cast("int").alias("week"),
    )
    for delivery in (F.col("hour") < 12, F.col("hour") >= 12):
        part = events.filter(delivery).hint("rebalance", F.col("season"), F.col("week"))
        part.write.mode("append").partitionBy("season", "week").parquet(source)
        weeks.stream_weeks(spark, source, target, checkpoint, events.schema)
    return spark.read.schema(events.schema).parquet(target)


# --- quality and projection ------------------------------------------------


@query
def quality_report(spark, sf_dir):
    """Over tables with runners who lost ground and passers whose yards went missing."""
    rushing = box_rushing(spark, sf_dir).withColumn(
        "rushing_yards", F.col("rushing_yards") - 20 * F.col("carries")
    )
    passing = box_passing(spark, sf_dir).withColumn(
        "passing_yards", F.when(F.col("player_id") % 9 == 2, F.lit(0)).otherwise(F.col("passing_yards"))
    )
    return quality.quality_report(
        rushing, views.messy_players(spark, sf_dir), passing, min_games=0
    )


@query
def healthy_gate(spark, sf_dir):
    """The gate passes a table without issues; the checked rows come back."""
    people = views.players(spark, sf_dir)
    quality.gate(
        quality.quality_report(box_rushing(spark, sf_dir), people, box_passing(spark, sf_dir), 99)
    )
    batch = views.weekly_passing(spark, sf_dir).filter(f"season = {SEASON} AND week = 1")
    quality.check_batch(batch, SEASON, 1)
    return batch.select("player_id", "team", "opponent", "season", "week")


@query
def null_zero_profile(spark, sf_dir):
    rows = views.plays(spark, sf_dir)
    return quality.null_zero_profile(rows, ["sack", "epa", "air_yards", "rushing_yards"])


@query
def null_rate(spark, sf_dir):
    rows = views.plays(spark, sf_dir, posteam=False, defteam=False)
    return rounded(quality.null_rate(rows, "epa"), "null_rate")


@query
def placeholder_names(spark, sf_dir):
    return quality.placeholder_names(rebuilt_directory(spark, sf_dir))


@query
def projections(spark, sf_dir):
    stats = stored_totals(spark, sf_dir)
    model = projection.train_projection(stats)
    return projection.project_next_game(model, stats).select(
        "gsis_id", "season", "projected_fantasy_points"
    )


@query
def projections_refitted(spark, sf_dir):
    """The same from sums of products by season, of which one season came wrong first."""
    root, stats = scratch_dir(spark, "refitted"), stored_totals(spark, sf_dir)
    late = F.col("season") == SEASON
    wrong = stats.withColumn("receptions", F.when(late, F.lit(1)).otherwise(F.col("receptions")))
    for rows in (wrong, stats.filter(late)):
        products = projection.cross_products(rows)
        staged, _ = tables.stage(products, root, "projection_products", weekly.SEASON_PARTS)
        tables.publish(spark, root, staged)
    return projection.project_next_game(weekly.stored_projection(spark, root), stats).select(
        "gsis_id", "season", "projected_fantasy_points"
    )


@query
def projections_from_text(spark, sf_dir):
    """The same from cells of text, as a form or a file gives them; zeros are unreadable."""
    stats = stored_totals(spark, sf_dir)
    written = {
        c: F.when(F.col(c) == 0, F.lit("n/a")).otherwise(F.concat(F.lit(" "), F.col(c).cast("string")))
        for c in fv.PROJECTION_FEATURES
    }
    model = projection.train_projection(stats)
    return projection.project_next_game(model, stats.withColumns(written)).select(
        "gsis_id", "season", "projected_fantasy_points"
    )


@query
def projections_by_name(spark, sf_dir):
    stats, people = stored_totals(spark, sf_dir), views.players(spark, sf_dir)
    lookups = people.select(F.explode(F.array("name", F.concat("name", F.lit("x")))).alias("q"))
    model = projection.train_projection(stats)
    return projection.project_by_name(lookups.distinct(), people, stats, model, SEASON).select(
        "q", "gsis_id", "name", "team_id", "projected_fantasy_points", "note"
    )
