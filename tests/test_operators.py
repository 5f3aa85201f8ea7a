import pytest
from fixtures import PLAY_SCHEMA, play, random_plays
from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger import schemas
from gridledger.operators import boxscore, clean, dims, profile, ranking, roles, teams, usage


def plays_frame(spark, plays):
    return spark.createDataFrame(plays, PLAY_SCHEMA)


# --- player lines ----------------------------------------------------------


def test_season_lines_cover_the_traps(spark):
    plays = plays_frame(
        spark,
        [
            play(play_type="kickoff"),
            play(passer="q", sack=1.0),
            play(passer="q", receiver="w", passing_yards=30.0, receiving_yards=30.0,
                 complete_pass=1.0, pass_touchdown=1.0),
            play(rusher="q", rushing_yards=-4.0, play_type="run"),
            play(receiver="q", complete_pass=1.0, receiving_yards=None),
            play(rusher="w", posteam="CCC", rushing_yards=11.0, fumble_lost=1.0, week=5),
            play(passer="z", passing_yards=0.0),
            play(passer="n", posteam=None, passing_yards=99.0),
            # Two spellings of one player.
            play(rusher="q", rusher_player_name="Q. Other", rushing_yards=10.0),
        ],
    )
    stats = roles.player_season_stats(plays)
    got = {(r["gsis_id"], r["team_id"]): r for r in stats.collect()}
    assert set(got) == {("q", "AAA"), ("w", "AAA"), ("w", "CCC")}
    quarterback = got["q", "AAA"]
    assert quarterback["passing_yards"] == 30 and quarterback["sacks_taken"] == 1
    assert quarterback["rushing_yards"] == 6 and quarterback["receptions"] == 1
    assert quarterback["receiving_yards"] == 0
    assert quarterback["fantasy_points"] == 6.8
    assert quarterback["player_name"] == "N.q"
    assert got["w", "CCC"]["fantasy_points"] == -0.9
    assert got["w", "CCC"]["last_week"] == 5
    roster = spark.createDataFrame([("q", "Quin", "QB"), ("w", None, None)],
                                   "gsis_id string, full_name string, position string")
    named = {(r["gsis_id"], r["team_id"]): (r["player_name"], r["position"])
             for r in roles.player_season_stats(plays, roster).collect()}
    assert named["q", "AAA"] == ("Quin", "QB") and named["w", "CCC"] == ("N.w", "UNK")


@pytest.mark.parametrize("by", [("season", "team_id"), ("season",)])
def test_role_explode_equals_three_way_join(spark, rows, by):
    plays = plays_frame(spark, random_plays(400)).drop(
        *[f"{r}_player_name" for r in roles.ROLES]
    )
    parts = [roles.join_roles(plays, by, (role,)) for role in roles.ROLES]
    keys = ["gsis_id", *by]
    joined = parts[0].drop("last_week")
    for part in parts[1:]:
        joined = joined.join(part.drop("last_week"), keys, "full_outer")
    columns = [*keys, *roles.SEASON_SUMS]
    assert rows(joined.fillna(0, subset=list(roles.SEASON_SUMS)), *columns) == rows(
        roles.join_roles(plays, by), *columns
    )


POINT_COLUMNS = ["passing_yards", "passing_tds", "interceptions", "rushing_tds", "receiving_yards",
                 "receiving_tds", "receptions", "fumbles_lost"]


def test_collapse_takes_latest_team(spark):
    stats = spark.createDataFrame(
        [("a", 2024, "Z", 3, 10, 0.5, 1), ("a", 2024, "B", 9, 15, 0.2, 2), ("a", 2025, "X", 2, 1, 0.0, 1)],
        "gsis_id string, season int, team_id string, last_week int, rushing_yards bigint, "
        "rushing_epa double, weeks bigint",
    ).withColumns({c: F.lit(0).cast("bigint") for c in POINT_COLUMNS})
    got = {(r["gsis_id"], r["season"]): (r["team_id"], r["rushing_yards"], r["fantasy_points"])
           for r in roles.collapse_teams(stats).collect()}
    assert got == {("a", 2024): ("B", 25, 2.5), ("a", 2025): ("X", 1, 0.1)}
    mean = roles.collapse_teams(stats).filter("season = 2024").first()["rushing_epa"]
    assert mean == pytest.approx((0.5 + 2 * 0.2) / 3)
    with pytest.raises(ValueError, match="last_week"):
        roles.collapse_teams(stats.drop("last_week"))
    with pytest.raises(ValueError, match="weeks"):
        roles.collapse_teams(stats.drop("weeks"))


def test_usage_reads_plays_once(spark, rows):
    plays = plays_frame(spark, random_plays(300))
    lines = roles.weekly_lines(plays)
    twice = usage.usage_metrics(lines, usage.team_week(plays))
    once = usage.player_weekly_usage(plays)
    columns = ["gsis_id", "season", "week", "team_id", "target_share", "air_yards_share", "wopr",
               "targets", "completions", "receiving_air_yards"]
    assert rows(once, *columns) == rows(twice, *columns)
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_weekly_usage(spark):
    plays = plays_frame(
        spark,
        [
            play(passer="q", receiver="w", air_yards=8.0, complete_pass=1.0, epa=0.5),
            play(passer="q", receiver="w", air_yards=2.0, epa=None),
            play(passer="q", receiver="v", air_yards=None),
            play(passer="q", epa=1.0),
            play(rusher="r", rush_attempt=1.0, play_type="run", posteam="ZZZ"),
            play(receiver="u", posteam="ZZZ", play_type="run", air_yards=-3.0),
        ],
    )
    got = {r["gsis_id"]: r for r in usage.player_weekly_usage(plays).collect()}
    w = got["w"]
    assert (w["targets"], w["receptions"], w["receiving_epa"]) == (2, 1, 0.5)
    assert w["target_share"] == 0.5 and w["air_yards_share"] == 1.0
    assert w["wopr"] == pytest.approx(1.5 * 0.5 + 0.7)
    assert got["v"]["receiving_epa"] == 0 and got["v"]["air_yards_share"] == 0
    # No pass plays and negative air yards: both shares are 0.
    assert (got["u"]["target_share"], got["u"]["air_yards_share"]) == (0, 0)
    assert got["r"]["team_id"] == "ZZZ" and got["r"]["carries"] == 1
    assert got["q"]["passing_epa"] == pytest.approx(0.75)
    weekly = usage.weekly_stats(plays)
    assert weekly.columns == fv.WEEKLY_STATS_COLUMNS
    assert usage.weekly_stats(plays, with_points=False).agg(F.max("fantasy_points")).first()[0] == 0


def test_target_shares_sum_to_at_most_one(spark):
    plays = plays_frame(spark, random_plays(300)).filter("play_type = 'pass'")
    shares = usage.player_weekly_usage(plays).groupBy("team_id", "season", "week").agg(
        F.sum("target_share").alias("s")
    )
    assert shares.filter("s > 1.0000001").count() == 0


def test_targets_by_attempt_flag(spark):
    plays = plays_frame(
        spark, [play(receiver="w", pass_attempt=None), play(receiver="w", pass_attempt=0.0)]
    )
    assert roles.receiving_weekly(plays).first()["targets"] == 2
    assert roles.receiving_weekly(plays, targets="attempts").first()["targets"] == 1


def test_rollup_averages_weekly_means(spark):
    weekly = spark.createDataFrame(
        [("a", 2025, 1, "X", 10, 0.2, 0.1), ("a", 2025, 2, "X", 5, 0.0, 0.4),
         ("a", 2025, 3, None, 5, 0.0, 0.4)],
        "gsis_id string, season int, week int, team_id string, receiving_yards bigint, "
        "receiving_epa double, wopr double",
    )
    got = usage.season_rollup(clean.align(weekly, schemas.WEEKLY_STATS)).collect()
    assert len(got) == 1
    assert (got[0]["receiving_yards"], got[0]["receiving_epa"]) == (15, 0.1)
    assert got[0]["wopr"] == 0.25


def test_team_totals_from_plays(spark):
    plays = plays_frame(spark, random_plays(300, seed=4))
    both = teams.team_season(plays)
    gained = both.agg(F.sum("off_total_yards")).first()[0]
    assert gained == plays.filter("posteam is not null").agg(F.sum("yards_gained")).first()[0]
    bbb = both.filter("team_id = 'BBB' AND season = 2023").first()
    alone = teams.team_defense(plays).filter("team_id = 'BBB' AND season = 2023").first()
    assert bbb["def_sacks_made"] == alone["def_sacks_made"]
    assert both.filter("team_id IS NULL").count() == 0


# --- cleaning --------------------------------------------------------------


def test_normalize_keeps_first_of_repeated_targets(spark):
    raw = spark.createDataFrame(
        [("A", "id1", 3, 9, 1.5, 7), ("B", None, 4, 8, 2.5, 7)],
        ["player", "pfr_player_id", "pass_cmp", "cmp", "Rate %", "Long Pass+"],
    )
    got = clean.normalize(raw, fv.PASSING_ALIASES, 2024, 3)
    assert got.columns == ["player_name", "pfr_player_id", "completions", "rate__pct",
                           "long_pass", "season", "week"]
    assert [tuple(r) for r in got.collect()] == [("A", "id1", 3, 1.5, 7, 2024, 3)]


def test_aliases_of_the_other_categories(spark):
    raw = spark.createDataFrame(
        [("A", "i", 3, 20, 1, 9, "X", "Y")],
        ["player", "pfr_player_id", "rush_att", "rush_yds", "rush_td", "long", "tm", "opp"],
    )
    got = clean.normalize(raw, fv.RUSHING_ALIASES, 2024, 1)
    assert got.columns[:8] == ["player_name", "pfr_player_id", "carries", "rushing_yards",
                               "rushing_tds", "longest_rush", "team", "opponent"]
    raw = spark.createDataFrame(
        [("A", "i", 5, 3, 20, 1, 9)],
        ["player", "pfr_player_id", "tgt", "rec", "rec_yds", "rec_td", "rec_long"],
    )
    got = clean.normalize(raw, fv.RECEIVING_ALIASES, 2024, 1)
    assert got.columns[2:7] == ["targets", "receptions", "receiving_yards", "receiving_tds",
                                "longest_reception"]
    assert len(fv.PASSING_ALIASES) == 27
    odd = raw.toDF("Cmp%", "B c", "+d", "CMP%", "e", "f", "g")
    assert clean.normalize_columns(odd).columns == ["cmp_pct", "b_c", "d", "e", "f", "g"]
    assert clean.snake_columns(odd).columns[:2] == ["cmp%", "b_c"]


def test_alignment_fills_and_orders(spark):
    df = spark.createDataFrame([(1, None, "x")], "season int, wopr double, extra string")
    got = clean.align(df, schemas.WEEKLY_STATS)
    assert got.columns == fv.WEEKLY_STATS_COLUMNS
    row = got.first()
    assert (row["wopr"], row["targets"], row["gsis_id"], row["season"]) == (0.0, 0, None, 1)


def test_small_cleaning_steps(spark, rows):
    df = spark.createDataFrame([(1, "b", None), (1, "a", 2), (None, "c", 3), (None, "d", 1)],
                               "k int, name string, v int")
    assert rows(clean.dedupe(df, "k", ["name"])) == [(1, "a", 2), (None, "c", 3)]
    assert rows(clean.fill_na_text(df.limit(1), ["name", "v", "zz"])) == [("b", "N/A", "N/A")]
    assert rows(clean.coalesce_cols(df.filter("k = 1"), "x", ["v", "k"])) == [("a", 2), ("b", 1)]
    cells = spark.createDataFrame([("0", "0"), ("", "0"), (None, None), ("0", "2")],
                                  "rec_tgt string, rec string")
    assert rows(clean.has_activity(cells, ["rec_tgt", "rec"])) == [("", "0"), ("0", "2")]
    assert clean.has_activity(cells, ["absent"]).count() == 0
    twice = df.select(F.col("k"), F.col("name"), F.col("v").alias("k"))
    assert clean.dedupe_columns(twice).columns == ["k", "name"]
    slugs = spark.createDataFrame([("Jo Do",)], "Player string")
    assert rows(clean.slug_ids(slugs)) == [("Jo Do", "jo-do")]
    assert clean.project_present(df, ["v", "zz", "k"]).columns == ["v", "k"]
    assert rows(clean.fill_zero(df, ["v"]).select("v")) == [(0,), (1,), (2,), (3,)]
    assert rows(clean.not_null(df, ["k", "v"])) == [(1, "a", 2)]
    assert rows(clean.with_default(df.select("v"), "v", 9)) == [(1,), (2,), (3,), (9,)]
    assert rows(clean.where(df, ids=[1], key="k").select("name")) == [("a",), ("b",)]


def test_dimension_helpers(spark, rows):
    dim = spark.createDataFrame([("Ann", "QB"), ("Bob", "RB")], "name string, position string")
    facts = spark.createDataFrame([("Bob",), ("Cid",), ("Cid",), (None,)], "player_name string")
    assert rows(dims.add_missing(dim, facts, "player_name")) == [
        ("Ann", "QB"), ("Bob", "RB"), ("Cid", "Unknown"),
    ]
    with_ids = spark.createDataFrame([("Dee", 1), ("Eve", None)], "player_name string, id int")
    assert rows(dims.add_missing(dim, with_ids, "player_name", id_column="id"), "name") == [
        ("Ann",), ("Bob",), ("Dee",),
    ]
    assert rows(dims.semi_by_key(dim, facts, "name", "player_name")) == [("Bob", "RB")]
    again = dim.unionByName(dim.limit(1))
    with pytest.raises(Exception, match="not unique"):
        dims.unique_rows(again, ["name"]).collect()
    assert rows(dims.unique_rows(dim, ["name"])) == rows(dim)
    people = spark.createDataFrame([("1", "100%_x"), ("2", "Bo")], "gsis_id string, name string")
    assert rows(dims.search_players(people, "B"), "name") == [("Bo",)]
    assert dims.search_players(people, "_").count() == 2
    assert dims.search_players(people, "\\B\\o").count() == 1
    assert rows(dims.search_players(people, "0\\%\\_"), "name") == [("100%_x",)]


def test_rebuilt_directory(spark):
    directory = spark.createDataFrame(
        [("1", "Ann", None, "u"), ("2", "Bob", "X", None)],
        "gsis_id string, display_name string, latest_team string, headshot string",
    )
    stats = spark.createDataFrame([("1",), ("1",), ("3",)], "gsis_id string")
    got = dims.rebuild_directory(directory, stats)
    assert got.columns == fv.DIRECTORY_COLUMNS
    assert tuple(got.first()) == ("1", "Ann", "N/A", "N/A", "u", "N/A", "N/A", "N/A")


# --- box scores ------------------------------------------------------------


def box(spark, rows_):
    return spark.createDataFrame(
        rows_,
        "player_name string, team string, opponent string, season int, week int, "
        "completions int, attempts int, passing_yards int, passing_tds int, interceptions int, "
        "passer_rating double, sacks int",
    )


def test_box_passing_by_name(spark):
    weekly = box(spark, [
        ("Ann", "X", "Y", 2024, 1, 10, 16, 100, 1, 0, 90.5, None),
        ("Ann", "X", "Z", 2024, 2, 5, 8, None, 0, 1, 91.0, None),
        ("Ann", "Y", "X", 2024, 3, 1, 0, 7, 0, 0, None, 2),
        ("Nobody", "X", "Y", 2024, 1, 1, 1, 1, 1, 1, 1.0, 1),
    ])
    players = spark.createDataFrame([("a1", "Ann")], "gsis_id string, name string")
    squads = spark.createDataFrame([(1, "X"), (2, "Y")], "team_id int, name string")
    resolved = dims.resolve_dims(weekly, players, squads, ("name", "player_name"),
                                 ("name", "team"), check_unique=True)
    got = {r["team_id"]: r for r in boxscore.box_passing(resolved).collect()}
    assert got[1]["games_played"] == 2 and got[1]["passing_yards"] == 100
    assert got[1]["completion_pct"] == 0.625 and got[1]["passer_rating"] == 90.75
    # No value at all stays NULL; no attempts give no ratio.
    assert got[1]["sacks"] is None and got[1]["qbr"] is None
    assert got[2]["completion_pct"] is None
    one = boxscore.box_passing(resolved, boxscore.PLAYER_SEASON).collect()
    assert [(r["team_id"], r["games_played"]) for r in one] == [(2, 3)]


def test_team_totals_need_own_passing(spark):
    passing = box(spark, [("Ann", "X", "Y", 2024, 1, 1, 1, 50, 1, 0, 1.0, 3)])
    rushing = spark.createDataFrame([("Bo", "Y", "X", 2024, 1, 20, 1)],
                                    "player_name string, team string, opponent string, "
                                    "season int, week int, rushing_yards int, rushing_tds int")
    squads = spark.createDataFrame([(1, "X"), (2, "Y")], "team_id int, name string")
    got = boxscore.team_totals(passing, rushing, squads).collect()
    assert len(got) == 1 and got[0]["team_id"] == 1
    row = got[0]
    assert (row["off_total_yards"], row["def_total_yards_allowed"]) == (50, 20)
    assert row["off_rushing_yards"] is None and row["def_sacks_made"] is None


# --- ranking and profiles --------------------------------------------------


def stats_frame(spark, values):
    given = spark.createDataFrame(
        values, "gsis_id string, season int, fantasy_points double, passing_yards bigint, "
                "rushing_yards bigint"
    )
    others = [c for c in POINT_COLUMNS if c not in given.columns]
    return given.withColumns({c: F.lit(None).cast("bigint") for c in others})


def test_leaders_order_and_fallbacks(spark):
    stats = stats_frame(spark, [("a", 2025, 5.0, 10, None), ("b", 2025, 9.0, 10, 3),
                                ("c", 2025, None, None, 1), ("d", 2024, 99.0, 99, 9)])
    players = spark.createDataFrame(
        [(x, x.upper(), "QB", "T", None) for x in "abcd"],
        "gsis_id string, name string, position string, team_id string, headshot_url string",
    )
    got = ranking.leaders(stats, players, "nonsense", 2025).collect()
    assert [(r["rank"], r["name"], r["value"]) for r in got] == [
        (1, "A", 10), (2, "B", 10), (3, "C", 0),
    ]
    got = ranking.rankings(stats, players, "QB", "sacks", 2025, n=2).collect()
    assert [(r["name"], r["val"]) for r in got] == [("B", 9.0), ("A", 5.0)]
    kb = ranking.knowledge_base(players, stats, 2025, n=3).collect()
    assert [r["name"] for r in kb] == ["B", "A", "C"]
    assert ranking.draft_suggestions({"passing": stats}, players, "K", 2025).count() == 0


def test_percentile_against_brute_force(spark):
    import random

    rng = random.Random(3)
    values = [(f"p{i}", rng.choice([2024, 2025]),
               rng.choice([None, round(rng.uniform(-9, 300), 2), 12.5, 12.51]), 0, 0)
              for i in range(400)]
    got = profile.percentile_rank(stats_frame(spark, values)).collect()
    assert len(got) == 400
    for row in got:
        scores = [v[2] or 0 for v in values if v[1] == row["season"]]
        below = sum(s < (row["fantasy_points"] or 0) for s in scores)
        assert row["percentile"] == below / len(scores) * 100
        assert row["label"] == f"Top {100 - int(below / len(scores) * 100)}%"


def test_profiles_and_delta(spark):
    stats = stats_frame(spark, [("a", 2023, 10.0, 100, 1), ("a", 2025, 30.25, 150, 4),
                                ("b", 2024, 20.0, 7, 7), ("c", 2025, 5.0, 0, 0)])
    players = spark.createDataFrame([("a", "A"), ("b", "B"), ("x", "X")],
                                    "gsis_id string, name string")
    got = {r["gsis_id"]: r for r in profile.profiles(players, stats, 2025).collect()}
    assert got["a"]["season_diff"] == "2025 vs 2023"
    assert got["a"]["passing_yards_delta"] == 50 and got["a"]["fantasy_points_delta"] == 20.25
    assert [s["season"] for s in got["a"]["season_stats"]] == [2023, 2025]
    assert got["a"]["percentile"] == "Top 50%"
    # Placed among another season's scores, which do not hold 20.0.
    assert got["b"]["percentile"] == "Top 50%"
    assert got["b"]["season_diff"] == "No previous season"
    assert got["x"]["percentile"] == "N/A" and got["x"]["season_stats"] is None
    empty = profile.profiles(players, stats, 1999).filter("gsis_id = 'a'").first()
    assert empty["percentile"] == "N/A"


def test_comparisons(spark):
    season = spark.createDataFrame(
        [("a", 2024, 5, None, 1), ("a", 2025, 9, 2, 4), ("b", 2025, 1, 1, 1)],
        "player_id string, season int, rushing_yards int, rushing_tds int, carries int",
    )
    got = {r["player_id"]: r for r in profile.compare_seasons(season, "RB", 2024, 2025).collect()}
    a, b = got["a"], got["b"]
    assert (a["rushing_yards_diff"], a["rushing_tds_diff"], a["carries_diff"]) == (4, 2, 3)
    # One season only: shown, without a difference.
    assert (b["rushing_yards_2024"], b["rushing_yards_2025"], b["rushing_yards_diff"]) == (
        None, 1, None,
    )
    with pytest.raises(ValueError):
        profile.compare_seasons(season, "K", 2024, 2025)
    players = spark.createDataFrame([("a", "A"), ("b", "B")], "gsis_id string, name string")
    stats = spark.createDataFrame(
        [("a", 2025, 3.5, 7)], "gsis_id string, season int, fantasy_points double, passing_tds int"
    )
    for name in fv.HEAD_TO_HEAD_METRICS:
        if name not in stats.columns:
            stats = stats.withColumn(name, F.lit(None).cast("int"))
    pairs = spark.createDataFrame([("a", "b"), ("b", "a")], "p1 string, p2 string")
    cards = profile.head_to_head(pairs, stats, players, 2025).collect()
    winners = {(r["p1"], r["metric"]): r["winner"] for r in cards}
    assert winners["a", "fantasy_points"] == 1 and winners["b", "passing_tds"] == 2
    assert winners["a", "rushing_yards"] == 0 and len(cards) == 14


def test_compare_players_counts_stat_lines(spark):
    def weekly(kind, rows_):
        return spark.createDataFrame(
            rows_, f"player_id string, season int, week int, {kind}_yards int"
        )

    passing = weekly("passing", [("a", 2024, 1, 100), ("a", 2023, 1, 999)])
    rushing = weekly("rushing", [("a", 2024, 1, 20), ("a", 2024, 2, None)])
    receiving = weekly("receiving", [("b", 2024, 1, 5)])
    totals = boxscore.three_way_totals(passing, rushing, receiving, 2024)
    players = spark.createDataFrame(
        [("a", "A", "QB", 1), ("b", "B", "WR", 2), ("c", "C", "WR", 2)],
        "gsis_id string, name string, position string, team_id int",
    )
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "?")], "p1 string, p2 string")
    got = {r["p2"]: r for r in profile.compare_players(pairs, totals, players).collect()}
    assert set(got) == {"b", "c"}
    assert (got["b"]["stat_lines_1"], got["b"]["games_1"]) == (3, 2)
    assert (got["b"]["passing_diff"], got["b"]["rushing_diff"]) == (100, 20)
    assert got["c"]["stat_lines_2"] == 0
