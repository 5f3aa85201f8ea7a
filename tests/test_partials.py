"""Seasons brought up to date by their changed weeks, and the projection fitted to sums."""

import random

import pytest
from fixtures import PLAY_SCHEMA, random_plays
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger import schemas
from gridledger.operators import clean, partials, projection, usage
from gridledger.plans import weekly
from gridledger.sources import tables

ROSTER = "gsis_id string, name string, position string, season int"


def line(rng, player, season, week, team):
    values = dict.fromkeys(weekly.WEEK_LINES.names)
    for field in weekly.WEEK_LINES.fields:
        if field.dataType.typeName() in ("long", "integer"):
            values[field.name] = rng.choice([None, rng.randint(-4, 90)])
        elif field.dataType.typeName() == "double":
            values[field.name] = rng.choice([None, 0.0, rng.uniform(-3, 3), 1 / 3])
    values |= {"gsis_id": player, "season": season, "week": week, "team_id": team}
    values["fantasy_points"] = rng.choice([None, rng.randint(-300, 5000) / 100])
    return tuple(values.values())


def week(rng, season, number):
    """A week's lines: some players with two teams, some lines without a key."""
    players = rng.sample(["p1", "p2", "p3", "p4", "p5", None], 4)
    lines = [line(rng, p, season, number, rng.choice(["A", "B", None])) for p in players]
    return lines + [line(rng, "p9", season, number, t) for t in ("A", "C")]


def frame(spark, weeks):
    rows = [row for lines in weeks.values() for row in lines]
    return spark.createDataFrame(rows, weekly.WEEK_LINES)


def shown(df):
    digits = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    rows = df.withColumns({c: F.round(c, 10) + 0.0 for c in digits}).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_season_rows_of_partials_equal_the_season_table(spark):
    rng = random.Random(1)
    weeks = {(s, w): week(rng, s, w) for s in (2023, 2024) for w in (0, 1, 17, 61)}
    lines = frame(spark, weeks)
    for rows in (lines, lines.drop("sacks", "fumbles_lost"), lines.limit(0)):
        got = partials.season_rows(partials.week_partials(rows))
        expected = usage.season_table(rows)
        assert got.schema.names == expected.schema.names
        assert shown(got) == shown(expected)


@pytest.mark.parametrize("weeks", [[3, 3], [62], [None], [-1]])
def test_weeks_that_cannot_be_told_apart_fail(spark, weeks):
    rng = random.Random(2)
    lines = spark.createDataFrame([line(rng, "p", 2024, w, "A") for w in weeks], weekly.WEEK_LINES)
    with pytest.raises(PySparkException, match="repeated or never stored: player p season 2024"):
        partials.season_rows(partials.week_partials(lines)).collect()


def test_taking_away_what_was_never_there_fails(spark):
    rng = random.Random(3)
    one, two = (
        spark.createDataFrame([line(rng, "p", 2024, w, "A")], weekly.WEEK_LINES) for w in (1, 2)
    )
    wrong = partials.merged(partials.week_partials(one), partials.week_changes(two, one.limit(0)).unionByName(
        partials.week_changes(two, one.limit(0))))
    with pytest.raises(PySparkException, match="never stored"):
        partials.season_rows(wrong).collect()


def test_unchanged_weeks_give_no_change(spark):
    rng = random.Random(4)
    lines = frame(spark, {w: week(rng, 2024, w) for w in (1, 2)})
    assert partials.week_changes(lines, lines.repartition(3)).isEmpty()


def test_weeks_in_any_order_end_as_a_rebuild(spark, tmp_path):
    rng, root = random.Random(5), str(tmp_path / "store")
    roster = spark.createDataFrame([("p1", "One", "QB", 2024), ("p9", "Nine", None, 2024)], ROSTER)
    stored = {}

    def load(new, gone=()):
        stored.update(new)
        for key in gone:
            stored.pop(key, None)
        fresh = frame(spark, new) if new else spark.createDataFrame([], weekly.WEEK_LINES)
        weekly.load_weeks(spark, root, fresh, roster, weeks=gone)
        lines = frame(spark, stored)
        expected = clean.align(usage.season_table(lines, roster), schemas.SEASON_STATS)
        got = tables.read_current(spark, root, "season_stats")
        assert shown(got) == shown(expected)
        assert shown(tables.read_current(spark, root, "weekly_lines")) == shown(clean.align(lines, weekly.WEEK_LINES))
        model = weekly.stored_projection(spark, root)
        whole = projection.fit_products(projection.cross_products(expected, by=()))
        assert model == whole

    load({(2023, 1): week(rng, 2023, 1), (2024, 2): week(rng, 2024, 2), (2024, 4): week(rng, 2024, 4)})
    load({(2024, 1): week(rng, 2024, 1)})  # late
    load({(2024, 4): week(rng, 2024, 4)})  # corrected
    load({(2024, 4): stored[2024, 4]})  # again
    load({(2024, 2): week(rng, 2024, 2)}, gone=[(2024, 4), (2024, 9)])  # the latest week withdrawn
    before = tables.versions(spark, root).count()
    load({})
    assert tables.versions(spark, root).count() == before
    load({}, gone=[(2023, 1)])  # a season without a week left
    # A load that fails its check publishes nothing.
    twice = week(rng, 2024, 7)
    with pytest.raises(PySparkException, match="repeated"):
        weekly.load_weeks(spark, root, frame(spark, {1: twice, 2: twice}), roster)
    load({(2024, 8): week(rng, 2024, 8)})


def test_weekly_job_by_weeks(spark, tmp_path):
    pbp, root = spark.createDataFrame(random_plays(400), PLAY_SCHEMA), str(tmp_path / "store")
    players = spark.createDataFrame([("p1", "One")], "gsis_id string, name string")
    wrong = pbp.withColumn("passing_yards", F.lit(99.0))
    for rows, weeks in ((pbp, [1]), (wrong, [2, 3]), (pbp, [3]), (pbp, [2, 7])):
        weekly.weekly_update(spark, root, rows, None, 2024, {}, players, weeks=weeks)
    expected = clean.align(weekly.season_rows(pbp.filter("season = 2024"), None), schemas.SEASON_STATS)
    assert shown(tables.read_current(spark, root, "season_stats")) == shown(expected)
    nameless = players.withColumn("name", F.lit(None).cast("string"))
    before = tables.versions(spark, root).count()
    with pytest.raises(RuntimeError, match="null_names"):
        weekly.weekly_update(spark, root, wrong, None, 2024, {}, nameless, weeks=[1])
    assert tables.versions(spark, root).count() == before


def test_a_season_stored_without_sums_is_loaded_whole(spark, tmp_path):
    pbp, root = spark.createDataFrame(random_plays(200), PLAY_SCHEMA), str(tmp_path / "store")
    weekly.update_season(spark, root, pbp, None, 2024)
    lines = usage.player_weekly_usage(pbp.filter("season = 2024"))
    with pytest.raises(ValueError, match="without sums"):
        weekly.load_weeks(spark, root, lines.filter("week = 1"), None)
    stored = shown(tables.read_current(spark, root, "season_stats"))
    weekly.load_weeks(spark, root, lines, None, all_weeks=True)
    assert shown(tables.read_current(spark, root, "season_stats")) == stored
    with pytest.raises(ValueError, match="kept by its weeks"):
        weekly.update_season(spark, root, pbp, None, 2024)


def test_fit_of_products_equals_the_fit_of_rows(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        x = [rng.randint(0, 400), rng.randint(0, 5), rng.randint(0, 300), 2, rng.randint(0, 300), None]
        x[5] = x[0] + x[1]  # the last is the sum of two others, the fourth is constant
        rows.append((f"p{i}", 2020 + i % 3, *x, rng.choice([None, round(sum(x) * 0.05 + rng.random(), 2)])))
    stats = spark.createDataFrame(rows, ["gsis_id", "season", *fv.PROJECTION_FEATURES, "fantasy_points"])
    products = projection.cross_products(stats)
    assert products.count() == 3
    model = projection.fit_products(products)
    assert model.weights[3] == 0.0 and model.weights[5] == 0.0
    np = pytest.importorskip("numpy")
    design = np.array([[1, *r[2:5], r[6]] for r in rows], float)
    beta = np.linalg.lstsq(design, np.array([r[8] or 0.0 for r in rows]), rcond=None)[0]
    got = [model.intercept, *model.weights[:3], model.weights[4]]
    assert got == pytest.approx(list(beta), abs=1e-9)
    shares = projection.project_next_game(model, stats).count()
    assert shares == 120
    with pytest.raises(ValueError, match="receptions"):
        projection.cross_products(stats.drop("receptions"))


def test_fit_of_no_rows(spark):
    columns = ", ".join(f"{c} bigint" for c in fv.PROJECTION_FEATURES)
    stats = spark.createDataFrame([], f"season int, {columns}, fantasy_points double")
    model = projection.fit_products(projection.cross_products(stats))
    assert model == projection.Projection(0.0, (0.0,) * len(fv.PROJECTION_FEATURES))
