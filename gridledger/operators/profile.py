"""Player profiles: percentiles, season deltas, comparisons."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger.functions.numeric import (
    fantasy_points_or_stored,
    percentile_label,
    points_from_cents,
    zero,
)
from gridledger.operators.clean import fill_zero, pick_column, where
from gridledger.operators.names import best_match

# Scores are bucketed by whole points, so a bucket holds at most this many
# distinct scores (in hundredths).
CENTS_PER_BUCKET = 100


def _cents(points):
    return F.round(zero(points.cast("double")) * 100).cast("long")


def lines_below(scores):
    """Per (season, cents) the lines with fewer points, and the season's lines.

    ``scores`` holds one row per season and distinct score, with its number of
    ``lines``. Exact without a window over a whole season: lower buckets plus
    lower scores in the same bucket. A window sees either one row per
    whole-point bucket of a season or at most 100 scores of a bucket, however
    many players the season has.
    """
    lower = (Window.unboundedPreceding, -1)
    scores = scores.withColumn("bucket", F.floor(F.col("cents") / CENTS_PER_BUCKET))
    by_season = Window.partitionBy("season")
    buckets = scores.groupBy("season", "bucket").agg(F.sum("lines").alias("lines"))
    buckets = buckets.select(
        "season",
        "bucket",
        zero(F.sum("lines").over(by_season.orderBy("bucket").rowsBetween(*lower))).alias("lower"),
        F.sum("lines").over(by_season).alias("population"),
    )
    in_bucket = Window.partitionBy("season", "bucket").orderBy("cents").rowsBetween(*lower)
    return (
        scores.withColumn("lower_in_bucket", zero(F.sum("lines").over(in_bucket)))
        .join(buckets, ["season", "bucket"])
        .select(
            "season",
            "cents",
            (F.col("lower") + F.col("lower_in_bucket")).alias("below"),
            "population",
        )
    )


def _percentile():
    population = F.col("population").cast("double")
    return F.when(
        population > 0, F.col("below").cast("double") / population * F.lit(100.0)
    )


def _score_counts(scored):
    return scored.groupBy("season", "cents").agg(F.count("*").alias("lines"))


def percentile_rank(stats, season=None):
    """Share of a season's lines with strictly fewer points, and its label."""
    scored = where(stats, season=season).select(
        "gsis_id", "season", "fantasy_points", _cents(F.col("fantasy_points")).alias("cents")
    )
    ranks = lines_below(_score_counts(scored))
    return (
        scored.join(ranks, ["season", "cents"])
        .withColumn("percentile", _percentile())
        .withColumn("label", percentile_label(F.col("percentile")))
        .select("gsis_id", "season", "fantasy_points", "percentile", "label")
    )


def season_delta(stats):
    """Change against the player's previous season row.

    ``stats`` has one row per player and season (see ``collapse_teams``); the
    window holds one player's seasons only.
    """
    by_player = Window.partitionBy("gsis_id").orderBy("season")

    def before(column):
        return F.lag(column).over(by_player)

    rows = stats.withColumn("_cents", _cents(fantasy_points_or_stored(stats)))
    versus = F.concat_ws(" vs ", F.col("season").cast("string"), before("season").cast("string"))
    return rows.select(
        "gsis_id",
        "season",
        F.when(before("season").isNotNull(), versus)
        .otherwise("No previous season")
        .alias("season_diff"),
        (F.col("passing_yards") - before("passing_yards")).alias("passing_yards_delta"),
        (F.col("rushing_yards") - before("rushing_yards")).alias("rushing_yards_delta"),
        points_from_cents(F.col("_cents") - before("_cents")).alias("fantasy_points_delta"),
    )


def profiles(players, stats, season):
    """Every player's info, season history and latest comparison.

    The label sets the latest season's points against the population of
    ``season``; ``season_stats`` holds one struct per season of the player.
    """
    line = F.struct("season", *[c for c in stats.columns if c not in ("gsis_id", "season")])
    history = stats.groupBy("gsis_id").agg(
        F.sort_array(F.collect_list(line)).alias("season_stats"),
        F.max("season").alias("latest_season"),
        F.max_by(_cents(F.col("fantasy_points")), "season").alias("cents"),
    )
    population = where(stats, season=season).select(
        "season", _cents(F.col("fantasy_points")).alias("cents")
    )
    # Every latest score joins the population with no lines of its own, so
    # that scores the population lacks are placed as well.
    asked = history.select(F.lit(season).alias("season"), "cents", F.lit(0).alias("lines"))
    scores = _score_counts(population).unionByName(asked.distinct())
    scores = scores.groupBy("season", "cents").agg(F.sum("lines").alias("lines"))
    labels = lines_below(scores).select(
        "cents", percentile_label(_percentile()).alias("percentile")
    )
    deltas = season_delta(stats).withColumnRenamed("season", "latest_season")
    return (
        players.join(history, "gsis_id", "left")
        .join(labels, "cents", "left")
        .join(deltas, ["gsis_id", "latest_season"], "left")
        .withColumn("percentile", F.coalesce("percentile", F.lit("N/A")))
        .drop("cents")
    )


def player_stats(lookups, players, stats, season):
    """Each looked-up name (q) with its best player's season line and points.

    ``fantasy`` is recomputed where no points are stored, and 0 without a line.
    """
    found = best_match(lookups, players, stats, season).drop("fantasy_points", "season")
    lines = where(stats, season=season)
    shown = lines.withColumn("fantasy", fantasy_points_or_stored(lines))
    shown = shown.drop("season", *[c for c in found.columns if c != "gsis_id"])
    return fill_zero(found.join(shown, "gsis_id", "left"), ["fantasy"])


def season_pair(stats, columns, first, second, key="player_id"):
    """Two seasons of one entity side by side: ``<column>_<season>``.

    An entity with a row in one of the seasons only keeps it; ``seasons`` counts
    those it has.
    """
    picked = [
        F.sum(F.when(F.col("season") == season, F.col(c))).alias(f"{c}_{season}")
        for c in columns
        for season in (first, second)
    ]
    rows = where(stats, season=[first, second])
    return rows.groupBy(key).agg(*picked, F.count_distinct("season").alias("seasons"))


def compare_seasons(stats, position, first, second, key="player_id"):
    """Change of the position's metrics between two seasons, NULL counting 0.

    A player with one season is shown with it and without a difference.
    """
    metrics = pick_column(fv.SEASON_DIFF_METRICS, position)
    if metrics is None:
        raise ValueError(f"position must be one of {sorted(fv.SEASON_DIFF_METRICS)}")
    pairs = season_pair(stats, metrics, first, second, key)
    both = F.col("seasons") == 2
    return pairs.withColumns(
        {
            f"{m}_diff": F.when(both, zero(F.col(f"{m}_{second}")) - zero(F.col(f"{m}_{first}")))
            for m in metrics
        }
    ).drop("seasons")


def pair_rows(pairs, facts, columns, how="left", key="gsis_id"):
    """The facts of both ids of each pair side by side, suffixed _1 and _2."""
    out = pairs
    for side in ("1", "2"):
        renamed = facts.select(
            F.col(key).alias(f"p{side}"), *[F.col(c).alias(f"{c}_{side}") for c in columns]
        )
        out = out.join(renamed, f"p{side}", how)
    return out.select("p1", "p2", *[f"{c}_{s}" for c in columns for s in ("1", "2")])


def compare_players(pairs, totals, players):
    """Season totals of two players and their yardage differences.

    ``totals`` comes from ``three_way_totals``; a pair with an unknown player
    is dropped, a known player without rows counts 0.
    """
    measures = ["stat_lines", "games", "passing_yards", "rushing_yards", "receiving_yards"]
    facts = players.join(totals.withColumnRenamed("player_id", "gsis_id"), "gsis_id", "left")
    facts = fill_zero(facts, measures)
    sides = pair_rows(
        pairs, facts, ["name", "position", "team_id", *measures], how="inner"
    )
    return sides.withColumns(
        {
            "passing_diff": F.col("passing_yards_1") - F.col("passing_yards_2"),
            "rushing_diff": F.col("rushing_yards_1") - F.col("rushing_yards_2"),
        }
    )


def head_to_head(pairs, stats, players, season):
    """One row per pair and metric with both values and the winner (1, 2 or 0).

    Missing values count 0 and a tie has no winner.
    """
    metrics = fv.HEAD_TO_HEAD_METRICS
    season_rows = where(stats, season=season).select("gsis_id", *metrics)
    facts = players.select("gsis_id", "name").join(season_rows, "gsis_id", "left")
    sides = pair_rows(pairs, facts, ["name", *metrics])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("metric_no"),
                F.lit(m).alias("metric"),
                zero(F.col(f"{m}_1")).cast("double").alias("value_1"),
                zero(F.col(f"{m}_2")).cast("double").alias("value_2"),
            )
            for i, m in enumerate(metrics)
        ]
    )
    first, second = F.col("value_1"), F.col("value_2")
    winner = F.when(first > second, 1).when(second > first, 2).otherwise(0)
    return sides.select("p1", "p2", "name_1", "name_2", F.inline(rows)).withColumn(
        "winner", winner
    )
