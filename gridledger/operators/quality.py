"""Data-quality checks; each table is scanned once for all its checks."""

from functools import reduce

from pyspark.sql import functions as F

from gridledger.functions.numeric import count_where


def probe(df, **expressions):
    """One row of named aggregates from one pass."""
    return df.agg(*[e.alias(name) for name, e in expressions.items()])


def _issues(df, name, condition):
    return df.agg(count_where(condition).alias("issues")).select(F.lit(name).alias("check"), "issues")


def negative_yards(season_rushing):
    return _issues(season_rushing, "negative_rushing_yards", F.col("rushing_yards") < 0)


def null_names(players):
    return _issues(players, "null_names", F.col("name").isNull())


def _stale(min_games):
    return (F.col("passing_yards") == 0) & (F.col("games_played") > min_games)


def stale_passers(season_passing, min_games=5):
    return _issues(season_passing, "stale_passers", _stale(min_games))


def placeholder_names(players):
    missing = F.col("name").isNull() | (F.col("name") == "N/A")
    return _issues(players, "placeholder_names", missing)


def _nameless():
    return F.col("gsis_id").isNull() | F.col("team_id").isNull()


def season_issues(season_stats, season):
    """A season table without rows of its season, or rows without a player or team."""
    own = season_stats.filter(F.col("season") == season)
    empty = own.agg((F.count(F.lit(1)) == 0).cast("long").alias("issues"))
    return empty.select(F.lit("season_without_rows").alias("check"), "issues").unionByName(
        _issues(season_stats, "season_rows_without_key", _nameless())
    )


# The same checks as aggregates, to be observed while a table is written.
def negative_yards_metric():
    return {"negative_rushing_yards": count_where(F.col("rushing_yards") < 0)}


def stale_passers_metric(min_games=5):
    return {"stale_passers": count_where(_stale(min_games))}


def season_metrics(season):
    """Rows of the season, and rows without a player or team."""
    return {
        "rows_of_season": count_where(F.col("season") == season),
        "season_rows_without_key": count_where(_nameless()),
    }


def season_failures(metrics):
    """season_metrics of a finished write as numbers of issues; no metrics, no rows."""
    return {
        "season_without_rows": int(not metrics.get("rows_of_season")),
        "season_rows_without_key": metrics.get("season_rows_without_key", 0),
    }


def gate_observed(issues):
    """Raise if any observed check (name -> number) found issues."""
    failed = [f"{name}: {n}" for name, n in issues.items() if n]
    if failed:
        raise RuntimeError("data quality: " + "; ".join(failed))


def quality_report(season_rushing, players, season_passing, min_games=5):
    """Number of issues per check."""
    checks = [
        negative_yards(season_rushing),
        null_names(players),
        stale_passers(season_passing, min_games),
    ]
    return reduce(lambda a, b: a.unionByName(b), checks)


def gate(report):
    """Raise if any check found issues; the report has one row per check."""
    gate_observed({r["check"]: r["issues"] for r in report.filter("issues > 0").collect()})


def null_zero_profile(df, columns):
    """Rows, NULLs and zeros per column, from one pass."""
    counted = df.agg(
        F.count("*").alias("rows"),
        *[count_where(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns],
        *[count_where(F.col(c) == 0).alias(f"zeros_{c}") for c in columns],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column"), F.col("rows"),
            F.col(f"nulls_{c}").alias("nulls"), F.col(f"zeros_{c}").alias("zeros"),
        )
        for c in columns
    ]
    return counted.select(F.inline(F.array(*lines)))


def null_rate(df, column, n=None):
    """Share of rows without the metric; ``n`` looks at that many rows only."""
    rows = df.limit(n) if n else df
    return rows.agg(F.avg(F.col(column).isNull().cast("int")).alias("null_rate"))


def check_batch(df, season, week):
    """Fail unless the batch is non-empty, all of that week, and names players.

    Every row is checked.
    """
    if not {"player", "player_name"} & set(df.columns):
        raise ValueError("neither player nor player_name present")
    off = ~(F.col("season").eqNullSafe(season) & F.col("week").eqNullSafe(week))
    row = probe(df, rows=F.count("*"), off=count_where(off)).first()
    if row["rows"] == 0:
        raise ValueError("empty batch")
    if row["off"]:
        raise ValueError(f"{row['off']} rows are not of season {season} week {week}")


def missing_columns(df, required):
    return [c for c in required if c not in df.columns]


def week_coverage(df):
    return df.select("season", "week").distinct().orderBy("season", "week")


def rows_by_week(stored):
    """Rows per week of a table partitioned by season and week: the files' own row
    counts, as no column has to be read."""
    return stored.groupBy("season", "week").agg(F.count(F.lit(1)).alias("rows"))
