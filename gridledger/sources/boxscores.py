"""Weekly box-score files: raw capture, clean reading."""

from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger import schemas
from gridledger.operators.clean import project_present
from gridledger.sources.plays import csv_columns


def read_weekly(spark, directory, category):
    """All clean weekly CSVs of a category, reduced to the known columns.

    Files of one category share their header; optional columns are read when
    present (see ``schemas`` for the common ones).
    """
    raw = spark.read.option("pathGlobFilter", f"*{category}*.csv").csv(directory, header=True)
    kinds = {f.name: f.dataType for s in schemas.BOX_SCORES.values() for f in s.fields}
    text = {"pfr_player_id", "player_name", "team", "opponent"}
    typed = raw.select(
        [
            F.col(c).try_cast(kinds[c]).alias(c) if c in kinds
            else F.col(c) if c in text
            else F.col(c).try_cast("double").alias(c)
            for c in raw.columns
        ]
    )
    return project_present(typed, fv.BOX_SCORE_COLUMNS)


def name_files(spark, folder, directory, stem):
    """Move the written CSV parts of a folder into ``directory`` as <stem>_<n>.csv, the
    names that ``read_weekly`` looks for."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    source, target = path(folder), path(directory)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    parts = sorted(s.getPath().getName() for s in fs.listStatus(source))
    for n, name in enumerate(p for p in parts if p.startswith("part-")):
        fs.rename(path(f"{folder}/{name}"), path(f"{directory}/{stem}_{n:05d}.csv"))


def parse_outcome(df, column="game_outcome"):
    """Split ``W, 37-20`` into result, points for and points against."""
    pattern = r"^([WLT]),\s*(\d+)-(\d+)$"
    return df.withColumns(
        {
            "result": F.nullif(F.regexp_extract(column, pattern, 1), F.lit("")),
            "points_for": F.regexp_extract(column, pattern, 2).try_cast("int"),
            "points_against": F.regexp_extract(column, pattern, 3).try_cast("int"),
        }
    )


def write_raw(df, directory, category):
    """Raw weekly capture under season=/week=/category= folders."""
    rows = df.withColumn("category", F.lit(category))
    keys = ["season", "week", "category"]
    rows.write.mode("append").partitionBy(*keys).option("header", True).csv(directory)


def read_raw(spark, directory, schema):
    """The captured rows of a folder tree; season and week come from the folders."""
    return csv_columns(spark, directory, schema)
