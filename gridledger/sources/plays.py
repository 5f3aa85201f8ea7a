"""Readers of play-by-play, rosters and weekly history; schemas are declared."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridledger import fixed_values as fv
from gridledger import schemas
from gridledger.operators.clean import dedupe, rename_present, union_seasons


def _pick(schema, columns):
    if columns is None:
        return schema
    return T.StructType([f for f in schema.fields if f.name in columns])


def _typed(column, field):
    """The column in the declared type; unreadable text and NaN become NULL."""
    value = column.try_cast(field.dataType)
    if field.dataType == T.DoubleType():
        value = F.when(~F.isnan(value), value)
    return value.alias(field.name)


def _listed(path):
    return [path] if isinstance(path, str) else list(path)


def read_plays(spark, path, columns=None):
    """Parquet plays of one path or a list of like files; only the columns a query uses
    are read."""
    df = spark.read.parquet(*_listed(path))
    wanted = [f for f in _pick(schemas.PLAYS, columns).fields if f.name in df.columns]
    return df.select([_typed(F.col(f.name), f) for f in wanted])


def csv_columns(spark, path, schema):
    """CSV with header; columns are matched by name and cast to the schema.

    Everything is read as text first, so column order and extra columns in a
    file do not matter; unreadable cells become NULL. Files read together share a header.
    """
    raw = spark.read.csv(_listed(path), header=True, inferSchema=False)
    return raw.select(
        [_typed(F.col(f"`{f.name}`"), f) for f in schema.fields if f.name in raw.columns]
    )


def read_plays_csv(spark, path, columns=None, partitions=None):
    """CSV plays, plain or gzip.

    A gzip file cannot be split; ``partitions`` spreads its rows afterwards.
    """
    df = csv_columns(spark, path, _pick(schemas.PLAYS, columns))
    return df.repartition(partitions) if partitions else df


def _exists(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def _file_names(spark, path):
    """Name of a file, or of the files in a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return [s.getPath().getName() for s in listed]


def _layout(spark, path):
    """What files must share to be one scan: the CSV header or the Parquet schema."""
    if any(".csv" in name for name in _file_names(spark, path)):
        return tuple(spark.read.csv(path, header=True, inferSchema=False).columns)
    return spark.read.parquet(path).schema.json()


def read_seasons(spark, template, years, reader=read_plays, skipped=None):
    """One file per season (``{}`` is the year), united by column name.

    Seasons whose files have the same layout are one scan of several paths, whatever
    their number. Seasons without a file are skipped and, if a list is given, noted in it.
    ``reader`` takes a list of paths.
    """
    alike = {}
    for year in years:
        path = template.format(year)
        if _exists(spark, path):
            alike.setdefault(_layout(spark, path), []).append(path)
        elif skipped is not None:
            skipped.append(year)
    if not alike:
        raise FileNotFoundError(f"no season of {years} found for {template}")
    return union_seasons([reader(spark, paths) for paths in alike.values()])


def read_roster(spark, path):
    """Roster as CSV or parquet; a missing one is an empty typed frame."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schemas.ROSTER)
    if ".csv" in path:
        return csv_columns(spark, path, schemas.ROSTER)
    df = spark.read.parquet(path)
    return df.select(
        [F.col(f.name).cast(f.dataType) for f in schemas.ROSTER.fields if f.name in df.columns]
    )


def players_from_roster(roster):
    """The players table: renamed, one row per id.

    Among repeated ids the first by name stays, a row with a name before one
    without; rows without id are one player.
    """
    renamed = rename_present(roster, fv.ROSTER_RENAMES)
    order = [F.col("name").isNull(), F.col("name"), F.col("team_id").isNull(), F.col("team_id")]
    return dedupe(renamed, "gsis_id", order)
