"""Stored tables: parts and their current versions, partition swap, upsert, state, text lines.

A stored table is a set of parts (a season, a week, or the whole table), each written by
a plain Spark write into a folder of its own. One small Parquet table, ``versions``, says
which folder is current: a job appends one file of rows to it, so that all tables and
parts of the job change at once, and what it did not touch stays as it is. A write that
was not published is in nobody's way. Jobs at the same time may publish different tables
or parts; of one part the later row counts.
"""

import json
import time
import uuid

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridledger.operators.dims import unique_rows
from gridledger.session import scratch_dir

_VERSIONS = "name string, part string, path string, fields string, at string"
_PART = "_part"
_WHOLE = ""


def _folder(spark, path):
    """(file system, path), for listings and deletions from the driver."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _listed(spark, path):
    fs, folder = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def _delete(spark, path):
    fs, target = _folder(spark, path)
    fs.delete(target, True)


def part_of(values):
    """The name of the part that these values of its columns make."""
    return f"{_PART}={'-'.join(str(v) for v in values)}"


def stage(df, root, name, by=(), scope=(), metrics=None):
    """Write the frame's parts where no reader looks yet.

    ``by`` are the columns that make a part; ``scope`` are the parts (tuples of values)
    that were reloaded, which are gone if the frame has no row for them. Returns the
    rows for ``publish`` and the ``metrics`` (name -> aggregate) of what was written,
    gathered by the same execution.
    """
    spark, path = df.sparkSession, f"{root}/{name}/{uuid.uuid4().hex}"
    fields, seen = df.schema.json(), Observation()
    if metrics:
        df = df.observe(seen, *[metric.alias(key) for key, metric in metrics.items()])
    if by:
        part = F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in by])
        df.withColumn(_PART, part).hint("rebalance", F.col(_PART)).write.partitionBy(_PART).parquet(path)
        parts = [p for p in _listed(spark, path) if p.startswith(f"{_PART}=")]
    else:
        df.write.parquet(path)
        parts = [_WHOLE]
    rows = [(name, part, f"{path}/{part}", fields) for part in parts]
    rows += [(name, part_of(s), None, fields) for s in scope if part_of(s) not in parts]
    return rows, seen_metrics(seen) if metrics else {}


def seen_metrics(observation):
    """The metrics of a finished write; none if its plan turned out to be empty."""
    try:
        return observation.get
    except Exception as missing:
        # An empty plan is cut away together with its observation.
        if "assertion failed" not in str(missing):
            raise
        return {}


def publish(spark, root, rows):
    """Make staged parts the current ones, all at once."""
    if rows:
        at = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        listed = spark.createDataFrame([(*row, at) for row in rows], _VERSIONS)
        listed.coalesce(1).write.mode("append").parquet(f"{root}/versions")


def versions(spark, root):
    """All rows ever published, with ``age``: 1 for the current one of each part."""
    if not _listed(spark, f"{root}/versions"):
        return spark.createDataFrame([], f"{_VERSIONS}, age int")
    order = Window.partitionBy("name", "part").orderBy(F.col("at").desc())
    rows = spark.read.schema(_VERSIONS).parquet(f"{root}/versions")
    return rows.withColumn("age", F.row_number().over(order))


def current(spark, root, name):
    """(part -> path, schema) of a table; one row per part."""
    rows = versions(spark, root).filter((F.col("name") == name) & (F.col("age") == 1)).collect()
    if not rows:
        raise FileNotFoundError(f"{name} was never published under {root}")
    fields = max(rows, key=lambda r: r["at"])["fields"]
    return {r["part"]: r["path"] for r in rows if r["path"]}, T.StructType.fromJson(json.loads(fields))


def read_current(spark, root, name, parts=None):
    """A stored table, or those of the named parts that it has."""
    paths, schema = current(spark, root, name)
    chosen = [path for part, path in paths.items() if parts is None or part in parts]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*chosen)


def stored_parts(spark, root, name):
    """The names of a table's parts; none if it was never published."""
    try:
        return set(current(spark, root, name)[0])
    except FileNotFoundError:
        return set()


def read_stored(spark, root, name, schema, parts):
    """The named parts of a stored table; no rows if it was never published."""
    try:
        return read_current(spark, root, name, parts)
    except FileNotFoundError:
        return spark.createDataFrame([], schema)


def read_staged(spark, rows, schema):
    """What was just staged, by the rows for ``publish``."""
    paths = [path for _, _, path, _ in rows if path]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def replaced(spark, root, rows):
    """The staged rows of whole tables, with all their other parts gone."""
    kept = {(name, part) for name, part, _, _ in rows}
    out = list(rows)
    for name, fields in {(r[0], r[3]) for r in rows}:
        try:
            stored, _ = current(spark, root, name)
        except FileNotFoundError:
            continue
        out += [(name, part, None, fields) for part in stored if (name, part) not in kept]
    return out


def prune(spark, root, keep=2):
    """Delete the folders of all but the last ``keep`` versions of every part."""
    # One row per superseded part.
    for row in versions(spark, root).filter(F.col("age") > max(1, keep)).collect():
        if row["path"]:
            _delete(spark, row["path"])


def write_replace(df, root, keep=None):
    """Write the frame as the only table under ``root``; readers of the version before
    are not disturbed, and the frame may read that version itself."""
    rows, _ = stage(df, root, "table")
    publish(df.sparkSession, root, rows)
    if keep is not None:
        prune(df.sparkSession, root, keep)


def read_table(spark, root):
    return read_current(spark, root, "table")


def materialize(df, label, partition_by=()):
    """The frame, computed once into the shared scratch folder and read back.

    For results that several later steps read: the plan is cut, and a lost
    executor costs no recomputation because the files remain.
    """
    path = scratch_dir(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def _partition(path, keys, values):
    return f"{path}/" + "/".join(f"{k}={v}" for k, v in zip(keys, values, strict=True))


def empty_partitions(spark, path, keys, scope):
    """Delete the named partitions (tuples of key values)."""
    for values in scope:
        _delete(spark, _partition(path, keys, values))


def swap_partitions(df, path, keys, scope=()):
    """Replace the partitions the frame has rows for; others stay.

    ``scope`` names the partitions that were reloaded, as tuples of key values: those
    whose files the write did not replace are emptied, as there is nothing left of
    them. The frame is computed once. Rows are rebalanced by partition first: few files
    per partition, and a partition with much more data than others is split over
    several tasks.
    """
    spark = df.sparkSession

    def files(values):
        return _listed(spark, _partition(path, keys, values))

    # Every write names its files anew.
    before = {values: files(values) for values in scope}
    (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    left = [values for values, names in before.items() if names and files(values) == names]
    empty_partitions(spark, path, keys, left)


def upsert(target, source, keys, update_cols=None, check=True):
    """Target with the source's rows merged in on the keys.

    New keys take all of the source's columns. Known keys take ``update_cols``
    (default: all) even where the source has NULL, and keep the rest. A key
    repeated in the source fails the job, as it would update a row twice.
    """
    values = [c for c in target.columns if c not in keys]
    updated = set(values if update_cols is None else update_cols)
    if check:
        source = unique_rows(source, keys)
    new = source.select(
        *keys,
        *[F.col(c).alias(f"_new_{c}") for c in values if c in source.columns],
        F.lit(True).alias("_in_source"),
    )
    joined = target.withColumn("_in_target", F.lit(True)).join(new, keys, "full_outer")
    take_new = F.col("_in_source").isNotNull()
    known = F.col("_in_target").isNotNull()

    def merged(c):
        if c not in source.columns:
            return F.col(c)
        condition = take_new if c in updated else take_new & ~known
        return F.when(condition, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    out = {c: merged(c) for c in values} | {k: F.col(k) for k in keys}
    return joined.select([out[c] for c in target.columns])


def merge_parts(spark, root, name, source, keys, by, update_cols=None, check=True, metrics=None):
    """Stage the stored table's parts that the source has rows for, with these rows
    merged in on the keys (``upsert``); what is read and written follows the source,
    not the table. ``by`` columns are among the keys. The source is computed once.
    Returns the rows for ``publish`` and the metrics of the merged parts."""
    fresh, seen = stage(source, f"{root}/staged", name, by, metrics=metrics)
    try:
        _, schema = current(spark, root, name)
    except FileNotFoundError:
        return fresh, seen
    if not fresh:
        return [], {}
    rows = spark.read.schema(source.schema).parquet(*[path for _, _, path, _ in fresh])
    stored = read_current(spark, root, name, {part for _, part, _, _ in fresh})
    return stage(upsert(stored, rows, keys, update_cols, check), root, name, by, metrics=metrics)


def write_lines(df, path, column="value"):
    """One text line per row; a sorted frame keeps its order across files."""
    df.select(column).write.mode("errorifexists").text(path)


def resume_point(state, source, full_refresh=False):
    """(season, week) a source got to; a full refresh restarts at its first
    season, week 0. A source without state is an error."""
    rows = state.filter(F.col("source") == source)
    if full_refresh:
        rows = rows.agg(F.min("last_season").alias("last_season"), F.lit(0).alias("last_week"))
        rows = rows.filter(F.col("last_season").isNotNull())
    row = rows.select("last_season", "last_week").first()
    if row is None:
        raise RuntimeError(f"no state for source {source}")
    return row["last_season"], row["last_week"]


def advance(state, source, season, week):
    """State with the source moved to a processed week."""
    mine = F.col("source") == source
    return state.withColumns(
        {
            "last_season": F.when(mine, F.lit(season)).otherwise(F.col("last_season")),
            "last_week": F.when(mine, F.lit(week)).otherwise(F.col("last_week")),
            "updated_at": F.when(mine, F.current_timestamp()).otherwise(F.col("updated_at")),
        }
    )
