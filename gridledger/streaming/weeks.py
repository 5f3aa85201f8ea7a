"""Incremental weekly loads with Structured Streaming."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from gridledger.sources import tables

KEYS = ["season", "week"]


#: What a stream of arrived files shows of them; their content is not read.
_ARRIVED = "path string, modificationTime timestamp, length bigint, content binary"


def stream_weeks(
    spark, source, target, checkpoint, schema, transform=None, fmt="parquet", options=None,
    after=None,
):
    """Load the weeks that received new files, then stop.

    ``source`` has season=/week= folders. New files may hold part of a week only, so the
    stream just names them and their folders; the touched weeks are read once, completely
    (only their folders), and swapped into the target, and a week of which the transform
    leaves nothing is emptied. Loading a week twice or in parts therefore ends in the same
    table. Progress is kept in the stream's checkpoint, which belongs in the cluster's
    shared folder. ``after`` is given the sorted (season, week) pairs of each finished
    batch.
    """

    reading = options or {}

    def load(batch, _):
        # One row per touched week folder; names of files only, no content.
        touched = sorted((r["season"], r["week"]) for r in batch.distinct().collect())
        if not touched:
            return
        folders = [f"{source}/season={season}/week={week}" for season, week in touched]
        weeks = (
            spark.read.schema(schema).options(**reading).option("basePath", source).format(fmt)
            .load(folders)
        )
        fresh = transform(weeks) if transform else weeks
        tables.swap_partitions(fresh, target, KEYS, scope=touched)
        if after:
            after(touched)

    query = (
        spark.readStream.schema(f"{_ARRIVED}, season int, week int")
        .format("binaryFile")
        .load(source)
        .select(*KEYS)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


# Weeks of a season and bits of a bitmap aggregate: 512 seasons find room in one.
_WEEKS, _BITS = 64, 32_768


def observed_weeks(df):
    """The frame, and an observation of the (season, week) pairs that pass through it."""
    seen = Observation()
    place = F.pmod(F.col("season") * _WEEKS + F.col("week"), F.lit(_BITS)).cast("long")
    metrics = {
        "weeks": F.hex(F.bitmap_construct_agg(place)), "first": F.min("season"), "last": F.max("season"),
        "odd": F.count_if(~F.col("week").between(0, _WEEKS - 1) | F.col("week").isNull() | F.col("season").isNull()),
    }
    return df.observe(seen, *[metric.alias(name) for name, metric in metrics.items()]), seen


def weeks_seen(observation):
    """The sorted pairs, once the write that they pass through is done."""
    metrics = tables.seen_metrics(observation)
    first = metrics.get("first")
    if metrics.get("odd"):
        raise ValueError(f"{metrics['odd']} rows have no season, or a week outside 0 to {_WEEKS - 1}")
    if first is None:
        return []
    if metrics["last"] - first >= _BITS // _WEEKS:
        raise ValueError(f"seasons from {first} to {metrics['last']} are too far apart")
    start = first * _WEEKS
    places = [
        8 * at + bit for at, byte in enumerate(bytes.fromhex(metrics["weeks"])) for bit in range(8) if byte >> bit & 1
    ]
    return sorted(divmod(start + (place - start) % _BITS, _WEEKS) for place in places)


def later_weeks(df, state, source):
    """Rows after the week the source got to; all of a source without state."""
    mine = state.filter(F.col("source") == source).select("last_season", "last_week").first()
    if mine is None:
        return df
    season, week = mine["last_season"], mine["last_week"]
    return df.filter((F.col("season") > season) | ((F.col("season") == season) & (F.col("week") > week)))


def load_later_weeks(spark, df, target, state_root, source, transform=None):
    """Swap in the weeks after the stored resume point and move it to the last.

    The rows are computed once: the weeks they come from, and those that the transform
    leaves something of, are observed while they are written.

    The state table is written after the weeks are in place: a load that is
    repeated after a crash swaps the same weeks again. Returns the number of
    weeks loaded.
    """
    try:
        state = tables.read_table(spark, state_root)
    except FileNotFoundError:
        from gridledger import schemas

        state = spark.createDataFrame([], schemas.ETL_STATE)
    rows, source_weeks = observed_weeks(later_weeks(df, state, source))
    fresh, stored_weeks = observed_weeks(transform(rows) if transform else rows)
    tables.swap_partitions(fresh, target, KEYS)
    touched = weeks_seen(source_weeks)
    if not touched:
        return 0
    gone = sorted(set(touched) - set(weeks_seen(stored_weeks)))
    tables.empty_partitions(spark, target, KEYS, gone)
    season, week = touched[-1]
    if state.filter(F.col("source") == source).isEmpty():
        state = state.unionByName(
            spark.range(1).select(
                F.lit(source).alias("source"), F.lit(season).alias("last_season"),
                F.lit(week).alias("last_week"), F.current_timestamp().alias("updated_at"),
            )
        )
    tables.write_replace(tables.advance(state, source, season, week), state_root, keep=2)
    return len(touched)
