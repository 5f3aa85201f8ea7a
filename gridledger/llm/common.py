"""Helpers shared by the corpus operators: keys, total order, size-checked joins,
bounded groups, connected components."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridledger.sources.tables import materialize

#: A key table is broadcast up to this many bytes, at ROW_BYTES for a key and what hash
#: tables add, and the size of further columns; beyond it the join is a shuffled one.
BROADCAST_BYTES = 48_000_000
ROW_BYTES = 64
#: Splitters per total order: bounds the driver's list and the plan's literals.
MAX_RANGES = 4096
#: Range a total order aims at, while there are fewer than MAX_RANGES ranges.
ROWS_PER_RANGE = 2_000
SAMPLES_PER_RANGE = 64
#: Keys with more than one row in so many are hot; there are at most so many of them.
HOT_SHARE = 2_000
#: Rows of an Arrow batch that Python looks at together.
SLICE_ROWS = 250
#: Bytes of an Arrow batch, where the session does not bound them itself.
BATCH_BYTES = 8_000_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bound_batches(spark):
    """Bound the bytes of the session's Arrow batches, if they are not: rows alone say
    little about whole texts."""
    if int(spark.conf.get(_BATCH_SETTING).rstrip("b")) >= 2**31 - 1:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def fresh(df, *stems):
    """Column names like the stems that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    names = []
    for stem in stems:
        name = f"_{stem}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names if len(names) > 1 else names[0]


def with_columns(df, wanted):
    """The frame with columns it lacks added as NULL of the given type."""
    have = {c.lower() for c in df.columns}
    return df.withColumns(
        {c: F.lit(None).cast(kind) for c, kind in wanted.items() if c.lower() not in have}
    )


def text_key(column="text"):
    """128-bit identity of a text, as a struct of two longs. Two different texts among n
    share one with a probability below n * n / 6.8e38."""
    return _identity([F.col(column)])


def row_key(df):
    """128-bit identity of a whole row, as a struct of two longs; equal rows share it."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if _unhashable(field.dataType):
            column = F.to_json(column if isinstance(field.dataType, (T.MapType, T.VariantType)) else F.struct(column))
        # A NULL does not enter the hash, so its place does.
        columns += [column, F.when(column.isNull(), F.lit(len(columns)))]
    return _identity(columns)


def _identity(columns):
    """Two 64-bit hashes under different seeds."""
    return F.struct(
        F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(0x9E3779B97F4A7C15 - 2**64), *columns).alias("b")
    )


def _unhashable(kind):
    """Whether a type is, or holds, a map or variant."""
    if isinstance(kind, T.ArrayType):
        return _unhashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_unhashable(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def by_size(keys, rows, most=None):
    """Keys marked for broadcast while their counted rows are within the bound: so many
    rows, or BROADCAST_BYTES for keys and short columns."""
    wide = ROW_BYTES + 8 * (len(keys.columns) - 1)
    return F.broadcast(keys) if rows <= (most or BROADCAST_BYTES // wide) else keys


def lookup(rows, table, keys, weight, total):
    """Written rows left-joined with a table of unique keys, also where very many rows
    ask for one key: keys whose ``weight`` (rows that ask for them) is at least a
    HOT_SHARE-th of the total are broadcast, which are HOT_SHARE at most; the others
    are joined by a shuffle. The weight is dropped."""
    values = [c for c in table.columns if c not in (*keys, weight)]
    hot_from = total / HOT_SHARE
    hot = table.filter(F.col(weight) >= hot_from).select(*keys, F.struct(*values).alias("_hot"))
    rest = table.filter(F.col(weight) < hot_from).select(*keys, *values)
    met = rows.join(F.broadcast(hot), keys, "left")
    found = met.filter("_hot is not null").select(*rows.columns, *[f"_hot.{v}" for v in values])
    others = met.filter("_hot is null").select(*rows.columns).join(rest, keys, "left")
    return found.unionByName(others.select(*rows.columns, *values))


def keep_rows(docs, keys, how):
    """Rows of docs whose row key is (left_semi) or is not (left_anti) in the
    written one-column table ``keys``; columns as in docs."""
    key = fresh(docs, "row_key")
    named = keys.toDF(key)
    return (
        docs.withColumn(key, row_key(docs))
        .join(by_size(named, keys.count()), key, how)
        .select(*[f"`{c}`" for c in docs.columns])
    )


def repeat_rows(docs, plan, rows):
    """Docs joined with a written plan (row key first, further columns after);
    a plan with several entries for a key gives the row as often.

    Equal rows of docs are taken once, so that n copies with n entries give n
    rows; the plan must hold an entry for each. ``rows`` is the plan's count.
    """
    key = fresh(docs, "row_key")
    keyed = docs.withColumn(key, row_key(docs))
    plan = plan.withColumnRenamed(plan.columns[0], key)
    if plan.select(key).distinct().count() < rows:
        keyed = keyed.dropDuplicates([key])
    return keyed.join(by_size(plan, rows), key).drop(key)


def unit(column):
    """Hash bits of a long column as a uniform number in [0, 1)."""
    return column.bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def position(values, column):
    """Number of the sorted literal values that are <= the column."""
    steps = [1 << k for k in reversed(range(max(1, len(values).bit_length())))]
    literal = F.array(*[F.lit(v) for v in values])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(literal, at + step - 1) <= column, at + step).otherwise(at),
    )


def total_order(df, key, tie=None, ties=(), weight=None, rows_per_range=ROWS_PER_RANGE):
    """Rows of a written frame with their place in a total order, without one sort
    in one task: adds _range, _place (from 0) and, with a weight, _before (the
    weights of all earlier rows).

    Key samples are drawn with a probability in proportion to the weight; their
    quantiles are the splitters. A key that takes up several splitters is
    overfull: its rows are subdivided by ``tie``, a long column of hash bits.
    Order: key, tie, ties. The number of splitters is bounded by MAX_RANGES.
    """
    amount = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows, total = df.agg(F.count(F.lit(1)), F.sum(amount)).first()
    ranges = max(1, min(MAX_RANGES, math.ceil(rows / rows_per_range)))
    draw = unit(F.xxhash64(F.lit(7), *[F.col(c) for c in ([tie] if tie else []) + [key, *ties]]))
    splitters = None
    if ranges > 1:
        share = F.lit(ranges * SAMPLES_PER_RANGE / (total or 1.0)) * amount
        shares = [i / ranges for i in range(1, ranges)]
        splitters = (
            df.filter(draw < share)
            .agg(F.percentile_approx(key, shares, max(10_000, 20 * ranges)))
            .first()[0]
        )
    splitters = splitters or []
    values = sorted(set(splitters))
    slot = position(values, F.col(key)) if values else F.lit(0)
    placed = df.withColumn("_range", slot)
    taken = Counter(splitters)
    repeats = [taken[v] for v in values]
    if tie and any(n > 1 for n in repeats):
        at = F.col("_range") - 1
        parts = F.get(F.array(*[F.lit(n) for n in repeats]), at)
        inside = F.get(F.array(*[F.lit(v) for v in values]), at) == F.col(key)
        part = F.floor((F.col(tie) / F.lit(2.0**64) + 0.5) * parts)
        sub = F.when(inside & (parts > 1), F.least(part, parts - 1)).otherwise(parts)
        placed = placed.withColumn(
            "_range", F.col("_range") * (MAX_RANGES + 1) + F.coalesce(sub, F.lit(0))
        )
    placed = placed.withColumn("_range", F.col("_range").cast("long"))
    order = [key, *([tie] if tie else []), *ties]
    window = Window.partitionBy("_range").orderBy(*order)
    running = window.rowsBetween(Window.unboundedPreceding, 0)
    inner = {"_place": F.row_number().over(window).cast("long") - 1}
    totals = [F.count(F.lit(1)).alias("_n")]
    if weight:
        inner["_before"] = F.sum(weight).over(running) - F.col(weight)
        totals.append(F.sum(weight).alias("_w"))
    # One row per range: at most MAX_RANGES splitters, each subdivided into as
    # many parts as it took splitters.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_range").agg(*totals)
    starts = starts.select(
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        *([F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_w0")] if weight else []),
    )
    out = placed.withColumns(inner).join(F.broadcast(starts), "_range")
    out = out.withColumn("_place", F.col("_place") + F.col("_n0")).drop("_n0")
    if weight:
        out = out.withColumn("_before", F.col("_before") + F.col("_w0")).drop("_w0")
    return out


# --- groups of bounded size -------------------------------------------------


def blocked(members, group, key, size):
    """Members of every group, cut into blocks of about ``size``, once for each
    pair of blocks of the group; adds _unit (the pair) and _left, _right (whether
    the member is in the pair's first or second block).

    A group up to the size is one unit. A larger one is compared block against
    block, so that a unit holds two blocks however large the group is.
    """
    counts = members.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    large = counts.filter(F.col("_n") > size).select(
        group, F.ceil(F.col("_n") / size).cast("int").alias("_blocks")
    )
    placed = members.join(large, group, "left")
    block = F.pmod(F.xxhash64(F.lit(11), F.col(key)), F.col("_blocks")).cast("int")
    placed = placed.withColumn("_block", F.when(F.col("_blocks").isNull(), 0).otherwise(block))
    placed = placed.withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_blocks"), F.lit(1)) - 1))
    )
    low, high = F.least("_block", "_other"), F.greatest("_block", "_other")
    return placed.select(
        "*",
        F.xxhash64(F.col(group), low, high).alias("_unit"),
        (F.col("_block") == low).alias("_left"),
        (F.col("_block") == high).alias("_right"),
    ).drop("_blocks", "_block", "_other")


def slices(batches, rows=SLICE_ROWS):
    """Arrow batches in pieces, so that a worker holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sorted_groups(batches, key):
    """Pandas batches sorted by a key, as (key, frame) per group; only one group
    and one batch are held."""
    import pandas as pd

    held = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[key].to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(batch)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.iloc[start:end]
            if held and held[-1][key].iloc[0] != values[start]:
                yield held[0][key].iloc[0], held[0] if len(held) == 1 else pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield held[0][key].iloc[0], held[0] if len(held) == 1 else pd.concat(held)


def joined_sets(n, left, right):
    """Smallest index reachable from each of n nodes over the links left-right."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        root = root[root]
        if np.array_equal(before, root) and np.array_equal(root[left], root[right]):
            break
    while not np.array_equal(root, root[root]):
        root = root[root]
    return root


# --- connected components ---------------------------------------------------


def components(edges, label):
    """node -> root (smallest node of its component) for edges (a, b) of longs.

    Alternating large-star and small-star steps: every node hands its neighbours
    to its smallest one, so hubs shrink to stars and the number of rounds grows
    with the logarithm of the longest chain. Edges only shrink; each round is
    written to the shared folder. Nothing is collected but counts.
    """
    edges = materialize(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        label,
    )
    while True:
        # A node with very many neighbours is looked up, not gathered.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degree = F.count(F.lit(1)).alias("_degree")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("_least"), degree)
        large = lookup(both, least, ["a"], "_degree", 2 * edges.count())
        large = large.filter("b > a").select(F.col("b").alias("a"), "_least")
        large = materialize(large.toDF("a", "b").filter("a <> b").distinct(), label)
        least = large.groupBy("a").agg(F.min("b").alias("_least"), degree)
        small = lookup(large, least, ["a"], "_degree", large.count()).select(
            F.explode(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("_least").alias("b")),
                    F.struct(F.col("a").alias("a"), F.col("_least").alias("b")),
                )
            ).alias("e")
        )
        step = materialize(small.select("e.a", "e.b").filter("a <> b").distinct(), label)
        # Done when every node points at one root and no root points anywhere.
        done = step.agg(
            (F.count(F.lit(1)) == F.count_distinct("a")).alias("one"),
        ).first()["one"]
        if done and step.join(step.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return step.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = step
