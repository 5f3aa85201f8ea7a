"""Sharding by sampled splitters, native.

Rows are put in the order of a key (the text's CRC-32, then row hash), so equal
texts are neighbours. ``common.total_order`` draws key samples weighted by size,
takes their quantiles as splitters and range-partitions the rows, subdividing
keys that overfill a range. Exact sums per range give every row and group its place.

A group of equal keys is never cut unless it is larger than a shard. Groups over a
hundredth of a shard (so at most a hundred per shard) are dealt first, the largest to
the emptiest shard; all others, in key order, fill what is left of the shards: a group
goes to the shard that its middle falls in. The rows of groups larger than a shard are
units of their own and fill up with the small ones. So sizes differ by less than a
fiftieth of a shard, unless there are too few groups.

Defined cases: a NULL text has no bytes and CRC 0; equal rows get places of
their own; an empty table has no shards; shards may be empty when there are
fewer units than shards; extra columns are kept by ``sharded`` and do not matter.
"""

import heapq

from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.sources.tables import materialize

SHARDS = 24
#: Bytes a row counts for besides its text.
ROW_BYTES = 8
#: Groups over this share of a shard are dealt one by one.
LARGE_SHARE = 0.01


def _compact(docs):
    docs = common.with_columns(docs, {"doc_id": "bigint", "text": "string"})
    text = F.col("text").cast("binary")
    return docs.select(
        common.row_key(docs).alias("row_key"),
        common.row_key(docs)["a"].alias("tie"),
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    )


def _dealt(large, shards, rest):
    """Shard of each large group (key, bytes, rows), the largest first to the emptiest
    shard, and the limits up to which the shards take the ``rest`` of the bytes."""
    loads = [(0, k) for k in range(shards)]
    where = {}
    for key, size, _ in sorted(large, key=lambda g: (-g[1], g[0])):
        load, shard = heapq.heappop(loads)
        where[key] = shard
        heapq.heappush(loads, (load + size, shard))
    # The level to which the rest fills all shards that are below it.
    filled, level = sorted(loads), 0.0
    for n in range(1, shards + 1):
        level = (rest + sum(load for load, _ in filled[:n])) / n
        if n == shards or level <= filled[n][0]:
            break
    room = {shard: max(0.0, level - load) for load, shard in loads}
    limits, total = [], 0.0
    for shard in range(shards):
        total += room[shard]
        limits.append(total)
    return where, limits


def place(docs, shards=SHARDS):
    """row_key, doc_id, size, text_crc32, shard, slot of every row."""
    spark = docs.sparkSession
    rows = materialize(_compact(docs), "shard-rows")
    ordered = common.total_order(rows, "text_crc32", "tie", ("doc_id", "row_key"), weight="size")
    ordered = materialize(
        ordered.select("row_key", "doc_id", "size", "text_crc32", "_place", "_before"), "shard-ordered"
    )
    groups = materialize(
        ordered.groupBy("text_crc32").agg(
            F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"),
            F.min("_before").alias("_start"),
        ),
        "shard-groups",
    )
    count, total = groups.agg(F.sum("_rows"), F.sum("_bytes")).first()
    mean = (total or 0) / shards
    # At most shards / LARGE_SHARE groups are that large.
    large = groups.filter((F.col("_bytes") > LARGE_SHARE * mean) & (F.col("_bytes") <= mean))
    large = sorted(tuple(r) for r in large.select("text_crc32", "_bytes", "_rows").collect())
    where, limits = _dealt(large, shards, (total or 0) - sum(size for _, size, _ in large))

    # Bytes and rows of the large groups before each of them, in key order.
    sums = [(0, 0)]
    for _, size, n in large:
        sums.append((sums[-1][0] + size, sums[-1][1] + n))
    own_rows = {key: n for key, _, n in large}
    first, taken = {}, {}
    for key, _, _ in large:
        first[key] = taken.get(where[key], 0)
        taken[where[key]] = first[key] + own_rows[key]

    table = spark.createDataFrame(
        [(key, where[key], first[key]) for key, _, _ in large],
        "text_crc32 long, _large_shard int, _large_first long",
    )
    found = common.lookup(ordered, groups.join(F.broadcast(table), "text_crc32", "left"), ["text_crc32"], "_rows", count or 0)
    is_large = F.col("_large_shard").isNotNull()
    passed = common.position([key for key, _, _ in large], F.col("text_crc32")) if large else F.lit(0)

    def before(k):
        return F.get(F.array(*[F.lit(s[k]).cast("long") for s in sums]), passed)

    # Large groups that come before a row in key order take no part in filling up.
    whole = F.col("_bytes") <= F.lit(mean)
    start = F.when(whole, F.col("_start")).otherwise(F.col("_before")) - before(0)
    middle = start + F.when(whole, F.col("_bytes")).otherwise(F.col("size")) / F.lit(2)
    filled = F.least(common.position(limits[:-1], middle), F.lit(shards - 1)) if shards > 1 else F.lit(0)
    placed = materialize(
        found.select(
            "row_key", "doc_id", "size", "text_crc32", is_large.alias("_large"), "_large_first",
            F.when(is_large, F.col("_large_shard")).otherwise(filled).cast("int").alias("shard"),
            F.when(is_large, F.col("_place")).otherwise(F.col("_place") - before(1)).alias("_at"),
        ),
        "shard-placed",
    )
    # One row per shard, and one per large group.
    small = placed.filter(~F.col("_large")).groupBy("shard").agg(
        F.min("_at").alias("_first_at"), F.count(F.lit(1)).alias("_small")
    )
    firsts = placed.filter("_large").groupBy("text_crc32").agg(F.min("_at").alias("_group_at"))
    out = placed.join(F.broadcast(small), "shard", "left").join(F.broadcast(firsts), "text_crc32", "left")
    slot = F.when(
        F.col("_large"), F.coalesce("_small", F.lit(0)) + F.col("_large_first") + F.col("_at") - F.col("_group_at")
    ).otherwise(F.col("_at") - F.col("_first_at"))
    return out.select("row_key", "doc_id", "size", "text_crc32", "shard", slot.alias("slot"))


def sharded(docs, shards=SHARDS):
    """The rows of docs with shard and slot (named _shard, _slot where docs has such
    columns already)."""
    shard, slot = (c if c not in docs.columns else common.fresh(docs, c) for c in ("shard", "slot"))
    placed = materialize(place(docs, shards), "shard-places")
    plan = placed.select("row_key", F.col("shard").alias(shard), F.col("slot").alias(slot))
    return common.repeat_rows(docs, plan, plan.count())


def write_shards(docs, path, shards=SHARDS):
    """One folder per shard, rows in slot order within each file."""
    out = sharded(docs, shards)
    shard, slot = out.columns[-2:]
    out.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(
        shard
    ).mode("errorifexists").parquet(path)
