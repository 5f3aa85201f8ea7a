"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash of their id and may be read twice,
one pass after the other. A reading's virtual finish time is the source's words
up to its end, divided by the source's weight. All readings are sorted by that
time over all sources and taken until the budget is used up: the sort interleaves
the sources in proportion to their weights, and a source that runs out after two
passes leaves its share to the others.

No source is handled in one task: its prefix sums run over hash buckets of the
shuffled order, and the global sort is ``common.total_order``.

Defined cases: a NULL text has no words and a document without words is never
taken; a NULL source sorts last; equal rows are shuffled as documents of their own;
ties in finish time go to the first source, then the earlier reading; an empty
table gives an empty mix; extra columns are kept by ``mixed``.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.sources.tables import materialize

WEIGHTS = (5, 2, 1)
#: Words of the mix per word of all documents.
SHARE = 1.5
PASSES = 2
#: Runs of anything but white space, the characters listed one by one.
WORD = r"[^\x20\x09\x0A\x0B\x0C\x0D]+"
ROWS_PER_BUCKET = 1_000
MAX_BUCKETS = 65_536


def _compact(docs):
    docs = common.with_columns(
        docs, {"doc_id": "bigint", "text": "string", "source": "string"}
    )
    return docs.select(
        common.row_key(docs).alias("row_key"),
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit("mix"), F.col("doc_id").cast("string"))).alias("shuffle"),
    )


def targets(rows, weights=WEIGHTS, share=SHARE, passes=PASSES):
    """Per source: number, weight, source_size and target. Runs over the sources'
    totals: sources are filled in the order in which they run out."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = totals.withColumn(
        "_number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    )
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("_number") - 1) % len(weights) + 1
    )
    limit = F.col("source_size") * passes
    full = Window.orderBy(F.col("_limit") / F.col("_weight"), "_number")
    earlier = full.rowsBetween(Window.unboundedPreceding, -1)
    later = full.rowsBetween(0, Window.unboundedFollowing)
    filled = numbered.withColumns({"_weight": weight, "_limit": limit}).withColumn(
        # What a unit of weight gets if all sources before this one have run out.
        "_level",
        (F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
         - F.coalesce(F.sum("_limit").over(earlier), F.lit(0)))
        / F.sum("_weight").over(later),
    )
    level = F.max(F.when(F.col("_limit") > F.col("_level") * F.col("_weight"), F.col("_level")))
    return filled.withColumn("_level", level.over(Window.partitionBy())).select(
        "source", "_number", "_weight", "source_size",
        F.least(
            F.col("_limit").cast("double"),
            F.coalesce(F.col("_level") * F.col("_weight"), F.col("_limit").cast("double")),
        ).alias("target"),
    )


def mix(docs, weights=WEIGHTS, share=SHARE, passes=PASSES):
    """row_key, doc_id, size, source_size, target, times (readings taken) and taken
    (words taken) of every document."""
    rows = materialize(_compact(docs), "mix-rows")
    # One row per source.
    sources = materialize(targets(rows, weights, share, passes), "mix-sources")
    most = rows.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    buckets = max(1, min(MAX_BUCKETS, -(-most // ROWS_PER_BUCKET)))
    rows = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    bucket = F.floor(F.conv(F.substring("shuffle", 1, 6), 16, 10).cast("long") * buckets / 2**24)
    rows = rows.withColumn("_bucket", bucket)
    inside = Window.partitionBy("_number", "_bucket").orderBy("shuffle", "doc_id", "size", "row_key")
    sums = rows.groupBy("_number", "_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("_number").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # At most MAX_BUCKETS rows per source.
    sums = sums.select("_number", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    queued = rows.withColumns(
        {
            "_end": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            "_row": F.row_number().over(inside),
        }
    ).join(sums, ["_number", "_bucket"])
    queued = materialize(
        queued.withColumns(
            {"_end": F.col("_end") + F.col("_base"), "_row": F.struct("_number", "_bucket", "_row")}
        ).select(
            "_row", "row_key", "doc_id", "size", "_number", "_weight", "source_size", "target", "_end"
        ),
        "mix-queue",
    )
    reading = queued.filter("size > 0").withColumn(
        "_pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1)))
    )
    reading = materialize(
        reading.select(
            "_row", "size", "_number", "_pass",
            ((F.col("_end") + F.col("_pass") * F.col("source_size")) / F.col("_weight")).alias("_finish"),
        ),
        "mix-readings",
    )
    budget = rows.agg(F.sum("size")).first()[0] or 0
    ordered = common.total_order(reading, "_finish", ties=("_number", "_pass"), weight="size")
    taken = ordered.filter(F.col("_before") + F.col("size") <= F.lit(float(share)) * budget)
    times = taken.groupBy("_row").agg(F.count(F.lit(1)).alias("times"))
    return queued.join(times, "_row", "left").select(
        "row_key", "doc_id", "size", "source_size", "target",
        F.coalesce("times", F.lit(0)).alias("times"),
        (F.coalesce("times", F.lit(0)) * F.col("size")).alias("taken"),
    )


def mixed(docs, weights=WEIGHTS, share=SHARE, passes=PASSES):
    """The rows of docs, each as often as the mix takes it; columns as in docs."""
    plan = materialize(mix(docs, weights, share, passes).filter("times > 0"), "mix-plan")
    times = materialize(plan.groupBy("row_key").agg(F.sum("times").alias("_times")), "mix-times")
    key, count = common.fresh(docs, "row_key", "times")
    keyed = docs.withColumn(key, common.row_key(docs))
    rows = times.count()
    if plan.count() > rows:  # equal rows: their readings are counted together
        keyed = keyed.dropDuplicates([key])
    return (
        keyed.join(common.by_size(times.toDF(key, count), rows), key)
        .withColumn(count, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count))))
        .select(*[f"`{c}`" for c in docs.columns])
    )
