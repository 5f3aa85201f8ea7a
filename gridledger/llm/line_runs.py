"""Line dedup by levelled sorted runs of line hashes, native.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys of
at least LEAST_CHARS code points found in at least LEAST_DOCS documents lose all
their lines but those in the document with the largest id.

Lines are hashed once (128 bits). Documents come in batches of descending ids. The
runs hold every key seen so far once, with the document that had it first, which is
the one to keep it; they are tables bucketed and sorted by the hash, so that a batch
meets them bucket by bucket, by merge joins, and only the batch's keys are shuffled.
Each batch is anti-joined with all runs; what is left is its own run on level 0. Its
other sightings are counted beside it. FANOUT runs of a level are compacted into one
of the next, so there are few runs and a key is written again once per level only.
After the last batch, the counts tell the frequent keys, and the runs their keeper.

A very common line is one row per task and batch when counted. Where lines meet the
frequent keys, the keys with more than a common.HOT_SHARE-th of all lines (so at most
common.HOT_SHARE of them) are broadcast, and no other key is large. Texts are put together
from the stretches between dropped lines, in time that grows with the text alone.

Defined cases: a NULL or empty text is one empty line; rows with one id are one
document, and rows without an id one that comes before all others; all rows with the
largest id keep the line, every time it occurs; equal rows are treated alike; an
empty table gives no rows; extra columns are kept by ``deduped``.
"""

import uuid

from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.session import scratch_dir
from gridledger.sources.tables import materialize

LEAST_CHARS = 20
LEAST_DOCS = 3
#: Batches a whole table is taken in, and runs of a level that are compacted.
BATCHES = 4
FANOUT = 2
#: Dropped line numbers are broadcast up to this many bytes.
BROADCAST_BYTES = 32_000_000
HASH = ["h1", "h2"]
RUN = "h1 BIGINT, h2 BIGINT, keeper BIGINT, n_lines BIGINT"
SIGHTINGS = "h1 BIGINT, h2 BIGINT, keeper BIGINT, n_docs BIGINT, n_lines BIGINT"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line):
    return F.translate(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), _UPPER, _LOWER)


def split_lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs, least_chars=LEAST_CHARS):
    """row_key, doc_id, number and hash of every line that is long enough."""
    docs = common.with_columns(docs, {"doc_id": "bigint", "text": "string"})
    row = common.row_key(docs)
    lines = docs.select(
        row.alias("row_key"), F.col("doc_id").cast("bigint"),
        F.posexplode(split_lines(F.col("text"))).alias("number", "line"),
    ).withColumn("key", line_key(F.col("line")))
    return lines.filter(F.length("key") >= least_chars).select(
        "row_key", "doc_id", "number",
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(23), "key").alias("h2"),
    )


class LineRuns:
    """The keys of all lines seen so far, under a shared folder.

    A batch is committed by one small file written last; a batch that was committed
    before is left out, so that a failed job can be repeated. ``LineRuns(spark, root)``
    on an existing folder goes on after its last commit.
    """

    def __init__(self, spark, root, buckets=None, fanout=FANOUT):
        self.spark, self.root, self.fanout = spark, root, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.batches, self.runs, self.again, self.names = [], [], [], {}
        try:
            commits = spark.read.parquet(f"{root}/commits")
        except Exception as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return
        # One row per batch.
        rows = commits.orderBy("number").collect()
        self.batches = [r["batch"] for r in rows]
        self.again = [r["again"] for r in rows]
        self.buckets = rows[-1]["buckets"]
        self.runs = [(r["level"], r["path"]) for r in rows[-1]["runs"]]

    def _table(self, path, columns):
        """The bucketed table at a path, which may be still empty."""
        if path not in self.names:
            name = f"line_run_{uuid.uuid4().hex}"
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (h1, h2) "
                f"SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
            self.names[path] = name
        return self.spark.table(self.names[path])

    def _written(self, df, label, columns):
        path = f"{self.root}/{label}-{uuid.uuid4().hex}"
        empty = self._table(path, columns)
        df.select(*empty.columns).write.insertInto(self.names[path])
        self.spark.catalog.refreshTable(self.names[path])
        return path, self.spark.table(self.names[path])

    def tables(self):
        return [self._table(path, RUN) for _, path in self.runs]

    def add(self, batch, lines):
        """Take in a batch of hashed lines; returns whether it was new."""
        if batch in self.batches:
            return False
        sightings = lines.groupBy(*HASH).agg(
            F.max("doc_id").alias("keeper"),
            # Ids that are missing are one document.
            (F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))).alias("n_docs"),
            F.count(F.lit(1)).alias("n_lines"),
        )
        _, seen = self._written(sightings, "batch", SIGHTINGS)
        fresh = seen
        for run in self.tables():
            fresh = fresh.join(run.hint("merge"), HASH, "left_anti")
        path, own = self._written(fresh, "run-0", RUN)
        first = own.select(*HASH, F.lit(1).alias("first")).hint("merge")
        again = seen.join(first, HASH, "left").select(
            *HASH, (F.col("n_docs") - F.coalesce("first", F.lit(0))).alias("n_docs"),
            F.when(F.col("first").isNull(), F.col("n_lines")).otherwise(0).alias("n_lines"),
        )
        counted = f"{self.root}/again-{uuid.uuid4().hex}"
        again.filter("n_docs > 0").write.parquet(counted)
        self.runs.append((0, path))
        self._compact()
        self.batches.append(batch)
        self.again.append(counted)
        self._commit(batch, counted)
        return True

    def _compact(self):
        """Merge the runs of a level that is full; their keys are disjoint."""
        level = 0
        while sum(at == level for at, _ in self.runs) >= self.fanout:
            full = [path for at, path in self.runs if at == level]
            merged = self._table(full[0], RUN)
            for path in full[1:]:
                merged = merged.unionByName(self._table(path, RUN))
            merged = merged.repartition(self.buckets, *HASH)
            path, _ = self._written(merged, f"run-{level + 1}", RUN)
            self.runs = [(at, p) for at, p in self.runs if at != level] + [(level + 1, path)]
            level += 1

    def _commit(self, batch, again):
        runs = F.array(
            *[F.struct(F.lit(at).alias("level"), F.lit(path).alias("path")) for at, path in self.runs]
        )
        self.spark.range(1).select(
            F.lit(len(self.batches)).alias("number"), F.lit(batch).alias("batch"),
            F.lit(again).alias("again"), F.lit(self.buckets).alias("buckets"), runs.alias("runs"),
        ).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def frequent(self, least_docs=LEAST_DOCS):
        """Hash, keeper, number of documents and of lines of the keys found in at
        least so many documents (two or more)."""
        counts = self.spark.read.schema("h1 BIGINT, h2 BIGINT, n_docs BIGINT, n_lines BIGINT").parquet(*self.again)
        counts = counts.groupBy(*HASH).agg(F.sum("n_docs").alias("_docs"), F.sum("n_lines").alias("_lines"))
        counts = materialize(counts.filter(F.col("_docs") + 1 >= least_docs), "lines-frequent")
        found = [
            counts.join(run, HASH).select(
                *HASH, "keeper", (F.col("_docs") + 1).alias("n_docs"),
                (F.col("_lines") + F.col("n_lines")).alias("n_lines"),
            )
            for run in self.tables()
        ]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out

    def close(self):
        """Forget the table names; the files stay."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = {}


def _descending(lines, batches):
    """Conditions that deal the ids into batches, the largest ids first. Quantiles of
    the lines' ids only decide how large the batches are."""
    shares = [i / batches for i in range(1, batches)]
    bounds = lines.agg(F.percentile_approx("doc_id", shares, 1_000)).first()[0] or []
    edges = [None, *sorted(set(bounds), reverse=True), None]
    conditions = []
    for above, from_ in zip(edges[:-1], edges[1:], strict=True):
        inside = F.lit(True)
        if above is not None:
            inside &= F.coalesce(F.col("doc_id") < above, F.lit(True))
        if from_ is not None:
            inside &= F.coalesce(F.col("doc_id") >= from_, F.lit(False))
        conditions.append(inside)
    return conditions


def dropped_lines(docs, batches=BATCHES, least_chars=LEAST_CHARS, least_docs=LEAST_DOCS):
    """row_key and the ascending numbers (from 0) of the lines it loses; written."""
    spark = docs.sparkSession
    lines = materialize(hashed_lines(docs, least_chars), "lines-hashed")
    index = LineRuns(spark, scratch_dir(spark, "line-runs"))
    for number, inside in enumerate(_descending(lines, batches)):
        index.add(f"batch-{number}", lines.filter(inside))
    frequent = materialize(index.frequent(least_docs), "lines-keepers").drop("n_docs")
    index.close()
    hot_from = lines.count() / common.HOT_SHARE
    hot = frequent.filter(F.col("n_lines") >= hot_from)
    rest = frequent.filter(F.col("n_lines") < hot_from).drop("n_lines")
    met = lines.join(F.broadcast(hot), HASH, "left")
    common_lines = met.filter("n_lines is not null")
    others = met.filter("n_lines is null").drop("keeper", "n_lines").join(rest, HASH)
    columns = ["row_key", "doc_id", "number", "keeper"]
    lost = common_lines.select(*columns).unionByName(others.select(*columns))
    lost = lost.filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return materialize(
        lost.groupBy("row_key").agg(F.array_sort(F.collect_set("number")).alias("gone")), "lines-gone"
    )


def _kept(text, gone):
    """The lines between the dropped ones, joined."""
    # The list of lines is bound to a variable once: it is split once, not per stretch.
    def between(lines):
        ends = F.concat(gone, F.array(F.size(lines)))
        starts = F.concat(F.array(F.lit(-1)), gone)
        stretch = F.arrays_zip(starts.alias("start"), ends.alias("end"))
        return F.flatten(
            F.transform(stretch, lambda s: F.slice(lines, s["start"] + 2, s["end"] - s["start"] - 1))
        )

    return F.array_join(F.get(F.transform(F.array(split_lines(text)), between), F.lit(0)), "\n")


def marked(docs, **options):
    """Docs with n_lines, n_dropped and kept, the text that stays (named _n_lines,
    ... where docs has such columns already)."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    names = [c if c not in docs.columns else common.fresh(docs, c) for c in ("n_lines", "n_dropped", "kept")]
    row, lost = common.fresh(docs, "row_key", "gone")
    gone = dropped_lines(docs, **options).toDF(row, lost)
    rows, numbers = gone.agg(F.count(F.lit(1)), F.sum(F.size(lost))).first()
    small = 16 * rows + 4 * (numbers or 0) <= BROADCAST_BYTES
    docs = common.with_columns(docs.withColumn(row, common.row_key(docs)), {"text": "string"})
    met = docs.join(F.broadcast(gone) if small else gone, row, "left")
    kept = F.when(F.col(lost).isNull(), F.coalesce("text", F.lit(""))).otherwise(
        _kept(F.col("text"), F.col(lost))
    )
    return met.select(
        *columns,
        F.size(split_lines(F.col("text"))).cast("long").alias(names[0]),
        F.coalesce(F.size(lost), F.lit(0)).cast("long").alias(names[1]),
        kept.alias(names[2]),
    )


def deduped(docs, **options):
    """The rows of docs with the text that stays; columns as in docs."""
    found = marked(docs, **options)
    kept = F.when(F.col("text").isNotNull(), F.col(f"`{found.columns[-1]}`")).alias("text")
    return found.select(*[kept if c == "text" else F.col(f"`{c}`") for c in docs.columns])
