"""Benchmark decontamination by a broadcast set of test n-grams, native.

Texts are lower-cased (A-Z only) and cut into runs of digits, letters and
non-ASCII characters. A window is ten consecutive words of an item, or all words
of a shorter one. The distinct windows are the hash set: it is broadcast while its
counted rows are within a bound, and joined by shuffle beyond it. Documents are
scanned window by window inside one generated stage; a hash hit is verified word
by word. Only hits leave the scan.

Defined cases: NULL and wordless texts have no words, no hits, and stay; wordless
items match nothing; an item_id that is NULL hits but is not listed; repeated items
count once per id; equal documents get equal results; an empty benchmark hits
nothing; extra columns are kept by ``clean_documents`` and ``without_spans``.
"""

from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.sources.tables import materialize

WINDOW = 10
#: What stands between words: ASCII but digits and letters. Characters are listed one
#: by one, which Java's patterns look up in a table, unlike ranges.
_OTHER = "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum())
GAP = f"[{_OTHER}]+"
WORD = f"[^{_OTHER}]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Distinct windows up to which the set is broadcast (about 200 bytes each).
BROADCAST_WINDOWS = 250_000


def lowered(text):
    """A-Z in lower case, other letters as they are."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def words(text):
    return F.array_remove(F.split(lowered(text), GAP), "")


def item_windows(benchmark, window=WINDOW):
    """gram (array of words), gram_key, length, items (array of ids as strings)."""
    benchmark = common.with_columns(benchmark, {"item_id": "bigint", "text": "string"})
    item = benchmark.select(F.col("item_id").cast("string").alias("item"), words("text").alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    grams = (
        item.filter(F.size("w") > 0)
        .withColumn("at", F.explode(starts))
        .select("item", F.slice("w", F.col("at"), window).alias("gram"))
        .distinct()
    )
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items")).select(
        "gram", F.xxhash64("gram").alias("gram_key"), F.size("gram").alias("length"), "items"
    )


def hits(docs, benchmark, window=WINDOW):
    """row_key, at (number of the first word), length, gram_key of every occurrence of
    an item window in a document; and the written windows."""
    grams = materialize(item_windows(benchmark, window), "item-windows")
    lengths = [r[0] for r in grams.select("length").distinct().collect()]  # at most `window`
    docs = common.with_columns(docs, {"text": "string"})
    if not lengths:
        lengths = [window]
    scanned = docs.select(common.row_key(docs).alias("row_key"), words("text").alias("w"))
    scanned = scanned.withColumn("n", F.size("w")).filter(F.col("n") >= min(lengths))
    if len(lengths) == 1:
        scanned = scanned.withColumn("length", F.lit(lengths[0]))
    else:
        scanned = scanned.withColumn("length", F.explode(F.array(*map(F.lit, lengths))))
        scanned = scanned.filter("n >= length")
    at = F.explode(F.sequence(F.lit(1), F.col("n") - F.col("length") + 1))
    gram = F.slice("w", F.col("at"), F.col("length"))
    windows = scanned.withColumn("at", at).select(
        "row_key", "at", F.xxhash64(gram).alias("gram_key"), gram.alias("found")
    )
    known = common.by_size(grams.drop("items"), grams.count(), BROADCAST_WINDOWS)
    found = windows.join(known, "gram_key").filter("found = gram")
    return materialize(found.select("row_key", "at", "length", "gram_key").distinct(), "item-hits"), grams


def hit_spans(found):
    """row_key -> n_hit (words inside any occurrence) and spans (first and last word of
    each stretch of hit words). A group is the hits of one text."""
    spans = F.array_sort(
        F.collect_set(F.struct("at", (F.col("at") + F.col("length")).alias("end")))
    )
    empty = F.array().cast("array<struct<at:int,end:int>>")
    merged = F.aggregate(
        "occurrences",
        empty,
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= x["at"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.get(done, F.size(done) - 1)["at"].alias("at"),
                        F.greatest(F.get(done, F.size(done) - 1)["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(x["at"].alias("at"), x["end"].alias("end"))))),
    )
    grouped = found.groupBy("row_key").agg(spans.alias("occurrences"))
    grouped = grouped.select("row_key", merged.alias("spans"))
    total = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["at"])
    return grouped.select("row_key", total.cast("long").alias("n_hit"), "spans")


def hit_items(found, grams):
    """row_key -> items: sorted ids of the items with occurring windows."""
    return (
        found.select("row_key", "gram_key").distinct()
        .join(grams.select("gram_key", F.explode("items").alias("item")), "gram_key")
        .groupBy("row_key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def report(docs, benchmark, window=WINDOW):
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found, grams = hits(docs, benchmark, window)
    docs = common.with_columns(docs, {"doc_id": "bigint", "text": "string"})
    counted = docs.select(
        common.row_key(docs).alias("row_key"),
        "doc_id",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
    )
    per_row = hit_spans(found).drop("spans").join(hit_items(found, grams), "row_key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return counted.join(per_row, "row_key", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs, benchmark, window=WINDOW):
    """The rows of docs without any hit; columns as in docs."""
    found, _ = hits(docs, benchmark, window)
    return common.keep_rows(docs, materialize(found.select("row_key").distinct(), "item-rows"), "left_anti")


def without_spans(docs, benchmark, window=WINDOW):
    """All rows of docs; texts with hits lose the hit words, what stands between the
    words of a stretch, and keep the rest as it was."""
    found, _ = hits(docs, benchmark, window)
    spans = materialize(hit_spans(found).select("row_key", "spans"), "item-spans")
    key, cut = common.fresh(docs, "row_key", "spans")
    keyed = docs.withColumn(key, common.row_key(docs)).join(
        common.by_size(spans.toDF(key, cut), spans.count()), key, "left"
    )
    all_words, gaps = F.regexp_extract_all("text", F.lit(f"({WORD})"), 1), F.split("text", WORD)
    number = F.sequence(F.lit(0), F.size(all_words))
    hit = lambda i: F.exists(cut, lambda s: (s["at"] <= i) & (i < s["end"]))
    piece = F.transform(
        number,
        lambda i: F.concat(
            F.when(~hit(i) | (i == 0), F.coalesce(F.get(all_words, i - 1), F.lit(""))).otherwise(""),
            F.when(hit(i) & hit(i + 1), F.lit("")).otherwise(F.get(gaps, i)),
        ),
    )
    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(F.array_join(piece, ""))
    return keyed.withColumn("text", text).select(*[f"`{c}`" for c in docs.columns])
