"""I-Match document fingerprints, native.

The lexicon holds the terms whose document frequency lies within a band of the
corpus (rare terms tell documents apart but do not survive edits; common ones say
nothing). Its size is bounded by terms per document over the band's lower share,
whatever the corpus, so it is broadcast. Each of several randomised subsets of the
lexicon gives one hash of the distinct terms that it selects from a document, in
whatever order they stand. Subsets come in two densities, so that short and long
documents both have subsets that select a few of their terms.

The likeness of two fingerprints is the share of equal hashes among the subsets that
select anything, over the sparser density if enough of its subsets do.

Defined cases: a NULL text is empty; texts with fewer than MIN_TERMS lexicon terms
are fingerprinted by their whole lower-cased text, alike only if equal; equal texts
have equal fingerprints; documents follow one another by descending doc_id (NULL
last), equal ids by row hash, and equal rows one after the other; a lone document is
followed by itself; an empty table gives no rows; extra columns do not matter.
"""

from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.llm.decontamination import words
from gridledger.sources.tables import materialize

#: Share of documents a lexicon term occurs in.
BAND = (0.002, 0.2)
#: (subsets, one term in so many is in a subset).
DENSITIES = ((20, 16), (28, 128))
#: Subsets of the sparser density that must select something to decide alone.
ENOUGH = 10
MIN_TERMS = 4
SALT = 19


def _subsets():
    return [(k, share) for k, share in enumerate(s for n, s in DENSITIES for _ in range(n))]


def term_counts(texts):
    """term (64-bit hash) -> number of documents, over all documents."""
    terms = texts.select(F.explode(F.array_distinct(words("text"))).alias("word"))
    return terms.groupBy(F.xxhash64("word").alias("term")).agg(F.count(F.lit(1)).alias("documents"))


def lexicon(texts, documents, band=BAND):
    """term -> mask: which randomised subsets a lexicon term is in. The row of the
    empty word stands for every document."""
    low, high = band
    bits = [
        F.when(F.pmod(F.xxhash64(F.lit(SALT), F.col("term"), F.lit(k)), F.lit(share)) == 0, 1 << k)
        .otherwise(0)
        .cast("long")
        for k, share in _subsets()
    ]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    kept = term_counts(texts).filter(
        (F.col("documents") >= low * documents) & (F.col("documents") <= high * documents)
    )
    everywhere = texts.sparkSession.range(1).select(
        F.xxhash64(F.lit("")).alias("term"), F.lit(0).cast("long").alias("mask")
    )
    return kept.select("term", mask.alias("mask")).unionByName(everywhere)


def fingerprints(texts, terms, keys, digest=False):
    """Fingerprint of each text; ``terms`` is the written lexicon. With ``digest``
    also the text's SHA-256, so that a text is put together only once.

    A subset's terms are combined by exclusive or of their 64-bit hashes before they
    are hashed again: like sorting, that makes the order of terms irrelevant, and it
    keeps one number per subset in a text's row, not its list of terms.
    """
    rows = texts.select(
        *keys, "text", F.explode(F.concat(F.array(F.lit("")), F.array_distinct(words("text")))).alias("_word")
    )
    known = common.by_size(terms.withColumnRenamed("term", "_term"), terms.count())
    own = F.col("_word") == ""
    whole = {"_whole": F.xxhash64(F.lit(1), "text")}
    if digest:
        whole |= {f"_sha{k}": part for k, part in enumerate(_digest_parts(F.sha2("text", 256)))}
    rows = rows.select(
        *keys, F.xxhash64("_word").alias("_term"), (~own).alias("_is_term"),
        # Once per text, on the row that stands for it.
        *[F.when(own, value).alias(name) for name, value in whole.items()],
    )
    in_subset = F.col("_is_term") & (F.col("mask") != 0)
    grouped = rows.join(known, "_term").groupBy(*keys).agg(
        F.count_if("_is_term").alias("_terms"),
        *[F.max(name).alias(name) for name in whole],
        *[
            F.bit_xor(F.when(in_subset & (F.col("mask").bitwiseAND(F.lit(1 << k)) != 0), F.col("_term")))
            .alias(f"_s{k}")
            for k, _ in _subsets()
        ],
    )

    def subset_hash(k):
        digits = F.lpad(F.hex(F.xxhash64(F.lit(k), f"_s{k}")), 16, "0")
        return F.when(F.col(f"_s{k}").isNotNull(), F.substring(digits, 1, 8))

    subset = F.array_join(F.array(*[subset_hash(k) for k, _ in _subsets()]), " ", "-")
    alone = F.concat(F.lit("="), F.lpad(F.hex("_whole"), 16, "0"))
    shown = [F.when(F.col("_terms") >= MIN_TERMS, subset).otherwise(alone).alias("fingerprint")]
    if digest:
        shown.append(_digest_text([F.col(f"_sha{k}") for k in range(4)]).alias("sha"))
    return grouped.select(*keys, *shown)


def _digest_parts(digest):
    """A hexadecimal SHA-256 as four signed numbers, which aggregate without sorting."""
    return [F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("long") for k in range(4)]


def _digest_text(parts):
    return F.lower(F.concat(*[F.lpad(F.hex(part), 16, "0") for part in parts]))


def likeness(a, b):
    """0 to 1 for two fingerprint columns."""
    one, two = F.split(a, " "), F.split(b, " ")
    sparse_from = DENSITIES[0][0]

    def share(first, count):
        pairs = F.arrays_zip(
            F.slice(one, first + 1, count).alias("x"), F.slice(two, first + 1, count).alias("y")
        )
        used = F.size(F.filter(pairs, lambda p: (p["x"] != "-") | (p["y"] != "-")))
        same = F.size(F.filter(pairs, lambda p: (p["x"] == p["y"]) & (p["x"] != "-")))
        return used, same

    sparse_used, sparse_same = share(sparse_from, DENSITIES[1][0])
    dense_used, dense_same = share(0, sparse_from)
    used, same = sparse_used + dense_used, sparse_same + dense_same
    subsets = F.when(sparse_used >= ENOUGH, sparse_same / sparse_used).otherwise(
        F.coalesce(F.try_divide(same, used), F.lit(0.0))
    )
    comparable = ~a.startswith("=") & ~b.startswith("=")
    return F.when(a == b, F.lit(1.0)).when(comparable, subsets).otherwise(F.lit(0.0))


def followed(rows):
    """row_key, place, next_key and next_place: the next document of each in
    descending doc_id order, after the last the first."""
    # NULL ids come last; the order key is negated, as total_order ascends.
    key = F.coalesce(-F.col("doc_id").cast("decimal(20,0)").cast("double"), F.lit(float("inf")))
    exact = F.coalesce(-F.col("doc_id").cast("decimal(20,0)"), F.lit("1" + 19 * "0").cast("decimal(20,0)"))
    keyed = rows.select("row_key", "doc_id", key.alias("about"), exact.alias("exact"))
    # Doubles only deal the rows into ranges; inside one the exact id decides.
    # Documents that share an id (or have none) are subdivided by their hash; ids that
    # share a double, by what the double leaves of them, so that the exact order stays.
    left = F.col("exact") - F.col("about").try_cast("decimal(20,0)")
    tie = F.when(F.abs("about") <= 2.0**53, F.col("row_key")["a"]).otherwise(
        F.coalesce(left.cast("long"), F.col("row_key")["a"])
    )
    placed = common.total_order(keyed.withColumn("tie", tie), "about", "tie", ("exact", "row_key"))
    placed = materialize(
        placed.select("row_key", "doc_id", F.col("_place").alias("place")), "imatch-places"
    )
    count = F.lit(max(1, placed.count()))
    following = placed.select(
        F.pmod(F.col("place") - 1, count).alias("place"), F.col("row_key").alias("next_key"),
        F.col("place").alias("next_place"),
    )
    return placed.join(following, "place")


def compare_edited(docs, band=BAND):
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next."""
    docs = common.with_columns(docs, {"doc_id": "bigint", "text": "string"})
    texts = docs.select(
        common.row_key(docs).alias("row_key"), "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = materialize(
        texts.select("row_key", "doc_id", F.length("text").cast("long").alias("n_chars")), "imatch-rows"
    )
    terms = materialize(lexicon(texts, rows.count(), band), "imatch-lexicon")
    distinct = rows.select("row_key").distinct().count()
    count = rows.count()
    if distinct < count:  # equal rows: their text is taken once
        texts = texts.dropDuplicates(["row_key"])
        sizes = rows.dropDuplicates(["row_key"]).select("row_key", "n_chars")
    else:
        sizes = rows.select("row_key", "n_chars")
    order = followed(rows).join(sizes, "row_key")
    order = materialize(order.withColumn("cut", F.floor(F.col("n_chars") / 3)), "imatch-order")
    own = materialize(fingerprints(texts, terms, ["row_key"]), "imatch-own")

    # The start of each text goes to the document before it, and of that one only
    # what is kept goes to where the two are joined.
    wanted = order.select(
        F.col("next_key").alias("row_key"), F.col("row_key").alias("target"), "place", "cut"
    )
    starts = texts.join(common.by_size(wanted, count), "row_key").select(
        F.col("target").alias("row_key"), "place", F.expr("left(text, int(cut))").alias("start")
    )
    kept = F.expr("left(text, length(text) - int(length(text) div 3))")
    edited = texts.select("row_key", kept.alias("kept")).join(starts, "row_key").select(
        "place", F.concat("kept", "start").alias("text")
    )
    marked = fingerprints(edited, terms, ["place"], digest=True)
    marked = marked.withColumnRenamed("fingerprint", "other")
    out = (
        order.join(own, "row_key")
        .join(own.toDF("next_key", "next_fingerprint"), "next_key")
        .join(marked, "place")
    )
    return out.select(
        "doc_id", "n_chars", F.col("sha").alias("edited_sha256"), "fingerprint",
        F.col("other").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("other")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
