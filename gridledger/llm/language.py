"""Language identification by compression.

One zstandard raw-content dictionary per language holds the words of a bounded sample
of labelled documents, the most frequent last, where they cost least to refer to. A
text is encoded whole, as its distinct lower-cased words in order, so that repeated
lines and passages do not outvote the rest; it is compressed block by block with
each dictionary, and the smallest result names the language. The relative margin to
the second smallest (no dictionary at all, when one language is known) gives the
score, and narrow margins are rejected.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0; so is
every text when nothing was learned; ties go to the first language by code point;
texts without a label or id are not learned from; equal rows get equal results; extra
columns are kept by ``accepted`` and never looked at.
"""

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.llm.common import slices

#: Bounds of the training sample: documents and characters per language.
SAMPLE_DOCS = 400
OVERSAMPLING = 8
SAMPLE_CHARS = 2_000
DICTIONARY_BYTES = 112_640
#: Bytes of a text compressed at a time; all blocks count.
BLOCK = 16_384
#: Follows every text, so that also a few words make a block worth compressing.
PADDING = " " * 64
#: Relative margin that scores 0.5, and the score under which a text is rejected.
NARROW = 0.02
REJECT = 0.1
FOLDS = 5
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")


def fold(doc_id="doc_id"):
    """Fold 0 is held out from training."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def train(docs, sample_docs=SAMPLE_DOCS, sample_chars=SAMPLE_CHARS, size=DICTIONARY_BYTES):
    """Language -> dictionary bytes, from the labelled documents outside fold 0.

    Per language the ``sample_docs`` different documents first by a hash of their id;
    the driver holds at most that many texts of ``sample_chars`` characters for each.
    """
    docs = common.with_columns(docs, {"doc_id": "bigint", "text": "string", "lang": "string"})
    labelled = docs.filter("text is not null and lang is not null and doc_id is not null")
    labelled = labelled.filter(fold() != 0)
    labelled = labelled.select(
        common.row_key(docs).alias("row_key"), "lang", "text", F.xxhash64("doc_id").alias("draw")
    )
    # Equal rows share a key and are one row, or one text could take all places.
    # A few times as many rows as are wanted reach the window, however many there are.
    # The counts are one row per language, and the driver holds a dictionary for each.
    different = labelled.select("row_key", "lang", "draw").dropDuplicates(["row_key"])
    counts = different.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    likely = F.lit(float(OVERSAMPLING * sample_docs)) / F.col("rows")
    drawn = different.join(F.broadcast(counts), "lang")
    drawn = drawn.filter(common.unit(F.col("draw")) < likely)
    order = Window.partitionBy("lang").orderBy("draw", "row_key")
    numbered = drawn.withColumn("n", F.row_number().over(order))
    chosen = numbered.filter(F.col("n") <= sample_docs).select("row_key")
    texts = (
        labelled.join(F.broadcast(chosen), "row_key")
        .select("row_key", "lang", F.substring("text", 1, sample_chars).alias("text"))
        .dropDuplicates(["row_key"])
        .collect()
    )
    by_language = {}
    for row in texts:
        by_language.setdefault(row["lang"], Counter()).update(list(_words(row["text"])))
    out = {}
    for lang in sorted(by_language, key=str.encode):
        ranked = sorted(by_language[lang].items(), key=lambda x: (x[1], x[0]))
        out[lang] = " ".join(word for word, _ in ranked).encode()[-size:]
    return out


def _words(text):
    """Distinct lower-cased runs of letters in order."""
    found = dict.fromkeys(_WORD.findall(text.lower()))
    if all(map(str.isalpha, found)):
        return found
    # Number signs, as in x² or ½, are no letters but are matched with them.
    parts = ("".join(c if c.isalpha() else " " for c in word).split() for word in found)
    return dict.fromkeys(part for word in parts for part in word)


def classifier(dictionaries, block=BLOCK):
    """text -> (language, score); built once per task."""
    import zstandard

    settings = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=18, hash_log=16, chain_log=16,
        search_log=3, target_length=16, write_content_size=False, write_dict_id=False,
    )
    # A dictionary under eight bytes is not accepted; such a language has nothing to say.
    usable = {lang: raw for lang, raw in dictionaries.items() if len(raw) >= 8}
    coders = []
    for raw in usable.values():
        words = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=settings)
        coders.append(zstandard.ZstdCompressor(dict_data=words, compression_params=settings))
    names = list(usable)
    if len(coders) == 1:
        coders.append(zstandard.ZstdCompressor(compression_params=settings))

    def classify(text):
        words = _words(text) if text and names else None
        if not words:
            return UNDETERMINED, 0.0
        data = f" {' '.join(words)} {PADDING}".encode()
        sizes = [
            sum(len(coder.compress(data[at : at + block])) for at in range(0, len(data), block))
            for coder in coders
        ]
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        if order[0] >= len(names):  # no dictionary helps
            return names[0], 0.0
        best, second = sizes[order[0]], sizes[order[1]]
        margin = (second - best) / second
        return names[order[0]], margin / (margin + NARROW)

    return classify


def predict(docs, dictionaries):
    """doc_id, held_out, lang_pred, score of every row."""
    common.bound_batches(docs.sparkSession)
    docs = common.with_columns(docs, {"doc_id": "bigint", "text": "string"})

    def label(batches):
        classify = classifier(dictionaries)
        for batch in slices(batches):
            found = [classify(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    held_out = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out, "text").mapInArrow(
        label, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )


def accepted(docs, dictionaries, reject=REJECT):
    """The rows whose language is told clearly; columns as in docs. Without a text
    column there is none."""
    common.bound_batches(docs.sparkSession)
    if "text" not in docs.columns:
        return docs.filter(F.lit(False))

    def keep(batches):
        classify = classifier(dictionaries)
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            clear = [classify(t)[1] >= reject for t in texts]
            yield batch.filter(pa.array(clear, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
