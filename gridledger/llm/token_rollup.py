"""Token counts as delta-maintained rollups.

Documents are counted once per tokenizer version. Every change is a signed row: an
insert adds a document and its tokens, a delete takes them away, a revised count
does both. A batch of changes is summed per source, language and tokenizer version
and written by as many tasks as its groups need; a row of a small table, ``commits``,
then makes it visible as a whole. Totals are the sum over batches. A batch that is
committed again, after a failure or by a second driver, is counted once: each commit
is an attempt of its own, and the first to be *finished* stands, so a slow attempt that
ends later changes nothing. ``fold`` puts all batches so far into one base, so that
totals do not get dearer with age; a batch that is in the base may still be committed
again, and two folds at once do no harm.

Defined cases: a NULL or empty text has 0 tokens and still counts as a document;
NULL source or language is a group of its own; equal rows count each; a group that
sinks to no documents and no tokens has no row; an empty batch commits nothing;
extra columns do not matter.
"""

import base64
import time
import uuid

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.llm.common import slices
from gridledger.sources.tables import materialize

#: Where the vocabulary files are; a parameter, as they are not part of this repository.
VOCABULARIES = "/opt/tokenizers"
#: Tokenizer version: name and release of the vocabulary.
BYTE_BPE = "byte_bpe_50k"
WORDS = "words_1"
KEYS = ("source", "lang", "tokenizer")
# The pattern that the vocabulary's publisher splits texts with.
BYTE_BPE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Longest stretch handed to the tokenizer at once; a text is cut before a space.
PIECE_CHARS = 100_000


def byte_bpe(folder=VOCABULARIES):
    """text -> number of byte-level BPE tokens."""
    import tiktoken

    with open(f"{folder}/{BYTE_BPE}.tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coding = tiktoken.Encoding(
        BYTE_BPE, pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def count(text):
        total, at = 0, 0
        while at < len(text):
            end = min(len(text), at + PIECE_CHARS)
            while end < len(text) and not (text[end] == " " and text[end - 1].isalnum()):
                end += 1  # a space after a letter or digit always starts a new word
            total += len(coding.encode_ordinary(text[at:end]))
            at = end
        return total

    return count


def counts(docs, folder=VOCABULARIES):
    """doc_id, source, lang, estimate (a quarter of the characters) and the tokens of
    each document by words_1 (runs between white space) and byte_bpe_50k."""
    docs = common.with_columns(
        docs, {"doc_id": "bigint", "text": "string", "source": "string", "lang": "string"}
    )
    text = F.coalesce("text", F.lit(""))
    prepared = docs.select(
        "doc_id", "source", "lang",
        F.ceil(F.length(text) / 4).cast("long").alias("estimate"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias(WORDS),
        text.alias("text"),
    )

    def tokens(batches):
        count = byte_bpe(folder)
        for batch in slices(batches):
            found = pa.array([count(t) for t in batch.column("text").to_pylist()], pa.int64())
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), found], [*kept, BYTE_BPE]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return prepared.mapInArrow(
        tokens,
        f"doc_id {kind}, source string, lang string, estimate bigint, {WORDS} bigint, {BYTE_BPE} bigint",
    )


def signed(rows, tokens, tokenizer, sign):
    """Change rows of one tokenizer version: sign 1 inserts, -1 deletes; a column of
    other numbers inserts or deletes as many."""
    sign = sign if isinstance(sign, Column) else F.lit(sign)
    return rows.select(
        "source", "lang", F.lit(tokenizer).alias("tokenizer"),
        sign.cast("long").alias("documents"),
        (sign * tokens).cast("long").alias("tokens"),
    )


def changes(before, after, tokenizer):
    """Signed rows that lead from one snapshot (doc_id, source, lang, tokens) to
    another: inserts, deletes and revised counts; unchanged documents give none.

    Equal lines of both snapshots cancel by their number, so that repeated and NULL
    ids count each."""
    line = ("doc_id", "source", "lang", "tokens")
    both = before.select(*line, F.lit(-1).cast("long").alias("sign")).unionByName(
        after.select(*line, F.lit(1).cast("long").alias("sign"))
    )
    moved = both.groupBy(*line).agg(F.sum("sign").alias("sign")).filter("sign <> 0")
    return signed(moved, F.col("tokens"), tokenizer, F.col("sign"))


_SUMS = "source string, lang string, tokenizer string, documents bigint, tokens bigint"
_COMMITS = "batch string, attempt string, at bigint, folded boolean"


def _summed(rows):
    return rows.groupBy(*KEYS).agg(
        F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")
    )


def _write(root, rows):
    attempt = uuid.uuid4().hex
    rows.write.parquet(f"{root}/sums/{attempt}")
    return attempt


def _announce(root, batches, attempt, folded):
    """One file of rows: the batches that an attempt holds, all visible at once."""
    batches.select(
        "batch", F.lit(attempt).alias("attempt"), F.lit(time.time_ns()).alias("at"),
        F.lit(folded).alias("folded"),
    ).coalesce(1).write.mode("append").parquet(f"{root}/commits")


def commit(root, batch_id, rows):
    """Append a batch of signed rows; committing it again changes nothing."""
    batch = rows.sparkSession.range(1).select(F.lit(batch_id).alias("batch"))
    _announce(root, batch, _write(root, _summed(rows)), False)


def _standing(commits):
    """One row per batch: the attempt that counts for it.

    Every fold holds all batches before it, so of two folds one holds all that is in the
    other: the larger counts, and for batches outside it the first finished attempt.
    """
    fold = commits.filter("folded").groupBy("attempt").agg(F.count(F.lit(1)).alias("n"))
    base = fold.agg(F.max(F.struct("n", "attempt"))["attempt"]).first()[0]
    counted = commits.filter(~F.col("folded") | (F.col("attempt") == F.lit(base)))
    first = F.min(F.struct(~F.col("folded"), "at", "attempt"))
    return counted.groupBy("batch").agg(first["attempt"].alias("attempt"))


def _read(spark, root, standing):
    # One attempt per batch since the last fold, and the fold.
    attempts = sorted(r["attempt"] for r in standing.select("attempt").distinct().collect())
    return spark.read.schema(_SUMS).parquet(*[f"{root}/sums/{a}" for a in attempts])


def fold(spark, root):
    """Put all batches committed so far into one base; totals stay as they are."""
    standing = materialize(_standing(spark.read.schema(_COMMITS).parquet(f"{root}/commits")), "rollup-standing")
    sums = _summed(_read(spark, root, standing)).filter("documents <> 0 or tokens <> 0")
    _announce(root, standing, _write(root, sums), True)


def totals(spark, root):
    """source, lang, tokenizer, n_docs, n_tokens over all committed batches."""
    standing = _standing(spark.read.schema(_COMMITS).parquet(f"{root}/commits"))
    return (
        _read(spark, root, standing)
        .groupBy(*KEYS)
        .agg(F.sum("documents").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        .filter("n_docs <> 0 or n_tokens <> 0")
    )
