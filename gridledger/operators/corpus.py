"""Character vocabulary and encoding of text lines in sequences of fixed length.

Characters are looked up by numpy, an Arrow batch at a time; cutting, grouping and
joining of lines is Spark's.
"""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

# The lookups travel with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAD = 0
MAX_LEN = 64


def characters(column):
    return F.split(column, "")


def text_lines(df, key, text="text"):
    """One row per line of a text, numbered within it."""
    return df.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "value"))


def char_vocab(lines, text="value"):
    """Sorted distinct characters numbered from 1; 0 is padding.

    Each line is reduced to its distinct characters before the shuffle. The
    numbering window sees the vocabulary only.
    """
    letters = lines.select(F.explode(F.array_distinct(characters(F.col(text)))).alias("ch"))
    letters = letters.filter(F.col("ch") != "").distinct()
    return letters.select("ch", F.row_number().over(Window.orderBy("ch")).alias("idx"))


def _vocabulary(vocab):
    """(code points, ids) in the order of the ids; bounded by the characters that exist."""
    rows = vocab.select("idx", F.ascii("ch").alias("code")).orderBy("idx", "code").collect()
    return np.array([r["code"] for r in rows], np.int64), np.array([r["idx"] for r in rows], np.int32)


def _code_points(text):
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _padded_ids(pieces, table, max_len):
    """Ids of the characters of each piece, none longer than ``max_len``, padded to it.
    ``table`` has the id of every code point up to its end; others are padding."""
    codes = _code_points("".join(pieces.to_pylist()))
    lengths = pc.utf8_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], PAD)
    # The place of a character: its piece's, and how far it is from that piece's first.
    firsts = np.cumsum(lengths) - lengths
    places = np.repeat(np.arange(len(lengths)) * max_len - firsts, lengths) + np.arange(len(ids))
    out = np.full(len(lengths) * max_len, PAD, np.int32)
    out[places] = ids
    ends = np.arange(len(lengths) + 1, dtype=np.int32) * np.int32(max_len)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(out))


def _texts_of(arrays, codes):
    """The characters of arrays of ids, the n-th of ``codes`` for id n; other and missing
    ids are nothing, a missing array has no text."""
    lengths = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False)
    ids = pc.fill_null(arrays.flatten(), PAD).to_numpy(zero_copy_only=False)
    known = (ids > 0) & (ids <= len(codes))
    letters = codes[ids[known] - 1].astype("<u4")
    widths = np.zeros(len(ids) + 1, np.int64)
    widths[1:][known] = 1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF)
    ends = np.cumsum(widths)[np.concatenate([[0], np.cumsum(lengths)])]
    text = letters.tobytes().decode("utf-32-le").encode()
    texts = pa.LargeStringArray.from_buffers(
        len(arrays), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text)
    ).cast(pa.string())
    return pc.if_else(arrays.is_valid(), texts, None) if arrays.null_count else texts


def encode(lines, vocab, max_len=MAX_LEN, text="value", out="encoded", truncate=False):
    """Ids of every line in consecutive sequences of ``max_len``, numbered by
    ``seq_no`` from 0; the last is padded with 0. An empty line is one sequence
    of padding. ``truncate`` keeps the first sequence of a line only. The vocabulary is
    computed here; it should be stored if it is used more than once.
    """
    codes, numbers = _vocabulary(vocab)
    table = np.full(int(codes.max(initial=0)) + 1, PAD, np.int32)
    table[codes] = numbers

    @F.arrow_udf("array<int>")
    def padded(pieces: pa.Array) -> pa.Array:
        return _padded_ids(pieces, table, max_len)

    # One pass cuts a line, however long, into its pieces.
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{max_len}}}"), 0)
    pieces = F.when(F.size(pieces) > 0, pieces).otherwise(F.array(F.lit("")))
    if truncate:
        pieces = F.slice(pieces, 1, 1)
    cut = lines.select("*", F.posexplode(pieces).alias("seq_no", "_piece"))
    return cut.withColumn(out, padded("_piece")).drop("_piece")


def encode_shift(lines, vocab, max_len=MAX_LEN, text="value", truncate=False):
    """Per sequence the input ids (all but the last) and target ids (all but the first)."""
    encoded = encode(lines, vocab, max_len, text, "_encoded", truncate)
    return encoded.withColumns(
        {
            "input_ids": F.slice("_encoded", 1, max_len - 1),
            "target_ids": F.slice("_encoded", 2, max_len - 1),
        }
    ).drop("_encoded")


def decode(encoded, vocab, ids="encoded", out="decoded"):
    """Ids back to text, per sequence; unknown ids and padding become nothing."""
    codes, _ = _vocabulary(vocab)

    @F.arrow_udf("string")
    def text(arrays: pa.Array) -> pa.Array:
        return _texts_of(arrays, codes)

    return encoded.withColumn(out, text(ids))


def join_sequences(decoded, keys, text="decoded"):
    """The decoded sequences of each line put together again."""
    pieces = F.array_sort(F.collect_list(F.struct("seq_no", F.col(text).alias("piece"))))
    return decoded.groupBy(*keys).agg(
        F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias(text)
    )
