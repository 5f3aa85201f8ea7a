"""A fixed-size bitmap of keys (a Bloom filter), built and asked with column expressions.

The bitmap is a one-row frame with an array of 64-bit words. It has the same size
whatever the keys are, so it may go into any plan as a scalar subquery: rows without a
chance of a match are dropped in the scan that makes them, before a shuffle. Keys that
are in are always found; others are let through with a probability that is stated by
``false_share``. What passes still has to be joined with the keys.
"""

import math

from pyspark.sql import functions as F

#: Bits of a filter, a power of two: half a megabyte.
BITS = 1 << 22
_WORD = 64


def _places(key):
    """The two bit numbers of a 64-bit hash column, from its low and high half."""
    mask = F.lit(BITS - 1).cast("long")
    return [key.bitwiseAND(mask), F.shiftright(key, 32).bitwiseAND(mask)]


def bitmap(keys, key):
    """The filter of a column of 64-bit hashes, as a frame of one row. Bits are set
    where the keys are, words are combined before they are shuffled, and no more than
    BITS / 64 of them reach the last task."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % _WORD).cast("int"))
    places = keys.select(F.explode(F.array(*_places(F.col(key)))).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = keys.sparkSession.range(BITS // _WORD).withColumnRenamed("id", "word")
    bits = F.coalesce("bits", F.lit(0).cast("long")).alias("bits")
    filled = every.join(words, "word", "left").select("word", bits)
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return filled.agg(F.transform(ordered, lambda w: w["bits"]).alias("words"))


def may_contain(filter_row, key):
    """Whether a hash column may be among the filter's keys; never false for one that is."""
    words = filter_row.scalar()

    def probe(place):
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        return F.getbit(word, (place % _WORD).cast("int")) == 1

    low, high = _places(key)
    return probe(low) & probe(high)


def false_share(keys):
    """Expected share of other keys that a filter of so many distinct keys lets through."""
    return (1 - math.exp(-2 * keys / BITS)) ** 2
