"""Periodic run detection by recursive frequency splitting.

A run is a stretch of words with smallest period q (words q apart are the same), of
at least max(24, 3 q) words, that no neighbouring word extends. Every word of a run
occurs in it three times or more. So a word that occurs less often in a segment can
be in no run of it and splits it; the parts are counted anew and split again until
nothing changes (``segments``). The parts that survive are scanned by lags
(``runs``). No row meets another, so texts stay in the task that reads them.

Neither step is quadratic in the length of a text. A split counts the shorter part
and takes it off the longer one's counts. Only lags at which something can recur are
scanned: for stretches of k = 1, 2, 4, ... words, those whose next equal stretch
starts q words later with k / 2 < q <= k. A run of period q starts with such a
stretch, as it holds three periods; each such stretch lies in a repetition whose
smallest period is q, so that every repetition is followed to its ends once.

Defined cases: a NULL or blank text has no words, no runs and an empty collapsed
text; the words of a text are kept apart by one space in the collapsed text, whether
or not it has runs; runs that overlap are all returned, and a word is dropped if any
of them asks for it; texts of any length are taken whole; equal rows get equal
results; an empty table gives no rows; extra columns are kept, and the new columns
are named _runs, _collapsed, ... where docs has such columns already.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.llm.common import SLICE_ROWS

#: A run has at least this many words and this many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
FOUND = "struct<runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"


def segments(ids, least=LEAST_PERIODS, shortest=LEAST_WORDS):
    """(start, end) of the stretches in which every word occurs ``least`` times,
    after splitting at rarer words until there are none."""
    found, open_parts = [], [(0, len(ids), Counter(ids))]
    while open_parts:
        low, high, counts = open_parts.pop()
        if high - low < shortest:
            continue
        at, end = low, high - 1
        while at <= end and counts[ids[at]] >= least and counts[ids[end]] >= least:
            at, end = at + 1, end - 1
        if at > end:
            found.append((low, high))
            continue
        cut = at if counts[ids[at]] < least else end
        left, right = (low, cut), (cut + 1, high)
        short, long = (left, right) if cut - low < high - cut else (right, left)
        taken = Counter(ids[short[0] : short[1]])
        if long[1] - long[0] >= shortest:
            for word, n in taken.items():
                counts[word] -= n
            counts[ids[cut]] -= 1
            open_parts.append((*long, counts))
        open_parts.append((*short, taken))
    return sorted(found)


def _lags(ids):
    """Arrays (position, lag): where the stretch of k words starting at the position
    occurs next, for the k of each lag."""
    n, most, k = len(ids), len(ids) // LEAST_PERIODS, 1
    rank = np.asarray(ids, dtype=np.int64)
    positions, lags = [], []
    while k // 2 < most:
        order = np.argsort(rank, kind="stable")
        same = np.diff(rank[order]) == 0
        if not same.any():
            break
        at = order[:-1][same]
        lag = order[1:][same] - at
        near = (lag > k // 2) & (lag <= min(k, most))
        positions.append(at[near])
        lags.append(lag[near])
        if len(rank) <= k:
            break
        named = np.empty_like(rank)
        named[order] = np.concatenate([[0], np.cumsum(~same)])
        rank = named[:-k] * n + named[k:]
        k *= 2
    if not lags:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(positions), np.concatenate(lags)


def _agreeing(one, two):
    """Number of leading elements in which two arrays agree, read in growing steps."""
    done, step = 0, 32
    while done < len(one):
        differs = one[done : done + step] != two[done : done + step]
        first = int(differs.argmax())
        if differs[first]:
            return done + first
        done, step = done + len(differs), step * 2
    return len(one)


def runs(ids):
    """(start, length, period) of all runs of a list of word numbers, by start and
    period."""
    found = []
    for low, high in segments(ids):
        part = np.asarray(ids[low:high], dtype=np.int64)
        positions, lags = _lags(part)
        order = np.lexsort((positions, lags))
        positions, lags = positions[order], lags[order]
        next_one = 0
        while next_one < len(lags):
            at, lag = int(positions[next_one]), int(lags[next_one])
            end = at + lag + _agreeing(part[at : len(part) - lag], part[at + lag :])
            start = at - _agreeing(part[:at][::-1], part[lag : at + lag][::-1])
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * lag):
                found.append((low + start, end - start, lag))
            # The other stretches of this repetition: the same lag, inside its ends.
            same_lag = np.searchsorted(lags, lag, side="right")
            next_one += int(np.searchsorted(positions[next_one:same_lag], end - lag))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words, found):
    """The words that no run holds after its first period."""
    if not found:
        return words
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in found:
        kept[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(kept)]


def _look(text):
    """Runs and collapsed text of one text, given as UTF-8."""
    # Bytes are split at \x20 and \x09-\x0D, nothing else.
    words = text.split() if text else []
    numbers = {}
    found = runs([numbers.setdefault(word, len(numbers)) for word in words])
    return found, b" ".join(collapsed(words, found))


def _detected(texts: pa.Array) -> pa.Array:
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    parts = []
    for at in range(0, len(texts), SLICE_ROWS):
        looked = [_look(value.as_py()) for value in texts.slice(at, SLICE_ROWS)]
        found = [
            [{"start": s, "length": n, "period": p} for s, n, p in of_text] for of_text, _ in looked
        ]
        shown = pa.array([text for _, text in looked], pa.binary()).cast(pa.string())
        parts.append(
            pa.StructArray.from_arrays([pa.array(found, pa.list_(run)), shown], ["runs", "collapsed"])
        )
    return pa.concat_arrays(parts)


def detect(docs, text="text"):
    """Docs with ``runs`` (array of start, length and period in words) and
    ``collapsed`` (the text without the repeats)."""
    common.bound_batches(docs.sparkSession)
    docs = common.with_columns(docs, {text: "string"})
    looked = F.arrow_udf(_detected, FOUND)
    new = [c if c not in docs.columns else common.fresh(docs, c) for c in ("runs", "collapsed")]
    found = common.fresh(docs, "found")
    return docs.withColumn(found, looked(F.col(text).cast("binary"))).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col(found)["runs"].alias(new[0]), F.col(found)["collapsed"].alias(new[1]),
    )


def strongest(found):
    """The run with the greatest length / period of an array of runs; ties: smallest
    start, then period. Fractions are compared by cross multiplication."""

    def better(one, two):
        left, right = one["length"] * two["period"], two["length"] * one["period"]
        earlier = (one["start"] < two["start"]) | (
            (one["start"] == two["start"]) & (one["period"] < two["period"])
        )
        return (left > right) | ((left == right) & earlier)

    return F.aggregate(
        found, F.get(found, F.lit(0)), lambda best, run: F.when(better(run, best), run).otherwise(best)
    )


def listed(found):
    """Text of an array of runs: one line ``start,length,period`` each."""
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    return F.array_join(F.transform(found, lambda run: F.concat(line(run), F.lit("\n"))), "")
