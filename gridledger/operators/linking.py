"""Entity linking: which known player a text is about.

Priority: the text contains the full name, else one of its words is a last
name, else a first name; within a class the better ranked player wins.

Nothing compares every text with every player, and no text is moved. A full name is
found through its rarest part (six characters, fewer for shorter names), last and
first names through the text's words. One bitmap of all these parts and words is
tested where the texts are scanned, so that only the few places that may match leave
the scan: each with the key, the part and the text around it, wide enough for the
longest name. They meet the names by an equi-join on the part and are verified in
that surrounding. The knowledge base may have any size: a small one ends up on the
broadcast side of the join by itself, and an ``index`` of it can be written once and
used for many batches of texts.
"""

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridledger.functions.text import words
from gridledger.operators import membership
from gridledger.sources.tables import materialize

# Characters per block and per chunk of a long text.
BLOCK, CHUNK = 16_384, 64
# Lengths of a name's key part; a name takes the longest that it reaches.
PARTS = (6, 3, 2, 1)


@dataclass(frozen=True)
class NameIndex:
    """names (gsis_id, name); parts (part, known, lname) and which lengths these have;
    words (word, hit); the filter of both as hashes, one row; the longest name's length."""

    names: DataFrame
    parts: DataFrame
    sizes: tuple
    words: DataFrame
    filter: DataFrame
    longest: int


def _keyed(kb):
    """Known names with the order in which they win: points, then id."""
    parts = words(F.lower("name"))
    order = F.struct(
        F.col("fantasy_points").isNull().alias("unscored"),
        (-F.col("fantasy_points")).alias("order"),
        F.col("gsis_id"),
    )
    return kb.select(
        order.alias("known"), "name", F.lower("name").alias("lname"),
        F.element_at(parts, -1).alias("last"), F.element_at(parts, 1).alias("first"),
    ).filter(F.col("lname").isNotNull() & (F.col("lname") != ""))


def _cut(df, keep, size, before, after):
    """Rows (keep, piece, lead, own) cut into ``size`` own characters each, which start
    after ``lead`` characters of surrounding; up to ``before`` and ``after`` characters
    of it are kept."""
    no = F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col("own") - 1, F.lit(size)))
    at = F.col("no") * size
    start = F.greatest(F.lit(0).cast("bigint"), F.col("lead") + at - before)
    lead = F.col("lead") + at - start
    return (
        df.filter("own > 0")
        .select(*keep, "piece", "lead", "own", F.explode(no).alias("no"))
        .select(
            *keep, lead.alias("lead"), F.least(F.lit(size), F.col("own") - at).alias("own"),
            F.substring("piece", start + 1, (lead + size + after).cast("int")).alias("piece"),
        )
    )


def parts_of(df, key, wanted, margin=0, sizes=PARTS):
    """(key, part, around) for the places of the lowered texts of ``df`` (key, lowered)
    whose part of one of the sizes passes ``wanted``, a condition on a column; ``around``
    is the text up to ``margin`` characters to either side.

    Long texts are cut twice, as reaching a position costs time in proportion to what
    lies before it.
    """
    after = margin + max(PARTS)
    whole = df.select(
        key, F.col("lowered").alias("piece"), F.lit(0).cast("bigint").alias("lead"),
        F.length("lowered").cast("bigint").alias("own"),
    )
    chunks = _cut(_cut(whole, [key], BLOCK, margin, after), [key], CHUNK, margin, after)
    place = chunks.select(
        key, "piece", F.explode(F.sequence(F.col("lead") + 1, F.col("lead") + F.col("own"))).alias("at")
    )
    found = [F.substring("piece", F.col("at"), F.lit(size)) for size in sizes]
    whole_part = [F.length(part) == size for part, size in zip(found, sizes, strict=True)]
    passed = [full & wanted(part) for full, part in zip(whole_part, found, strict=True)]
    start = F.greatest(F.lit(1).cast("bigint"), F.col("at") - margin)
    around = F.substring("piece", start, (F.col("at") - start + after).cast("int"))
    parts = F.array(*[F.when(p, part) for p, part in zip(passed, found, strict=True)])
    return place.filter(reduce(or_, passed)).select(
        key, around.alias("around"), F.explode(F.array_compact(parts)).alias("part")
    )


def _rarest_parts(known):
    """One part per full name, the part fewest names share, with the best name's order.

    A window counts the sharing names, not a join: the planner multiplies the
    estimated sizes of a join's sides and would then broadcast the texts instead.
    """
    names = known.groupBy(F.col("lname").alias("lowered")).agg(F.min("known").alias("known"))
    parts = parts_of(names.withColumn("id", F.struct("known", "lowered")), "id", lambda part: F.lit(True))
    size = F.lit(PARTS[-1])
    for reached in reversed(PARTS[:-1]):
        size = F.when(F.length("id.lowered") >= reached, reached).otherwise(size)
    return (
        parts.filter(F.length("part") == size).select("id", "part").distinct()
        .withColumn("names", F.count("*").over(Window.partitionBy("part")))
        .groupBy("id")
        .agg(F.min(F.struct("names", "part")).alias("rare"))
        .select("rare.part", "id.known", F.col("id.lowered").alias("lname"))
    )


def _part_hash(part):
    return F.xxhash64(part)


def _word_hash(word):
    return F.xxhash64(F.lit("word"), word)


def index(kb):
    """What link_texts needs of a knowledge base (gsis_id, name, fantasy_points), written
    to the shared folder: it may serve many batches of texts."""
    known = _keyed(kb)

    def by_word(part, link_class):
        best = known.groupBy(F.col(part).alias("word")).agg(F.min("known").alias("known"))
        return best.select(
            "word", F.struct(F.lit(link_class).alias("link_class"), "known").alias("hit")
        )

    named = by_word("last", 2).unionByName(by_word("first", 3))
    named = materialize(named.groupBy("word").agg(F.min("hit").alias("hit")), "index-words")
    parts = materialize(_rarest_parts(known), "index-parts")
    hashes = parts.select(_part_hash("part").alias("hash")).unionByName(
        named.select(_word_hash("word").alias("hash"))
    )
    # One row per length of part.
    sizes = parts.groupBy(F.length("part").alias("size")).agg(F.max(F.length("lname"))).collect()
    return NameIndex(
        kb.select("gsis_id", "name"), parts,
        tuple(sorted((size for size, _ in sizes), reverse=True)) or PARTS[-1:], named,
        materialize(membership.bitmap(hashes, "hash"), "index-filter"),
        max((longest for _, longest in sizes), default=0),
    )


def link_texts(texts, kb, key="q_id", text="text"):
    """(key, gsis_id, name, link_class) of the texts that name a player.

    ``kb`` has gsis_id, name and fantasy_points, or is an ``index``; keys are unique.
    """
    names = kb if isinstance(kb, NameIndex) else index(kb)
    lowered = texts.select(key, F.lower(text).alias("lowered"))

    def may_be(hashed):
        return membership.may_contain(names.filter, hashed)

    word = lowered.select(
        key, F.explode(F.array_distinct(words(F.col("lowered")))).alias("word")
    ).filter(may_be(_word_hash("word")))
    candidates = parts_of(
        lowered, key, lambda part: may_be(_part_hash(part)), names.longest, names.sizes
    )
    full = (
        candidates.join(names.parts, "part")
        .filter(F.contains("around", "lname"))
        .select(key, F.struct(F.lit(1).alias("link_class"), "known").alias("hit"))
    )
    best = (
        full.unionByName(word.join(names.words, "word").select(key, "hit"))
        .groupBy(key)
        .agg(F.min("hit").alias("best"))
        .select(key, "best.link_class", F.col("best.known.gsis_id").alias("gsis_id"))
    )
    return best.join(names.names, "gsis_id").select(key, "gsis_id", "name", "link_class")


def link_entities(texts, kb, key="q_id", text="text"):
    """Every text with the linked player's gsis_id, name and link_class."""
    return texts.join(link_texts(texts, kb, key, text), key, "left").select(
        *texts.columns, "gsis_id", "name", "link_class"
    )
