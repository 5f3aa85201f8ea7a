"""Name lookups by substring, without comparing every lookup to every name.

A lookup ``q`` finds the players whose name contains it, ignoring case, with
``%`` and ``_`` as wildcards, and takes the one with most points.

* A plain lookup joins by equality: names give their substrings of the lengths
  that are asked for, each with its best player, so nothing is left to verify
  and the work grows with names and lookups, not with their product.
* A pattern takes its rarest part of up to three characters as join key, and
  the candidates found are verified. Names give only the parts asked for.
* One made of wildcards only asks for a minimum length, keyed as well.

Only the seasons asked for are looked at. All joins are equi-joins.
"""

from pyspark.sql import functions as F

GRAM = 3
ANY_SEASON = -1


def grams(column, size):
    """Distinct substrings of the given size."""
    count = F.length(column) - (size - 1)
    cut = F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda i: F.substring(column, i, F.lit(size)),
    )
    return F.array_distinct(F.when(count >= 1, cut).otherwise(F.array().cast("array<string>")))


def entries(column, sizes):
    """Index entries of one text: structs (size, gram)."""

    def sized(size):
        return F.transform(
            grams(column, size),
            lambda gram: F.struct(F.lit(size).alias("size"), gram.alias("gram")),
        )

    return F.flatten(F.array(*[sized(size) for size in sizes]))


def _length_entries(column):
    """Entries (0, k) for every length k the text reaches."""
    return F.transform(
        F.sequence(F.lit(0), F.length(column)),
        lambda k: F.struct(F.lit(0).alias("size"), k.cast("string").alias("gram")),
    )


def _ranked_names(players, stats, asked):
    """Best player per lower-case name within each asked season, and over none.

    Scope is a season for players with points in it, ANY_SEASON for all players:
    the fallback when none of the matching players has points. ``best`` sorts
    real points before the fallback, more points before fewer, then by id.
    """
    people = players.filter(F.col("name").isNotNull()).select(
        "gsis_id", F.lower("name").alias("lname")
    )
    scored = (
        stats.filter(F.col("fantasy_points").isNotNull())
        .select("gsis_id", F.col("season").cast("int").alias("scope"), "fantasy_points")
        .join(asked.select("scope").distinct(), "scope", "left_semi")
    )
    known = people.join(scored, "gsis_id").select(
        "scope", "lname", "gsis_id", F.lit(0).alias("unscored"),
        (-F.col("fantasy_points")).alias("order"),
    )
    fallback = people.select(
        F.lit(ANY_SEASON).alias("scope"), "lname", "gsis_id", F.lit(1).alias("unscored"),
        F.lit(0.0).alias("order"),
    )
    best = F.min(F.struct("unscored", "order", "gsis_id")).alias("best")
    return known.unionByName(fallback).groupBy("scope", "lname").agg(best)


def _lookups(lookups):
    """Distinct lower-case patterns with what kind of index entry they need."""
    # A backslash only escapes %, _ and itself; before anything else it is dropped.
    lowered = F.regexp_replace(F.lower("q"), r"(\\[%_\\])|\\(?!$)", "$1")
    asked = lookups.select("q", "season").filter(F.col("q").isNotNull()).distinct()
    plain = ~F.rlike("lq", F.lit(r"[%_\\]"))
    wild = F.rlike("lq", F.lit("^[%_]*$"))  # an empty lookup, too
    return asked.select(
        "q", F.explode(F.array(F.col("season").cast("int"), F.lit(ANY_SEASON))).alias("scope"),
        "season", lowered.alias("lq"),
    ).withColumns(
        {
            "kind": F.when(wild, "length").when(plain, "plain").otherwise("pattern"),
        }
    )


def _literal_entries(lq):
    """Index entries every match of a longer pattern must have."""
    runs = F.filter(F.split(lq, r"[%_\\]+"), lambda run: run != "")
    parts = F.flatten(
        F.transform(
            runs,
            lambda run: F.when(F.length(run) >= GRAM, entries(run, [GRAM])).otherwise(
                F.array(F.struct(F.length(run).alias("size"), run.alias("gram")))
            ),
        )
    )
    # Nothing but escapes: the escaped character itself, or % for a lone backslash.
    escaped = F.regexp_extract(lq, r"\\(.)", 1)
    only = F.when(escaped != "", escaped).otherwise("%")
    alone = F.array(F.struct(F.lit(1).alias("size"), only.alias("gram")))
    return F.when(F.size(runs) > 0, parts).otherwise(alone)


def _plain_matches(asked, names):
    """Best player per plain lookup: equality with substrings of the asked lengths."""
    lengths = asked.select("scope", F.length("lq").alias("size")).distinct()
    here = F.sequence(F.lit(1), F.length("lname") - F.col("size") + 1)
    substrings = (
        names.join(lengths, "scope")
        .filter(F.length("lname") >= F.col("size"))
        .select("scope", "lname", "size", "best", F.explode(here).alias("at"))
        .select("scope", F.substring("lname", F.col("at"), F.col("size")).alias("lq"), "best")
        .groupBy("scope", "lq")
        .agg(F.min("best").alias("best"))
    )
    return asked.join(substrings, ["scope", "lq"]).select("q", "season", "best")


def _pattern_matches(asked, names):
    """Best player per lookup with wildcards."""
    keys = ["scope", "size", "gram"]
    patterns = asked.filter(F.col("kind") == "pattern").select(
        "q", "season", "scope", "lq", F.inline(_literal_entries(F.col("lq")))
    )
    underscores = F.length(F.regexp_replace("lq", "[^_]", "")).cast("string")
    only_wild = asked.filter(F.col("kind") == "length").select(
        "q", "season", "scope", F.lit(0).alias("size"), underscores.alias("gram")
    )
    wanted = patterns.select(*keys).unionByName(only_wild.select(*keys)).distinct()
    indexed = names.select(
        "scope", "lname", "best",
        F.inline(F.concat(_length_entries(F.col("lname")), entries(F.col("lname"), (1, 2, 3)))),
    ).join(wanted, keys, "left_semi")
    index = indexed.groupBy(*keys).agg(F.min("best").alias("best"), F.count("*").alias("names"))
    found = only_wild.join(index, keys).select("q", "season", "best")
    rarest = (
        patterns.join(index.select(*keys, "names"), keys, "left")
        .withColumn("names", F.coalesce("names", F.lit(0)))
        .groupBy("q", "season", "scope", "lq")
        .agg(F.min(F.struct("names", "size", "gram")).alias("key"))
        .filter(F.col("key.names") > 0)
        .select("q", "season", "scope", "lq", "key.size", "key.gram")
    )
    pattern = F.concat(F.lit("%"), F.col("lq"), F.lit("%"))
    verified = rarest.join(indexed, keys).filter(F.like("lname", pattern))
    return found.unionByName(verified.select("q", "season", "best"))


def match_names(lookups, players, stats):
    """The best player id per distinct (q, season); unmatched pairs are absent.

    ``lookups`` has columns q and season, ``stats`` one row per player and
    season.
    """
    asked = _lookups(lookups)
    names = _ranked_names(players, stats, asked)
    plain = _plain_matches(asked.filter(F.col("kind") == "plain"), names)
    patterns = _pattern_matches(asked.filter(F.col("kind") != "plain"), names)
    return (
        plain.unionByName(patterns)
        .groupBy("q", "season")
        .agg(F.min("best").alias("best"))
        .select("q", "season", F.col("best.gsis_id").alias("gsis_id"))
    )


def best_match(lookups, players, stats, season=None):
    """Each lookup with its best player's id, name, position, team and points.

    ``lookups`` has a column q and, unless ``season`` is given, one season per
    row. Player columns are NULL where nothing matches.
    """
    if season is not None:
        lookups = lookups.withColumn("season", F.lit(season))
    matches = match_names(lookups, players, stats)
    points = stats.select("gsis_id", "season", "fantasy_points")
    details = (
        matches.join(players.select("gsis_id", "name", "position", "team_id"), "gsis_id")
        .join(points, ["gsis_id", "season"], "left")
    )
    return lookups.join(details, ["q", "season"], "left")
