"""Question routing over a table of questions (q_id, text)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger.functions import text as tx
from gridledger.operators.linking import link_texts

TRADE, LIST, COMPARE, PROFILE, ANSWER, FALLBACK = (
    "trade", "list", "comparison", "profile", "answer", "fallback",
)


def _is_list(text):
    return tx.contains_any(F.lower(text), fv.LIST_WORDS)


def _may_compare(text):
    """Comparison markers present, and no earlier rule applies."""
    marked = tx.contains_any(F.lower(text), fv.COMPARE_MARKERS)
    return marked & ~tx.is_trade(text) & ~_is_list(text)


def comparison_parts(text):
    """The texts between vs, or, and, commas; surrounded by spaces."""
    return F.split(F.lower(text), fv.COMPARE_SPLIT_PATTERN)


WHOLE = -1


def _linked(questions, kb):
    """(q_id, _link, _one, _two): the player a whole question names, and the first
    two distinct players named by its parts.

    Only questions that may be comparisons are split. Whole texts and parts are
    linked in one pass.
    """
    whole = questions.select("q_id", F.lit(WHOLE).alias("part_no"), "text")
    parts = questions.filter(_may_compare(F.col("text"))).select(
        "q_id", F.posexplode(comparison_parts(F.col("text"))).alias("part_no", "text")
    )
    texts = whole.unionByName(parts).withColumn("part_key", F.struct("q_id", "part_no"))
    linked = link_texts(texts, kb, key="part_key").select(
        F.col("part_key.q_id").alias("q_id"), F.col("part_key.part_no").alias("part_no"),
        "gsis_id", "name",
    )
    # A whole text keeps its own row, as it comes before all parts otherwise.
    is_whole = F.col("part_no") == WHOLE
    first = linked.groupBy("q_id", is_whole.alias("whole"), "gsis_id", "name").agg(
        F.min("part_no").alias("part_no")
    )
    order = Window.partitionBy("q_id", "whole").orderBy("part_no")
    two = first.withColumn("n", F.row_number().over(order)).filter("n <= 2")
    player = F.struct("gsis_id", "name")

    def taken(condition):
        return F.max(F.when(condition, player))

    return two.groupBy("q_id").agg(
        taken(F.col("whole")).alias("_link"),
        taken(~F.col("whole") & (F.col("n") == 1)).alias("_one"),
        taken(~F.col("whole") & (F.col("n") == 2)).alias("_two"),
    )


def route(questions, kb):
    """Each question with its route and what the route needs.

    First rule wins: trade, list, comparison of two linked players, profile
    (the text is a name, or "who is" and a name), answer about a linked
    player, fallback.
    """
    linked = questions.join(_linked(questions, kb), "q_id", "left")
    text, name = F.col("text"), F.lower(F.col("_link.name"))
    letters = F.lower(tx.strip(F.regexp_replace(text, r"(?U)[^a-zA-Z\s]", "")))
    is_profile = (letters == name) | (letters == F.concat(F.lit("who is "), name))
    chosen = (
        F.when(tx.is_trade(text), TRADE)
        .when(_is_list(text), LIST)
        .when(F.col("_two").isNotNull(), COMPARE)
        .when(is_profile, PROFILE)
        .when(F.col("_link").isNotNull(), ANSWER)
        .otherwise(FALLBACK)
    )
    routed = linked.withColumn("route", chosen)

    def on(routes, value):
        return F.when(F.col("route").isin(*routes), value)

    single = [PROFILE, ANSWER]

    def player(field):
        return F.coalesce(
            on([COMPARE], F.col(f"_one.{field}")), on(single, F.col(f"_link.{field}"))
        )

    return routed.select(
        *questions.columns,
        "route",
        on([TRADE], tx.trade_side(text, 1)).alias("give"),
        on([TRADE], tx.trade_side(text, 2)).alias("receive"),
        on([LIST], tx.detect_position(text)).alias("position"),
        player("gsis_id").alias("player1_id"),
        player("name").alias("player1_name"),
        on([COMPARE], F.col("_two.gsis_id")).alias("player2_id"),
        on([COMPARE], F.col("_two.name")).alias("player2_name"),
    )


def parse(questions):
    """The older parser: intent, position, metric and candidate names."""
    text = F.col("text")
    lowered = tx.strip(F.lower(text))
    return questions.select(
        *questions.columns,
        tx.classify_intent(text).alias("intent"),
        tx.detect_position(lowered, with_te=True).alias("position"),
        tx.detect_metric(lowered).alias("metric"),
        tx.name_chunks(text).alias("player_names"),
    )
