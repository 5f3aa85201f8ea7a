"""Templated answers: fact sentences, trade verdicts, the Q&A corpus."""

import re

from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger.functions import text as tx
from gridledger.functions.numeric import points_from_cents, total_tds, zero
from gridledger.operators.dims import with_player
from gridledger.operators.names import best_match
from gridledger.operators.ranking import top_n

# Fixed value: a trade within this many hundredths of a point is fair.
FAIR_CENTS = 2000

_SLOT = re.compile(r"\{(\w+)\}")


def fill(template, **slots):
    """A fixed sentence with columns (or texts) in its slots; NULLs print as nothing."""
    parts = []
    for k, piece in enumerate(_SLOT.split(template)):
        value = slots[piece] if k % 2 else piece
        if isinstance(value, str):
            parts.append(F.lit(value))
        else:
            parts.append(F.coalesce(value.cast("string"), F.lit("")))
    return F.concat(*parts)


def fact_sentences(requests, players, stats):
    """One sentence per request (q_id, q, season, intent).

    ``q`` is a name or part of it; the best scorer of that season is meant.
    """
    found = best_match(requests, players, stats).drop("fantasy_points")
    numbers = stats.drop("team_id", "player_name", "position")
    rows = found.join(
        numbers.withColumn("_has_stats", F.lit(True)), ["gsis_id", "season"], "left"
    )
    names = ("q", "season", "name", "rushing_yards", "passing_yards", "receiving_yards")
    slots = {c: F.col(c) for c in names}
    slots |= {c: zero(F.col(c)) for c in ("rushing_tds", "receiving_tds", "passing_tds")}
    slots |= {"total_tds": total_tds(rows), "points": tx.points_text(F.col("fantasy_points"))}
    intent = F.col("intent")
    sentence = (
        F.when(F.col("gsis_id").isNull(), fill(fv.FACT_UNKNOWN, **slots))
        .when(F.col("_has_stats").isNull(), fill(fv.FACT_NO_STATS, **slots))
        .when(intent == "touchdowns", fill(fv.FACT_TOUCHDOWNS, **slots))
        .when(intent == "rushing", fill(fv.FACT_RUSHING, **slots))
        .when(intent == "passing", fill(fv.FACT_PASSING, **slots))
        .when(intent == "receiving", fill(fv.FACT_RECEIVING, **slots))
        .otherwise(fill(fv.FACT_POINTS, **slots))
    )
    return rows.select("q_id", "q", "season", "intent", "gsis_id", sentence.alias("sentence"))


def trade_verdicts(trades, players, stats, season):
    """Verdict and advice per trade (q_id, give, receive).

    Positions that differ are a mismatch. The difference is taken in
    hundredths, so that exactly 20 points either way is still fair.
    """
    sides = trades.select(F.explode(F.array("give", "receive")).alias("q")).distinct()
    found = best_match(sides, players, stats, season).drop("season")

    def side(name):
        columns = [
            F.col(c).alias(f"{name}_{alias}")
            for c, alias in (
                ("gsis_id", "id"), ("name", "name"), ("position", "position"),
                ("fantasy_points", "points"),
            )
        ]
        return found.select(F.col("q").alias(name), *columns)

    rows = trades.join(side("give"), "give", "left").join(side("receive"), "receive", "left")

    def cents(name):
        return F.round(zero(F.col(f"{name}_points")) * 100).cast("long")

    gain = cents("receive") - cents("give")
    known = F.col("give_id").isNotNull() & F.col("receive_id").isNotNull()
    matched = F.col("give_position").eqNullSafe(F.col("receive_position"))
    verdict = F.when(
        known,
        F.when(~matched, "MISMATCH")
        .when(F.col("gain") > FAIR_CENTS, "WIN")
        .when(F.col("gain") < -FAIR_CENTS, "LOSS")
        .otherwise("FAIR"),
    )
    points = points_from_cents(F.col("gain"))
    sides = {f"{s}_{c}": F.col(f"{s}_{c}") for s in ("give", "receive") for c in ("name", "position")}
    difference = tx.one_decimal(points)
    advice = (
        F.when(F.col("verdict").isNull(), fv.UNKNOWN_PLAYERS)
        .when(F.col("verdict") == "MISMATCH", fill(fv.TRADE_MISMATCH, **sides))
        .when(F.col("verdict") == "WIN", fill(fv.TRADE_WIN, points=difference))
        .when(F.col("verdict") == "LOSS", fill(fv.TRADE_LOSS, points=tx.one_decimal(F.abs(points))))
        .otherwise(fill(fv.TRADE_FAIR, points=difference))
    )
    decided = rows.withColumn("gain", gain).withColumn("verdict", verdict)
    diff = F.when(F.col("verdict") == "MISMATCH", F.lit(0.0)).when(
        F.col("verdict").isNotNull(), points
    )
    return decided.withColumns({"diff": diff, "advice": advice}).select(
        "q_id", "give", "receive", "give_id", "receive_id", "verdict", "diff", "advice"
    )


def qa_corpus(players, stats, season, n=50):
    """Two question-and-answer lines for each of the n best players."""
    facts = stats.filter(F.col("season") == season).select("gsis_id", "fantasy_points")
    best = top_n(with_player(facts, players), "fantasy_points", n)
    name = F.col("name")
    who = fill(fv.CORPUS_WHO, name=name, position=F.col("position"), team=F.col("team_id"))
    points = fill(
        fv.CORPUS_POINTS, name=name, season=str(season),
        points=tx.points_text(F.col("fantasy_points")),
    )
    return best.select(
        "rank", F.posexplode(F.array(who, points)).alias("line_no", "value")
    )
