"""Answers for a whole table of questions."""

from functools import reduce

from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger.functions import text as tx
from gridledger.operators import answers, questions, ranking
from gridledger.sources.tables import materialize

FALLBACK_TEXT = fv.FALLBACK_TEXT

# What an answer shows: a line per listed player, season or trade side.
_ITEM = ("label", "rank", "gsis_id", "name", "position", "team_id", "season", "fantasy_points")


def routed_questions(asked, kb):
    """Questions routed once and stored by route, for the branches to read."""
    return materialize(questions.route(asked, kb), "routed", partition_by=["route"])


def fact_requests(routed, season, year_pattern=fv.YEAR_PATTERN):
    """What the answer branch asks for: (q_id, q, season, intent)."""
    text = F.col("text")
    return routed.filter(F.col("route") == questions.ANSWER).select(
        "q_id", F.col("player1_name").alias("q"),
        tx.detect_season(text, season, year_pattern).alias("season"),
        tx.answer_intent(text).alias("intent"),
    )


def _item(label, **known):
    """One line; fields it does not know are NULL."""
    fields = {"label": label, "rank": F.lit(None).cast("int")} | known
    return F.struct(*[fields[c].alias(c) for c in _ITEM])


def board_items(players, stats, season, n=5):
    """key (a position, or '' for the whole board) -> items of its n best players."""
    board = ranking.draft_board(stats, players, season, n)
    item = _item(
        F.col("position"), rank=F.col("rank"), gsis_id=F.col("gsis_id"), name=F.col("name"),
        position=F.col("position"), team_id=F.col("team_id"), season=F.lit(season),
        fantasy_points=F.col("fantasy"),
    )
    keys = F.explode(F.array(F.col("position"), F.lit("")))
    # At most n players for each of three positions.
    return board.select(keys.alias("key"), item.alias("item")).groupBy("key").agg(
        F.array_sort(F.collect_list("item")).alias("items")
    )


def season_items(players, stats):
    """gsis_id -> items of the player's seasons, in order."""
    item = _item(
        F.lit(None).cast("string"), gsis_id=F.col("gsis_id"), name=F.col("name"),
        position=F.col("position"), team_id=F.col("team_id"), season=F.col("season"),
        fantasy_points=F.col("fantasy_points"),
    )
    people = players.select("gsis_id", "name", "position", "team_id")
    lines = stats.select("gsis_id", "season", "fantasy_points")
    return people.join(lines, "gsis_id").select("gsis_id", "season", item.alias("item")).groupBy(
        "gsis_id"
    ).agg(F.array_sort(F.collect_list(F.struct("season", "item"))).alias("lines")).select(
        "gsis_id", F.col("lines.item").alias("items")
    )


_ITEMS = (
    "array<struct<label:string,rank:int,gsis_id:string,name:string,position:string,"
    "team_id:string,season:int,fantasy_points:double>>"
)


def _labelled(label, items):
    """The items under a label; none where there are none."""
    named = F.transform(items, lambda i: i.withField("label", F.lit(label)))
    return F.coalesce(named, F.array().cast(_ITEMS))


def answer_questions(asked, kb, players, stats, season, year_pattern=fv.YEAR_PATTERN):
    """One row per question: type, response, what it is about and what it shows.

    ``items`` holds the lines shown with the response: the best players of a list,
    the seasons of both compared players, the two sides of a trade. Each branch
    reads its own questions and joins only what it needs.
    """
    routed = routed_questions(asked, kb)

    def branch(route):
        return routed.filter(F.col("route") == route)

    people = players.select(
        F.col("gsis_id").cast("string").alias("gsis_id"), "name", "position",
        F.col("team_id").cast("string").alias("team_id"),
    )
    points = stats.select(
        F.col("gsis_id").cast("string").alias("gsis_id"), F.col("season").cast("int").alias("season"),
        F.col("fantasy_points").cast("double").alias("fantasy_points"),
    )
    seasons = season_items(people, points)

    def side_lines(rows, side, lines):
        """The items of one player of each row."""
        own = lines.select(F.col("gsis_id").alias("_side"), F.col("items").alias(f"_{side}"))
        joined = rows.withColumn("_side", F.col(f"{side}_id").cast("string"))
        return joined.join(own, "_side", "left").drop("_side")

    this_season = season_items(people, points.filter(F.col("season") == season))
    nobody = people.join(points.filter(F.col("season") == season), "gsis_id", "left_anti")
    without = nobody.select(
        "gsis_id",
        F.array(
            _item(
                F.lit(None).cast("string"), gsis_id=F.col("gsis_id"), name=F.col("name"),
                position=F.col("position"), team_id=F.col("team_id"), season=F.lit(season),
                fantasy_points=F.lit(None).cast("double"),
            )
        ).alias("items"),
    )
    trade_lines = this_season.unionByName(without)
    trades = answers.trade_verdicts(
        branch(questions.TRADE).select("q_id", "give", "receive"), players, stats, season
    )
    trades = side_lines(side_lines(trades, "give", trade_lines), "receive", trade_lines)
    trades = trades.select(
        "q_id", F.when(F.col("verdict").isNotNull(), "trade_analysis").alias("type"),
        F.col("advice").alias("response"), F.col("give_id").alias("player1_id"),
        F.col("receive_id").alias("player2_id"), "verdict", "diff",
        F.concat(_labelled("give", F.col("_give")), _labelled("receive", F.col("_receive")))
        .alias("items"),
    )
    lists = branch(questions.LIST).withColumn("_key", F.coalesce("position", F.lit("")))
    board = board_items(people, stats.withColumn("gsis_id", F.col("gsis_id").cast("string")), season)
    lists = lists.join(board.withColumnRenamed("key", "_key"), "_key", "left").select(
        "q_id", F.lit("draft_board").alias("type"),
        answers.fill(
            fv.LIST_TEXT, position=F.coalesce("position", F.lit(fv.LIST_ALL)), season=str(season)
        ).alias("response"),
        "position", "items",
    )
    compared = branch(questions.COMPARE)
    compared = side_lines(side_lines(compared, "player1", seasons), "player2", seasons).select(
        "q_id", F.lit("comparison").alias("type"),
        answers.fill(
            fv.COMPARE_TEXT, one=F.col("player1_name"), two=F.col("player2_name")
        ).alias("response"),
        "player1_id", "player2_id",
        F.concat(_labelled("1", F.col("_player1")), _labelled("2", F.col("_player2"))).alias("items"),
    )
    shown = branch(questions.PROFILE).select(
        "q_id", F.lit("player_profile").alias("type"),
        answers.fill(fv.PROFILE_TEXT, name=F.col("player1_name")).alias("response"),
        "player1_id",
    )
    requests = fact_requests(routed, season, year_pattern)
    facts = answers.fact_sentences(requests, players, stats).select(
        "q_id", F.lit("text_only").alias("type"), F.col("sentence").alias("response"),
        F.col("gsis_id").alias("player1_id"),
    )
    rest = branch(questions.FALLBACK).select(
        "q_id", F.lit(None).cast("string").alias("type"), F.lit(FALLBACK_TEXT).alias("response")
    )
    parts = [trades, lists, compared, shown, facts, rest]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
