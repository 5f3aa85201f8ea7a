import datetime
import re
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger.functions import dates, numeric, text


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = df.select("i", expression(F.col("v")).alias("out")).collect()
    return [r["out"] for r in sorted(out, key=lambda r: r["i"])]


def test_round_ratio_is_exact(spark):
    pairs = [(a, b) for a in range(-60, 61, 7) for b in (1, 3, 7, 8, 40, 200)] + [(5, 0), (None, 3)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for scale in (1, 2, 4):
        got = df.select("a", "b", numeric.round_ratio(F.col("a"), F.col("b"), scale).alias("r"))
        for a, b, r in got.collect():
            if a is None or b == 0:
                assert r is None
                continue
            exact = (Decimal(abs(a)) / Decimal(b)).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)
            assert r == float(exact) * (-1 if a < 0 else 1)


def test_share_guards_denominator(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (1, -2), (1, None)], "a int, b int")
    got = [r[0] for r in df.select(numeric.share(F.col("a"), F.col("b"))).collect()]
    assert got == [0.25, 0.0, 0.0, 0.0]


def test_two_fantasy_formulas(spark):
    df = spark.createDataFrame(
        [(250, 2, 1, 31, 0, 0, 0, 0, 1, None), (0, 0, 0, 10, 0, 0, 0, 0, 3, 12.5),
         (None, None, None, 25, 1, 33, 1, 4, None, 0.0)],
        "passing_yards int, passing_tds int, interceptions int, rushing_yards int, "
        "rushing_tds int, receiving_yards int, receiving_tds int, receptions int, "
        "fumbles_lost int, fantasy_points double",
    )
    got = df.select(
        numeric.fantasy_points_full(df).alias("full"),
        numeric.fantasy_points_or_stored(df).alias("shown"),
    ).collect()
    assert [r["full"] for r in got] == [10 + 8 - 2 + 3.1 - 2, 1 - 6, 2.5 + 6 + 3.3 + 6 + 4]
    assert [r["shown"] for r in got] == [19.1, 12.5, 21.8]


def test_to_number_and_label(spark):
    assert column(spark, ["3.5", "", "x", None], "string", numeric.to_number) == [3.5, 0, 0, 0]
    assert column(spark, [0.0, 95.9, 29.0], "double", numeric.percentile_label) == [
        "Top 100%", "Top 5%", "Top 71%",
    ]


def test_season_and_week(spark):
    days = [datetime.date(2025, 9, 4), datetime.date(2025, 9, 5), datetime.date(2025, 9, 11),
            datetime.date(2025, 9, 12), datetime.date(2026, 1, 3), datetime.date(2026, 2, 28),
            datetime.date(2026, 3, 1), datetime.date(2024, 2, 29)]
    assert column(spark, days, "date", dates.season_of) == [
        2025, 2025, 2025, 2025, 2025, 2025, 2026, 2023,
    ]
    assert column(spark, days, "date", dates.week_of) == [1, 1, 1, 2, 18, 18, 1, 18]


def test_slug_and_link_id(spark):
    names = ["Ja'Marr  Chase", "--A.J. Brown Jr.", "Šimon 9", "", "***"]
    expected = [re.sub(r"[^a-z0-9]+", "-", n.lower()).strip("-") for n in names]
    assert column(spark, names, "string", text.slugify) == expected
    links = ["/players/A/AlleJo02.htm", "x", "/a/b/", "/p/.htmx.htm"]
    assert column(spark, links, "string", text.id_from_href) == ["AlleJo02", "x", "", "x"]


def test_points_text(spark):
    points = [374.8, 337.0, 20.25, 0.0, -3.1, 12345678.9]
    assert column(spark, points, "double", text.points_text) == [
        "374.8", "337.0", "20.25", "0.0", "-3.1", "12345678.9",
    ]


# question, candidate names, intent, (given, received) of a trade.
QUESTIONS = [
    ("Who should I draft, Josh or Lamar?", [", josh", "lamar?"], "ranking", None),
    ("top 5 qb", ["5 qb"], "ranking", None),
    ("compare Allen and Mahomes", ["allen", "mahomes"], "compare", None),
    ("a b vs c d", ["a b", "c d"], "compare", None),
    ("who is Josh Allen?", ["josh allen?"], "search", None),
    ("show me the receiver", ["show receiver"], "search", None),
    ("which te is best", ["which te"], "ranking", None),
    ("hello", ["hello"], "unknown", None),
    ("Which\nis best", ["which"], "unknown", None),
    ("x?the y", ["x? y"], "unknown", None),
    ("how many touchdowns td", ["how many touchdowns td"], "unknown", None),
    ("Trade  A B for C for D", ["trade a b c d"], "unknown", ("a b", "c for d")),
    ("trade x for", ["trade x"], "unknown", None),
    ("untrade a for b", ["untrade a b"], "unknown", ("a", "b")),
    ("  tell me about Allen  ", ["allen"], "search", None),
    ("draft him or vs", ["him"], "compare", None),
    ("A and B vs C or D", ["a b c"], "compare", None),
    ("rank and", [], "ranking", None),
    ("i", [], "unknown", None),
    ("", [], "unknown", None),
]


def test_question_words(spark):
    asked = [q for q, *_ in QUESTIONS]
    assert column(spark, asked, "string", text.name_chunks) == [n for _, n, _, _ in QUESTIONS]
    assert column(spark, asked, "string", text.classify_intent) == [i for _, _, i, _ in QUESTIONS]
    trades = [t for *_, t in QUESTIONS]
    assert column(spark, asked, "string", text.is_trade) == [t is not None for t in trades]
    for side in (1, 2):
        assert column(spark, asked, "string", lambda c: text.trade_side(c, side)) == [
            t[side - 1] if t else "" for t in trades
        ]


def test_points_need_their_columns(spark):
    df = spark.createDataFrame([(10, 1)], "rushing_yards int, rushing_tds int")
    with pytest.raises(ValueError, match="passing_yards"):
        numeric.fantasy_points_full(df)
    assert df.select(numeric.fantasy_points_full(df, missing="zero")).first()[0] == 7.0


def test_text_to_number(spark):
    assert column(spark, ["12", "x", None, " 3.5"], "string", numeric.to_number) == [12, 0, 0, 3.5]


@pytest.mark.parametrize(
    ("question", "season", "intent", "position", "metric"),
    [
        ("Points in 2023, last year", 2023, "points", None, "fantasy_points"),
        ("his rushing TD last year", 2024, "touchdowns", None, "rushing_yards"),
        ("what did the quarterback throw two years ago", 2023, "passing", "QB", "fantasy_points"),
        ("best running back scoring", 2025, "rushing", "RB", "touchdowns"),
        ("tight end catch", 2025, "receiving", "TE", "fantasy_points"),
        ("deep ball", 2025, "general", None, "passing_yards"),
    ],
)
def test_detectors(spark, question, season, intent, position, metric):
    one = spark.createDataFrame([(question,)], "q string").select(
        text.detect_season(F.col("q")), text.answer_intent(F.col("q")),
        text.detect_position(F.col("q"), with_te=True), text.detect_metric(F.col("q")),
    ).first()
    assert tuple(one) == (season, intent, position, metric)
