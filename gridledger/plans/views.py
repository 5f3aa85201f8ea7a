"""The driver's star-schema tables seen as sports data.

``lineitem`` rows act as plays, suppliers as players, nations as teams. The
mapping is fixed and deterministic; the same definitions exist as SQL in
``oracle.py``. Each view only joins what its caller asks for.
"""

from pyspark.sql import functions as F

POSITIONS = {"ECONOMY": "QB", "SMALL": "RB", "STANDARD": "RB", "PROMO": "TE"}

# Declared, so that building a query reads no file footers.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark, sf_dir, name):
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def players(spark, sf_dir):
    position = F.lit("WR")
    for kind, code in POSITIONS.items():
        position = F.when(F.col("p_type") == kind, code).otherwise(position)
    supplier, part = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    return supplier.join(part, F.col("p_partkey") == F.col("s_suppkey")).select(
        F.col("s_suppkey").alias("gsis_id"),
        F.col("p_name").alias("name"),
        position.alias("position"),
        F.col("s_nationkey").alias("team_id"),
        F.concat(F.lit("headshots/"), F.col("s_suppkey").cast("string")).alias("headshot_url"),
    )


def messy_players(spark, sf_dir):
    """The same people with gaps: names and positions missing here and there."""
    every = F.col("gsis_id")
    return players(spark, sf_dir).withColumns(
        {
            "name": F.when(every % 13 != 4, F.col("name")),
            "position": F.when(every % 7 != 3, F.col("position")),
        }
    )


def teams(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("name")
    )


def plays(spark, sf_dir, posteam=True, defteam=True):
    """Plays; the offence needs the supplier, the defence the order's customer.

    Left joins on unique keys, so leaving a team column out changes no row.
    """
    line = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    if posteam:
        line = line.join(
            supplier.select(
                F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("posteam")
            ),
            "l_suppkey",
            "left",
        )
    if defteam:
        owners = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey"
        )
        customers = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("defteam")
        )
        # Orders meet their customers first, so that the many lines are moved once.
        owners = owners.join(customers, "o_custkey", "left").select("l_orderkey", "defteam")
        line = line.join(owners, "l_orderkey", "left")

    players_count = supplier.agg(F.count("*")).scalar()
    target, run = "l_returnflag = 'A'", "l_returnflag = 'R'"
    complete = f"({target} AND l_linestatus = 'F')"
    sack = "(l_returnflag = 'N' AND l_linenumber <= 3)"
    yards = "cast(l_quantity AS int)"
    pass_td, rush_td = f"{complete} AND l_linenumber = 1", f"{run} AND l_linenumber = 1"

    def bit(condition):
        return f"cast({condition} AS int)"

    columns = {
        "season": "year(l_shipdate)",
        "week": "cast((dayofyear(l_shipdate) - 1) div 7 + 1 AS int)",
        "play_type": f"if({run}, 'run', 'pass')",
        "passer_player_id": f"if({run}, NULL, l_suppkey)",
        "rusher_player_id": f"if({run}, l_suppkey, NULL)",
        "receiver_player_id": f"if({target}, receiver, NULL)",
        "passing_yards": f"if({complete}, {yards}, NULL)",
        "rushing_yards": f"if({run}, {yards} - 5, NULL)",
        "receiving_yards": f"if({complete}, {yards}, NULL)",
        "yards_gained": f"if({complete}, {yards}, if({run}, {yards} - 5, 0))",
        "air_yards": f"if({target}, 3 * l_linenumber, NULL)",
        "yards_after_catch": f"if({complete}, {yards} % 7, NULL)",
        "epa": "if(l_tax <> 0, cast(cast(l_discount AS decimal(5,2)) - 0.05 AS double), NULL)",
        "cpoe": "if(l_discount <> 0, cast(cast(l_tax AS decimal(5,2)) - 0.04 AS double), NULL)",
        "pass_touchdown": bit(pass_td),
        "rush_touchdown": bit(rush_td),
        "touchdown": bit(f"({pass_td}) OR ({rush_td})"),
        "interception": bit(f"{target} AND l_linestatus = 'O' AND l_linenumber = 2"),
        "fumble_lost": bit(f"{run} AND l_linenumber = 7"),
        "sack": bit(sack),
        "complete_pass": bit(complete),
        "pass_attempt": bit(f"NOT ({run}) AND NOT {sack}"),
        "rush_attempt": bit(run),
    }
    shown = [c for c, kept in (("posteam", posteam), ("defteam", defteam)) if kept]
    receiver = (F.col("l_suppkey") + F.col("l_partkey")) % players_count
    return line.withColumn("receiver", receiver).selectExpr(
        *shown, *[f"{expression} AS {name}" for name, expression in columns.items()]
    )


def _weekly(spark, sf_dir, role, measures):
    """Box scores by (player, team, opponent, season, week) with names attached."""
    keys = ["posteam", "defteam", "season", "week"]
    rows = plays(spark, sf_dir).withColumn("player_id", F.col(f"{role}_player_id"))
    rows = rows.filter(F.col("player_id").isNotNull())
    grouped = rows.groupBy("player_id", *keys).agg(*measures)
    squads = teams(spark, sf_dir)
    names = players(spark, sf_dir).select(
        F.col("gsis_id").alias("player_id"), F.col("name").alias("player_name")
    )
    return (
        grouped.join(squads.select(F.col("team_id").alias("posteam"), F.col("name").alias("team")),
                     "posteam")
        .join(squads.select(F.col("team_id").alias("defteam"), F.col("name").alias("opponent")),
              "defteam")
        .join(names, "player_id")
        .drop("defteam")
        .withColumnRenamed("posteam", "team_id")
    )


def _sum(column, alias=None):
    return F.sum(column).alias(alias or column)


def weekly_passing(spark, sf_dir):
    rows = _weekly(
        spark, sf_dir, "passer",
        [
            _sum("complete_pass", "completions"), _sum("pass_attempt", "attempts"),
            _sum("passing_yards"), _sum("pass_touchdown", "passing_tds"),
            _sum("interception", "interceptions"), _sum("sack", "sacks"),
            F.max("passing_yards").alias("longest_pass"),
        ],
    )
    tenths = F.call_function(
        "div", F.col("completions") * 1000, F.when(F.col("attempts") > 0, F.col("attempts"))
    )
    return rows.withColumn("passer_rating", tenths.cast("double") / F.lit(10.0))


def weekly_rushing(spark, sf_dir):
    return _weekly(
        spark, sf_dir, "rusher",
        [
            _sum("rush_attempt", "carries"), _sum("rushing_yards"),
            _sum("rush_touchdown", "rushing_tds"), F.max("rushing_yards").alias("longest_rush"),
        ],
    )


def weekly_receiving(spark, sf_dir):
    return _weekly(
        spark, sf_dir, "receiver",
        [
            F.count("*").alias("targets"), _sum("complete_pass", "receptions"),
            _sum("receiving_yards"), _sum("pass_touchdown", "receiving_tds"),
            F.max("receiving_yards").alias("longest_reception"),
        ],
    )


# Question templates over two players' names, with their last and first words.
TEMPLATES = [
    "Trade {x} for {y}",
    "{x} vs {y}",
    "Top QB this year",
    "Who is {x}?",
    "How many touchdowns did {x} score in 1998?",
    "{x}",
    "compare {x} and {y}",
    "did {x_last} rush better last year",
    "How many points did {x_first} score",
    "tell me about the weather",
    "Which receiver is best, {x} or {y}?",
    "trade {x_last} for {y_first}",
    "{x_last} , {y} or {x}",
    "how did {y} throw two years ago",
    "show me {x} running in 2000",
]


def pairs(spark, sf_dir):
    """Every player with another one, ids wrapping around."""
    supplier = table(spark, sf_dir, "supplier")
    count = supplier.agg(F.count("*")).scalar()
    return supplier.select(
        F.col("s_suppkey").alias("p1"), ((F.col("s_suppkey") * 7 + 3) % count).alias("p2")
    )


def questions(spark, sf_dir):
    """All templates for all pairs: (q_id, text).

    The pairs come from one small file; they are spread over the cores before
    each of them becomes many texts.
    """
    names = players(spark, sf_dir).select("gsis_id", "name")
    both = (
        pairs(spark, sf_dir)
        .join(names.toDF("p1", "x"), "p1")
        .join(names.toDF("p2", "y"), "p2")
        .repartition(spark.sparkContext.defaultParallelism)
        .withColumns(
            {
                "x_first": F.substring_index("x", " ", 1),
                "x_last": F.substring_index("x", " ", -1),
                "y_first": F.substring_index("y", " ", 1),
            }
        )
    )
    texts = []
    for template in TEMPLATES:
        filled = F.lit(template)
        for slot in ("x", "y", "x_first", "x_last", "y_first"):
            filled = F.replace(filled, F.lit("{%s}" % slot), F.col(slot))
        texts.append(filled)
    return both.select("p1", F.posexplode(F.array(*texts)).alias("t", "text")).select(
        (F.col("p1") * len(TEMPLATES) + F.col("t")).alias("q_id"), "text"
    )


# Pages: category -> (shown table id, hidden table id, data-stat -> column).
PAGE_KINDS = {
    "passing": (
        "passing", "qb_stats",
        {"team": "team", "opp": "opponent", "pass_cmp": "completions", "pass_att": "attempts",
         "pass_yds": "passing_yards", "pass_td": "passing_tds"},
    ),
    "rushing": (
        "rushing_and_receiving", "rushing",
        {"team": "team", "opp": "opponent", "rush_att": "carries", "rush_yds": "rushing_yards",
         "rush_td": "rushing_tds"},
    ),
    "receiving": (
        "receiving", "rec_stats",
        {"team": "team", "opp": "opponent", "rec_tgt": "targets", "rec": "receptions",
         "rec_yds": "receiving_yards", "rec_td": "receiving_tds"},
    ),
}


def weekly(spark, sf_dir, category):
    return {"passing": weekly_passing, "rushing": weekly_rushing, "receiving": weekly_receiving}[
        category
    ](spark, sf_dir)


def box_pages(spark, sf_dir, category="passing", comments_only=False):
    """One HTML page per weekly line: (page_id, html).

    Pages of odd weeks show the table, with the id as a cell attribute; in
    even weeks it sits in a comment and the id only in the link.
    ``comments_only`` hides the first table id in a comment on every page.

    Lines are short and pages long and slow to read: adaptive execution would leave one
    task per core and one over. They are dealt to some more while they are still lines.
    """
    shown_id, hidden_id, stats = PAGE_KINDS[category]
    keys = ["player_id", "team", "opponent", "season", "week"]
    tasks = 4 * spark.sparkContext.defaultParallelism
    line = weekly(spark, sf_dir, category).repartition(tasks, *keys)
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in line.columns}

    def cell(stat, column):
        return F.concat(F.lit(f'<td data-stat="{stat}"> '), text[column], F.lit("</td>"))

    cells = F.concat(*[cell(stat, column) for stat, column in stats.items()],
                     F.lit("<td>note</td>"))
    link = F.concat(F.lit('<a href="/players/P'), text["player_id"], F.lit('.htm">'),
                    text["player_name"], F.lit("</a>"))
    header = F.lit(
        '<thead><tr><th data-stat="player">Player</th></tr></thead><tbody>'
        '<tr class="over thead"><th data-stat="player">Player</th></tr><tr>'
    )
    shown = F.concat(
        F.lit('<html><table id="scores"><tbody><tr><td data-stat="player">x</td></tr></tbody>'
              f'</table><table class="stats" id="{shown_id}">'), header,
        F.lit('<th data-stat="player" data-append-csv="P'), text["player_id"], F.lit('">'), link,
        F.lit("</th>"), cells, F.lit("</tr></tbody></table></html>"),
    )
    in_comment = shown_id if comments_only else hidden_id
    hidden = F.concat(
        F.lit(f'<html><p>stats</p><!-- no table --><!-- <div><table id="{in_comment}">'), header,
        F.lit('<th data-stat="player">'), link, F.lit("</th>"), cells,
        F.lit("</tr></tbody></table></div> --></html>"),
    )
    visible = F.lit(False) if comments_only else F.col("week") % 2 == 1
    return line.select(
        F.concat_ws("-", *keys).alias("page_id"),
        F.when(visible, shown).otherwise(hidden).alias("html"),
    )
