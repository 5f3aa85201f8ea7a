import glob
import random
from html.parser import HTMLParser

import pytest
from fixtures import PLAY_SCHEMA, play
from pyspark.sql import functions as F

from gridledger import fixed_values as fv
from gridledger import schemas
from gridledger.operators import boxscore, clean, projection, quality, roles
from gridledger.plans import registry, views, weekly
from gridledger.sources import boxscores, html_tables, plays, tables
from gridledger.streaming import weeks


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, season int, a int, b int")


def test_upsert_rules(spark, rows):
    target = table(spark, [("x", 1, 10, 100), ("y", 1, 20, 200)])
    source = table(spark, [("x", 1, None, 111), ("z", 1, 30, 300)])
    keys = ["id", "season"]
    assert rows(tables.upsert(target, source, keys)) == [
        ("x", 1, None, 111), ("y", 1, 20, 200), ("z", 1, 30, 300),
    ]
    listed = tables.upsert(target, source, keys, ["a"])
    assert rows(listed) == [("x", 1, None, 100), ("y", 1, 20, 200), ("z", 1, 30, 300)]
    assert rows(tables.upsert(listed, source, keys, ["a"])) == rows(listed)
    narrow = source.drop("b")
    assert rows(tables.upsert(target, narrow, keys)) == [
        ("x", 1, None, 100), ("y", 1, 20, 200), ("z", 1, 30, None),
    ]
    with pytest.raises(Exception, match="not unique"):
        tables.upsert(target, source.unionByName(source), keys).collect()


def test_versions_and_replace_from_itself(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, root)
    tables.write_replace(table(spark, [("x", 1, 1, 1)]), root)
    stored = tables.read_table(spark, root)
    tables.write_replace(stored.withColumn("a", F.col("a") + 1), root)
    assert rows(tables.read_table(spark, root)) == [("x", 1, 2, 1)]
    assert rows(stored) == [("x", 1, 1, 1)]


def test_crashed_write_is_in_nobodys_way(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    tables.write_replace(table(spark, [("x", 1, 1, 1)]), root)
    # Half a version: data without success, and a whole one that was never published.
    (tmp_path / "t" / "table" / "half" / "_temporary").mkdir(parents=True)
    tables.stage(table(spark, [("never", 9, 9, 9)]), root, "table")
    assert rows(tables.read_table(spark, root), "id") == [("x",)]
    for name in ("y", "z", "w"):
        tables.write_replace(table(spark, [(name, 1, 1, 1)]), root, keep=2)
        assert rows(tables.read_table(spark, root), "id") == [(name,)]
    assert len(glob.glob(f"{root}/table/*")) == 4  # two versions, the half one, the unpublished one


def test_tables_are_published_together_and_apart(spark, tmp_path, rows):
    root = str(tmp_path / "r")
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, root, "a")
    staged = [tables.stage(table(spark, [(n, 1, 1, 1)]), root, n)[0] for n in ("a", "b")]
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, root, "a")
    tables.publish(spark, root, sum(staged, []))
    # Two jobs that were staged side by side: neither loses the other's table.
    one, _ = tables.stage(table(spark, [("b2", 1, 1, 1)]), root, "b")
    two, _ = tables.stage(table(spark, [("a2", 1, 1, 1)]), root, "a")
    assert rows(tables.read_current(spark, root, "b"), "id") == [("b",)]
    tables.publish(spark, root, one)
    tables.publish(spark, root, two)
    got = [rows(tables.read_current(spark, root, n), "id") for n in ("a", "b")]
    assert got == [[("a2",)], [("b2",)]]


def test_parts_are_replaced_one_by_one(spark, tmp_path, rows):
    root = str(tmp_path / "p")
    first = table(spark, [("x", 1, 1, 1), ("y", 2, 2, 2), ("z", None, 3, 3)])
    staged, seen = tables.stage(first, root, "t", ["season"], metrics={"n": F.count(F.lit(1)), "b": F.sum("b")})
    tables.publish(spark, root, staged)
    assert seen == {"n": 3, "b": 6}
    before, _ = tables.current(spark, root, "t")
    staged, seen = tables.stage(
        table(spark, [("w", 2, 5, 5)]), root, "t", ["season"], scope=[(1,), (2,), (7,)], metrics={"n": F.count("*")}
    )
    tables.publish(spark, root, staged)
    assert seen == {"n": 1}
    assert rows(tables.read_current(spark, root, "t")) == [("w", 2, 5, 5), ("z", None, 3, 3)]
    after, _ = tables.current(spark, root, "t")
    assert after["_part=null"] == before["_part=null"] and after["_part=2"] != before["_part=2"]
    # A plan without rows writes nothing, and a table may end up empty with its schema.
    staged, seen = tables.stage(first.filter("false"), root, "t", ["season"], scope=[(2,)], metrics={"n": F.count("*")})
    assert not seen.get("n")
    tables.publish(spark, root, tables.replaced(spark, root, staged))
    assert tables.read_current(spark, root, "t").schema == first.schema
    assert rows(tables.read_current(spark, root, "t")) == []


def test_merge_reads_and_writes_the_parts_concerned(spark, tmp_path, rows):
    root, keys = str(tmp_path / "m"), ["id", "season"]
    for source, expected in (
        ([("x", 1, 1, 1), ("y", 2, 2, 2)], [("x", 1, 1, 1), ("y", 2, 2, 2)]),
        ([("y", 2, 9, 9), ("z", 2, 3, 3)], [("x", 1, 1, 1), ("y", 2, 9, 2), ("z", 2, 3, 3)]),
        ([("q", 4, 4, 4)], [("q", 4, 4, 4), ("x", 1, 1, 1), ("y", 2, 9, 2), ("z", 2, 3, 3)]),
        ([], [("q", 4, 4, 4), ("x", 1, 1, 1), ("y", 2, 9, 2), ("z", 2, 3, 3)]),
    ):
        touched = {f"_part={r[1]}" for r in source}
        staged, seen = tables.merge_parts(
            spark, root, "t", table(spark, source), keys, ["season"], ["a"], metrics={"n": F.count("*")}
        )
        assert {part for _, part, _, _ in staged} == touched
        tables.publish(spark, root, staged)
        assert rows(tables.read_current(spark, root, "t")) == expected
        assert seen.get("n", 0) == sum(f"_part={r[1]}" in touched for r in expected)
    with pytest.raises(Exception, match="not unique"):
        tables.merge_parts(spark, root, "t", table(spark, [("x", 1, 1, 1)] * 2), keys, ["season"])


def test_swap_empties_the_scope(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    stored = [("x", 1, 1, 1), ("y", 2, 2, 2), ("z", 3, 3, 3)]
    tables.swap_partitions(table(spark, stored), path, ["season"])
    nothing = table(spark, []).filter("false")
    tables.swap_partitions(nothing, path, ["season"], scope=[(2,), (7,)])
    assert rows(spark.read.parquet(path), "id") == [("x",), ("z",)]
    tables.swap_partitions(table(spark, [("w", 3, 1, 1)]), path, ["season"], scope=[(1,), (3,)])
    assert rows(spark.read.parquet(path), "id") == [("w",)]


def test_swap_replaces_only_its_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.swap_partitions(table(spark, [("x", 1, 1, 1), ("y", 2, 2, 2)]), path, ["season"])
    fresh = table(spark, [("z", 2, 9, 9)])
    for _ in range(2):
        tables.swap_partitions(fresh, path, ["season"])
        assert rows(spark.read.parquet(path), "id", "season") == [("x", 1), ("z", 2)]


def test_state(spark):
    state = spark.createDataFrame([("a", 2024, 5, None), ("a", 2023, 9, None)], schemas.ETL_STATE)
    assert tables.resume_point(state, "a", full_refresh=True) == (2023, 0)
    one = state.limit(1)
    assert tables.resume_point(one, "a") == (2024, 5)
    assert tables.resume_point(tables.advance(one, "a", 2025, 1), "a") == (2025, 1)
    for refresh in (False, True):
        with pytest.raises(RuntimeError):
            tables.resume_point(state, "b", refresh)


def test_lines_sink_keeps_order(spark, tmp_path):
    df = spark.createDataFrame([(i, f"line {i}") for i in range(50)], "n int, value string")
    tables.write_lines(df.orderBy("n"), str(tmp_path / "out"))
    files = sorted(glob.glob(str(tmp_path / "out/part-*")))
    text = "".join(open(f).read() for f in files).splitlines()
    assert text == [f"line {i}" for i in range(50)]


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1]])
def test_stream_recomputes_whole_weeks(spark, tmp_path, rows, order):
    schema = "id int, v int, season int, week int"
    parts = [[(1, 1, 2025, 1), (2, 5, 2025, 2)], [(3, 1, 2025, 1)], [(4, 2, 2024, 1)]]
    source, target, check = (str(tmp_path / p) for p in ("in", "out", "check"))
    for i in order:
        part = spark.createDataFrame(parts[i], schema)
        part.write.mode("append").partitionBy("season", "week").parquet(source)
        weeks.stream_weeks(spark, source, target, check, part.schema)
    got = spark.read.parquet(target)
    assert rows(got, "id", "v", "season", "week") == sorted(sum(parts, []), key=repr)
    before = sorted(glob.glob(f"{target}/*/*/*.parquet"))
    weeks.stream_weeks(spark, source, target, check, part.schema)
    assert sorted(glob.glob(f"{target}/*/*/*.parquet")) == before


def test_stream_empties_a_week_that_the_transform_filters(spark, tmp_path, rows):
    source, target, check = (str(tmp_path / p) for p in ("in", "out", "check"))
    schema, seen = "id int, season int, week int", []
    for batch in ([(1, 2025, 1), (2, 2025, 2)], [(-3, 2025, 1)]):
        part = spark.createDataFrame(batch, schema)
        part.write.mode("append").partitionBy("season", "week").parquet(source)
        weeks.stream_weeks(
            spark, source, target, check, part.schema, after=seen.append,
            # A week with a negative id is withdrawn.
            transform=lambda df: df.join(
                df.filter("id < 0").select("season", "week").distinct(), ["season", "week"], "left_anti"
            ).select("id", "season", "week"),
        )
    assert rows(spark.read.parquet(target), "id") == [(2,)]
    assert seen == [[(2025, 1), (2025, 2)], [(2025, 1)]]


def test_later_weeks_resume_from_the_state(spark, tmp_path, rows):
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    first = spark.createDataFrame([(1, 2024, 5), (2, 2025, 1)], "id int, season int, week int")
    assert weeks.load_later_weeks(spark, first, target, state, "s") == 2
    more = spark.createDataFrame([(9, 2025, 1), (3, 2025, 2)], "id int, season int, week int")
    assert weeks.load_later_weeks(spark, more, target, state, "s") == 1
    assert weeks.load_later_weeks(spark, more, target, state, "s") == 0
    assert rows(spark.read.parquet(target), "id") == [(1,), (2,), (3,)]
    assert tables.resume_point(tables.read_table(spark, state), "s") == (2025, 2)
    assert weeks.load_later_weeks(spark, first, target, state, "other") == 2


def test_later_weeks_empty_what_the_transform_leaves_nothing_of(spark, tmp_path, rows):
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    schema = "id int, season int, week int"
    lines = spark.createDataFrame([(1, 1999, 17), (2, 2025, 0), (3, 2025, 63)], schema)
    tables.swap_partitions(lines, target, weeks.KEYS)
    calls = spark.sparkContext.accumulator(0)

    def counted(value):
        calls.add(1)
        return value

    once = F.udf(counted, "int")
    loaded = weeks.load_later_weeks(
        spark, lines.withColumn("id", once("id")), target, state, "s", lambda df: df.filter("id <> 2")
    )
    assert loaded == 3 and calls.value == 3  # every row was computed once
    assert rows(spark.read.parquet(target), "id") == [(1,), (3,)]
    far = spark.createDataFrame([(4, 2025, 64)], schema)
    with pytest.raises(ValueError, match="week outside"):
        weeks.load_later_weeks(spark, far, target, str(tmp_path / "other"), "s")


def test_stream_of_csv_files_with_transform(spark, tmp_path, rows):
    source, target, check = (str(tmp_path / p) for p in ("in", "out", "check"))
    for week, name in ((1, "a"), (2, "b"), (1, "c")):
        folder = tmp_path / "in" / "season=2024" / f"week={week}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"2024_week{week}_{name}.csv").write_text(f"player,pfr_player_id\n{name},\n")
    schema = spark.createDataFrame(
        [], "player string, pfr_player_id string, season int, week int"
    ).schema
    weeks.stream_weeks(
        spark, source, target, check, schema, fmt="csv", options={"header": "true"},
        transform=lambda df: clean.rename_present(df, fv.RUSHING_ALIASES),
    )
    assert rows(spark.read.parquet(target), "player_name", "season", "week") == [
        ("a", 2024, 1), ("b", 2024, 2), ("c", 2024, 1),
    ]


def test_nan_counts_as_missing(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, float("nan")), (2, 3.0)], "week int, epa double").write.parquet(path)
    got = {r["week"]: r["epa"] for r in plays.read_plays(spark, path).collect()}
    assert got == {1: None, 2: 3.0}


def test_readers(spark, tmp_path, rows):
    header = "week,season,posteam,passing_yards,extra,sack\n"
    for year in (2023, 2025):
        (tmp_path / f"pbp_{year}.csv").write_text(header + f"1,{year},A,12,zz,1\n2,{year},B,,zz,x\n")
    skipped = []
    got = plays.read_seasons(spark, str(tmp_path / "pbp_{}.csv"), [2023, 2024, 2025],
                             plays.read_plays_csv, skipped)
    assert skipped == [2024]
    assert rows(got, "season", "week", "passing_yards", "sack") == [
        (2023, 1, 12.0, 1.0), (2023, 2, None, None), (2025, 1, 12.0, 1.0), (2025, 2, None, None),
    ]
    with pytest.raises(FileNotFoundError):
        plays.read_seasons(spark, str(tmp_path / "no_{}.csv"), [1])
    spark.createDataFrame([play(week=3)], PLAY_SCHEMA).write.parquet(str(tmp_path / "p"))
    pruned = plays.read_plays(spark, str(tmp_path / "p"), ["season", "week", "wpa"])
    assert rows(pruned) == [(2025, 3)]
    empty = plays.read_roster(spark, str(tmp_path / "roster.parquet"))
    assert empty.count() == 0 and empty.schema == schemas.ROSTER
    (tmp_path / "r.csv").write_text(
        "team,gsis_id,full_name\nX,1,Ann\nX,1,Abe\nA,1,\nY,,Bo\nA,2,\nB,2,Cy\n"
    )
    people = plays.players_from_roster(plays.read_roster(spark, str(tmp_path / "r.csv")))
    assert rows(people, "gsis_id", "name", "team_id") == [
        ("1", "Abe", "X"), ("2", "Cy", "B"), (None, "Bo", "Y"),
    ]


def test_weekly_box_files(spark, tmp_path, rows):
    head = "player_name,pfr_player_id,game_date,team,at_or_vs,opponent,game_outcome,"
    (tmp_path / "2024_week1_passing.csv").write_text(
        head + "completions,attempts,passing_yards,passing_tds,interceptions,passer_rating,"
        'season,week\nAnn,a1,2024-09-05,X,@,Y,"W, 37-20",10,20,150,1,0,99.5,2024,1\n'
    )
    (tmp_path / "2024_week1_rushing.csv").write_text(head + "carries,season,week\n")
    got = boxscores.read_weekly(spark, str(tmp_path), "passing")
    assert got.columns == [c for c in fv.BOX_SCORE_COLUMNS if c in got.columns]
    assert rows(got, "player_name", "season", "attempts", "passer_rating") == [
        ("Ann", 2024, 20, 99.5)
    ]
    outcome = spark.createDataFrame([("W, 37-20",), ("T, 3-3",), ("odd",)], "game_outcome string")
    assert rows(boxscores.parse_outcome(outcome), "result", "points_for", "points_against") == [
        ("T", 3, 3), ("W", 37, 20), (None, None, None),
    ]
    raw = spark.createDataFrame([("Ann", 2024, 1)], "player string, season int, week int")
    boxscores.write_raw(raw, str(tmp_path / "raw"), "passing")
    assert glob.glob(str(tmp_path / "raw/season=2024/week=1/category=passing/*.csv"))


PAGE = """<html><table id="other"><tbody><tr><td data-stat="player">no</td></tr></tbody></table>
<!-- <table id="rushing"><tbody>
<tr class="over thead"><th data-stat="player">Player</th></tr>
<tr><th data-stat="player" data-append-csv="AnnX01"><a href="/p/A/Ignored.htm">Ann &amp; Co</a></th>
<td data-stat="rush_att"> 3 </td><td>no stat</td></tr>
<tr><td data-stat="player"><a href="/p/B/BobY02.htm">Bob</a></td><td data-stat="rush_att">0</td></tr>
<tr><td data-stat="player">Cid</td></tr><tr></tr>
</tbody><tfoot><tr><td data-stat="player">Total</td></tr></tfoot></table> -->
<a href="/x/y.htm">a <b>link</b></a></html>"""


def test_html_tables(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE), (2, "u", "<p>none</p>"), (3, "u", None),
         (4, "u", '<table id="rush_stats"><tr><td data-stat="player">x</td></tr></table>')],
        "page_id int, url string, html string",
    )
    got = html_tables.extract_tables(pages, fv.RUSHING_TABLE_IDS)
    cells = {(r["page_id"], r["row_no"]): r["cells"] for r in got.collect()}
    assert cells == {
        (1, 0): {"player": "Ann & Co", "pfr_player_id": "AnnX01", "rush_att": "3"},
        (1, 1): {"player": "Bob", "pfr_player_id": "BobY02", "rush_att": "0"},
        (1, 2): {"player": "Cid", "pfr_player_id": None},
    }
    named = html_tables.cell_columns(got, ["player", "rush_att"])
    active = clean.has_activity(named, ["rush_att"])
    assert [r["player"] for r in active.collect()] == ["Ann & Co"]
    # The listed order of ids decides, not the order in the page.
    both = PAGE + '<table id="rush_stats"><tbody><tr><td data-stat="player">Z</td></tr></tbody></table>'
    assert html_tables.stat_rows(both, ["rushing", "rush_stats"])[0]["player"] == "Z"
    assert len(html_tables.stat_rows(both, ["rushing", "rush_stats"], comments_only=True)) == 3
    with pytest.raises(Exception, match="none of the tables"):
        html_tables.extract_tables(pages, ["passing"], True, True).collect()
    links = html_tables.page_links(pages).collect()
    assert [(r["page_id"], r["pos"], r["href"], r["link_text"]) for r in links] == [
        (1, 0, "/x/y.htm", "a link")
    ]



def _read(page):
    return [(t["id"], t["rows"]) for t in page.tables], page.links, page.comments


class _ParsedPage(html_tables._Page):
    """A page that only HTMLParser reads."""

    def _feed_plain(self, html, known):
        return False


def test_plain_pages_are_read_without_a_call_per_tag(monkeypatch):
    fed = []
    monkeypatch.setattr(HTMLParser, "feed", lambda self, html: fed.append(html))
    page = (
        '<!DOCTYPE html><html><title>T</title><table id="a"><thead><tr><th>x</th></tr></thead><tbody>\n'
        '<tr class="thead"><th data-stat="player">h</th></tr><tr><th data-stat="player">'
        '<a href="/p/Q1.htm">A &amp; B</a></th><td data-stat="n"> 1</td><td data-stat="empty"></td></tr>'
        '</tbody></table></html>'
    )
    row = {"player": "A & B", "pfr_player_id": "Q1", "n": "1", "empty": ""}
    assert html_tables.stat_rows(page, ["a"]) == [row]
    assert html_tables.stat_rows(f"<p>y</p><!-- {page} -->", ["a"]) == [row]
    assert html_tables._Page(page).links == [("/p/Q1.htm", "A & B")]
    assert fed == []


def test_pages_are_read_as_htmlparser_reads_them():
    rng, known, plain = random.Random(7), {}, 0
    bits = [
        '<table id="a">', '<table ID="b">', "</table>", "<tbody>", "</tbody>", "<tr>", "</tr>",
        '<tr class="x thead">', '<td data-stat="player">', '<th data-stat="player" data-append-csv="Q">',
        "</td>", "</th>", "</td> y", "</TD>", '<a href="/p/Z9.htm">', '<a HREF="u" href="v">', "</a>",
        "text", "&amp;", "&lt", "&", "<", ">", "--", "\n", "\x00", '"', "<br/>", "<img src=x>",
        "<!-- c -->", '<!--<table id="a"><tbody><tr><td data-stat="s">1</td></tr></table>-->', "<!---->",
        "<!-->", "<!-- a -- b -->", "<!DOCTYPE html>", "<![CDATA[x]]>", "<?p?>", "<!x>", "</ td>",
        "<script>", "</script>", "<title>T &amp; U</title>", "<style>p</style>", "<textarea>",
        "</textarea>", "<plaintext>", '<td data-stat="s" x="">', "<td data-stat='q'>",
        '<td data-stat="a&amp;b">', '</td x="1">', '<td data-stat="v"w="q">', "<noscript>",
    ]
    for _ in range(20000):
        html = "".join(rng.choice(bits) for _ in range(rng.randint(1, 9)))
        if rng.random() < 0.5:
            html = f'<table id="a"><tbody><tr>{html}</tr></tbody></table>'
        page = html_tables._Page(html, known)
        assert _read(page) == _read(_ParsedPage(html)), html
        plain += not hasattr(page, "rawdata")
    assert 2000 < plain < 18000


def test_pages_are_dealt_to_more_tasks_than_cores(spark):
    pages = views.box_pages(spark, "/root/testdata/sf0.001", "rushing")
    used = pages.select(F.spark_partition_id()).distinct().count()
    assert used > 2 * spark.sparkContext.defaultParallelism


def test_rows_of_many_pages_keep_their_page(spark, monkeypatch):
    pages = spark.range(40).selectExpr(
        "id AS page_id",
        "if(id % 3 = 0, NULL, concat('<table id=\"a\"><tbody>', array_join(transform(sequence(1, "
        "cast(id AS int)), i -> concat('<tr><td data-stat=\"n\">', i, '</td></tr>')), ''), "
        "'</tbody></table>')) AS html",
    )
    monkeypatch.setattr(html_tables, "ROWS_PER_BATCH", 7)
    got = html_tables.cell_columns(html_tables.extract_tables(pages, ["a"]), ["n", "absent"]).collect()
    expected = {(p, i, str(i + 1), None) for p in range(40) if p % 3 for i in range(p)}
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_quality(spark, rows):
    rushing = spark.createDataFrame([(-3,), (5,), (None,)], "rushing_yards int")
    people = spark.createDataFrame([("a",), (None,), ("N/A",)], "name string")
    passing = spark.createDataFrame([(0, 6), (0, 5), (9, 9)], "passing_yards int, games_played int")
    report = quality.quality_report(rushing, people, passing)
    assert rows(report) == [("negative_rushing_yards", 1), ("null_names", 1), ("stale_passers", 1)]
    with pytest.raises(RuntimeError, match="null_names: 1"):
        quality.gate(report)
    quality.gate(report.filter("issues = 0"))
    assert quality.placeholder_names(people).first()["issues"] == 2
    assert rows(quality.null_zero_profile(passing, ["passing_yards"])) == [
        ("passing_yards", 3, 0, 2)
    ]
    assert quality.null_rate(rushing, "rushing_yards").first()[0] == pytest.approx(1 / 3)
    batch = spark.createDataFrame([("a", 2024, 1), ("b", 2024, 2)],
                                  "player string, season int, week int")
    quality.check_batch(batch.limit(1), 2024, 1)
    for bad in (batch, batch.filter("false"), batch.drop("player")):
        with pytest.raises(ValueError):
            quality.check_batch(bad, 2024, 1)
    assert quality.missing_columns(batch, ["week", "epa"]) == ["epa"]


def test_projection_equals_least_squares(spark):
    import random

    import numpy as np

    rng = random.Random(2)
    rows_ = []
    for i in range(200):
        x = [rng.randint(0, 400), rng.randint(0, 5), rng.randint(0, 300), rng.randint(0, 4),
             rng.randint(0, 300), 7]
        rows_.append((f"p{i}", 2025, *x, round(sum(x) * 0.05 + rng.random(), 2)))
    columns = ["gsis_id", "season", *fv.PROJECTION_FEATURES, "fantasy_points"]
    stats = spark.createDataFrame(rows_, columns)
    got = projection.project_next_game(projection.train_projection(stats), stats)
    x = np.array([[1, *r[2:8]] for r in rows_], float)
    beta = np.linalg.lstsq(x, np.array([r[8] for r in rows_]), rcond=None)[0]
    # A constant feature carries nothing; its weight belongs to the intercept.
    beta[0] += beta[6] * 7
    beta[6] = 0
    per_game = np.hstack([x[:, :1], x[:, 1:] / 17])
    expected = dict(zip((r[0] for r in rows_), per_game @ beta))
    for row in got.collect():
        assert row["projected_fantasy_points"] == pytest.approx(expected[row["gsis_id"]], abs=0.006)
    with pytest.raises(ValueError, match="receptions"):
        projection.train_projection(stats.drop("receptions"))


def _fresh(spark, yards, team_week=1):
    passing = spark.createDataFrame(
        [("a1", "X", "Y", 2025, team_week, 3, 4, yards, 1, 0, 90.0, 1)],
        "player_id string, team string, opponent string, season int, week int, completions int, "
        "attempts int, passing_yards int, passing_tds int, interceptions int, "
        "passer_rating double, sacks int",
    )
    rushing = spark.createDataFrame(
        [("a1", "X", "Y", 2025, 1, 2, yards, 0)],
        "player_id string, team string, opponent string, season int, week int, carries int, "
        "rushing_yards int, rushing_tds int",
    )
    receiving = spark.createDataFrame(
        [("a1", "X", "Y", 2025, 1, 2, 1, 5, 0)],
        "player_id string, team string, opponent string, season int, week int, targets int, "
        "receptions int, receiving_yards int, receiving_tds int",
    )
    players = spark.createDataFrame([("a1", "Ann")], "gsis_id string, name string")
    squads = spark.createDataFrame([("t1", "X"), ("t2", "Y")], "team_id string, name string")
    fresh = weekly.box_season_tables(passing, rushing, receiving, players, squads,
                                     ("gsis_id", "player_id"), ("name", "team"))
    return fresh, players


def test_weekly_update_builds_its_box_scores_once(spark, monkeypatch):
    built = []

    def counted(function):
        return lambda *args: built.append(function.__name__) or function(*args)

    names = ["weekly_passing", "weekly_rushing", "weekly_receiving"]
    for name in names:
        monkeypatch.setattr(views, name, counted(getattr(views, name)))
    assert registry.weekly_update(spark, "/root/testdata/sf0.001").count() > 0
    assert built == names


def test_season_box_scores_are_added_up_without_sorting(spark, rows):
    fields = (
        "player_id int, team_id int, season int, week int, completions int, attempts int, "
        "passing_yards int, passing_tds int, interceptions int, sacks int, longest_pass int, "
        "passer_rating double"
    )
    lines = [
        (1, 7, 2024, 3, 1, 2, 10, 0, 0, 0, 9, 10.0), (1, 9, 2024, 3, 1, 2, 10, 0, 0, 0, 9, 10.5),
        (1, 12, 2024, 2, 1, 2, None, 0, 0, 0, 9, None), (1, -4, 2024, 130, 1, 2, 5, 0, 0, 0, 30, 0.005),
        (1, -6, 2024, 130, 0, 0, 5, 0, 0, 0, None, 0.0), (2, 5, 2024, None, 1, 1, 4, 0, 0, 0, 4, None),
        (2, 8, 2024, None, 1, 1, 4, 0, 0, 0, 4, None), (3, 2**31 - 1, 2024, -1, 1, 1, 4, 0, 0, 0, 4, None),
        (3, -(2**31), 2024, -65, 1, 1, 4, 0, 0, 0, 4, None), (4, None, 2024, 5, 1, 1, 4, 0, 0, 0, 4, 1.0),
        (4, 3, 2024, 4, 1, 1, 4, 0, 0, 0, 4, 2.0),
    ]
    resolved = spark.createDataFrame(lines, fields)
    got = boxscore.box_passing(resolved, boxscore.PLAYER_SEASON)
    shown = ["player_id", "games_played", "attempts", "passing_yards", "longest_pass", "passer_rating",
             "qbr", "team_id"]
    assert rows(got, *shown) == [
        (1, 3, 8, 30, 30, 5.13, None, -4), (2, 0, 2, 8, 4, None, None, 8),
        (3, 2, 2, 8, 4, None, None, 2**31 - 1), (4, 2, 2, 8, 4, 1.5, None, None),
    ]
    old = resolved.groupBy("player_id", "season").agg(
        F.countDistinct("week").alias("games"), F.max(F.struct("week", "team_id"))["team_id"].alias("team"),
        F.round(F.avg(F.col("passer_rating").cast("decimal(18,4)")), 2).cast("double").alias("mean"),
    )
    assert rows(old, "player_id", "games", "team", "mean") == rows(
        got, "player_id", "games_played", "team_id", "passer_rating"
    )
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    wide = resolved.withColumn("team_id", F.col("team_id").cast("string"))
    assert rows(boxscore.box_passing(wide, boxscore.PLAYER_SEASON), "player_id", "team_id")[0] == (1, "-6")


def test_weekly_update_publishes_only_healthy_data(spark, tmp_path):
    rows_ = [play(passer="a1", passing_yards=50.0, week=3, posteam="ZZZ"),
             play(passer="a1", passing_yards=10.0, week=9, posteam="BBB", epa=0.7),
             play(rusher="b1", rushing_yards=30.0), play(rusher="b1", season=2024, rushing_yards=1.0)]
    pbp = spark.createDataFrame(rows_, PLAY_SCHEMA)
    roster = plays.read_roster(spark, str(tmp_path / "absent"))
    root = str(tmp_path / "tables")
    bad, players = _fresh(spark, -5)
    with pytest.raises(RuntimeError, match="negative_rushing_yards"):
        weekly.weekly_update(spark, root, pbp, roster, 2025, bad, players)
    assert tables.versions(spark, root).isEmpty()
    with pytest.raises(RuntimeError, match="season_without_rows"):
        weekly.weekly_update(spark, root, pbp, roster, 2030, _fresh(spark, 5)[0], players)
    assert tables.versions(spark, root).isEmpty()
    weekly.update_season(spark, root, pbp, roster, 2024)
    for yards in (40, 60):
        good, players = _fresh(spark, yards)
        weekly.weekly_update(spark, root, pbp, roster, 2025, good, players)
        stored = tables.read_current(spark, root, "rushing").collect()
        assert [(r["player_id"], r["rushing_yards"]) for r in stored] == [("a1", yards)]
    stats = tables.read_current(spark, root, "season_stats")
    assert sorted((r["gsis_id"], r["season"], r["team_id"], r["fantasy_points"])
                  for r in stats.collect()) == [
        ("a1", 2025, "BBB", 0.4), ("a1", 2025, "ZZZ", 2.0), ("b1", 2024, "AAA", 0.1),
        ("b1", 2025, "AAA", 3.0),
    ]
    # The stored table still knows the latest team, and EPA as it was computed.
    latest = roles.collapse_teams(stats).filter("gsis_id = 'a1'").first()
    assert (latest["team_id"], latest["passing_epa"]) == ("BBB", 0.35)
    listed, _ = _fresh(spark, 80, team_week=2)
    weekly.upsert_season_tables(spark, root, listed, refresh_all=False)
    row = tables.read_current(spark, root, "rushing").first()
    assert (row["rushing_yards"], row["yards_per_carry"]) == (80, 30.0)
    assert boxscore.PLAYER_SEASON == ["player_id", "season"]
    # A season reloaded with nothing is empty afterwards, others stay.
    weekly.update_season(spark, root, pbp.filter("false"), roster, 2025)
    left = tables.read_current(spark, root, "season_stats").collect()
    assert [(r["gsis_id"], r["season"]) for r in left] == [("b1", 2024)]


def test_history_and_rebuild(spark):
    history = spark.createDataFrame(
        [("h", "OLD", 2023, 4, 12.5, 7)],
        "player_id string, recent_team string, season int, week int, fantasy_points_ppr double, "
        "unknown int",
    )
    pbp = spark.createDataFrame([play(passer="a1", passing_yards=50.0)], PLAY_SCHEMA)
    got = {r["gsis_id"]: r for r in weekly.rebuild_weekly(pbp, history).collect()}
    assert (got["h"]["team_id"], got["h"]["fantasy_points"], got["h"]["wopr"]) == ("OLD", 12.5, 0)
    assert got["a1"]["fantasy_points"] == 2.0


def test_rebuild_all(spark, tmp_path):
    pbp = spark.createDataFrame(
        [play(passer="a1", receiver="w", passing_yards=50.0, week=w, sack=1.0) for w in (1, 2)],
        PLAY_SCHEMA,
    )
    roster = spark.createDataFrame([("a1", "Ann", "QB", "AAA")],
                                   "gsis_id string, full_name string, position string, team string")
    root = str(tmp_path / "tables")
    weekly.rebuild_all(spark, root, roster, None, pbp)
    got = {k: tables.read_current(spark, root, k)
           for k in ("players", "weekly_stats", "season_stats", "team_season_stats")}
    assert got["players"].first()["name"] == "Ann"
    assert got["weekly_stats"].count() == 4
    season = {r["gsis_id"]: r for r in got["season_stats"].collect()}
    assert {k: r["passing_yards"] for k, r in season.items()} == {"a1": 100, "w": 0}
    a1 = season["a1"]
    assert (a1["fantasy_points"], a1["last_week"], a1["weeks"], a1["sacks_taken"]) == (4.0, 2, 2, 2)
    assert (a1["player_name"], a1["position"], season["w"]["position"]) == ("Ann", "QB", "UNK")
    totals = {r["team_id"]: r for r in got["team_season_stats"].collect()}
    assert totals["BBB"]["def_sacks_made"] == 2 and totals["AAA"]["off_sacks_allowed"] == 2
    assert got["season_stats"].columns == [f.name for f in schemas.SEASON_STATS.fields]


def test_rating_means_are_exact(spark):
    weekly_rows = spark.createDataFrame(
        [("a", "t", 2024, w, r) for w, r in enumerate((90.5, 91.0, 88.2, 90.1))],
        "player_id string, team_id string, season int, week int, passer_rating double",
    )
    assert boxscore.box_passing(weekly_rows.withColumns(
        {"completions": F.lit(1), "attempts": F.lit(2)}
    )).first()["passer_rating"] == 89.95


def test_rows_by_week_read_no_column(spark, rows, tmp_path):
    stored = [(2024, 1, "a"), (2024, 1, None), (2024, 2, "b"), (2023, 1, None), (None, 3, "c")]
    df, path = spark.createDataFrame(stored, "season int, week int, name string"), str(tmp_path / "weeks")
    df.write.partitionBy("season", "week").parquet(path)
    counted = quality.rows_by_week(spark.read.parquet(path))
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().executedPlan().toString()
    assert rows(counted) == sorted([(2024, 1, 2), (2024, 2, 1), (2023, 1, 1), (None, 3, 1)], key=repr)
    none = spark.createDataFrame([], df.schema)
    assert quality.rows_by_week(none).isEmpty()
