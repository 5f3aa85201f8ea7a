import re

import pytest
from pyspark.sql import functions as F

from gridledger.operators import answers, corpus, linking, membership, names, questions
from gridledger.plans import chat

PLAYERS = [
    ("p1", "Josh Allen", "QB", "BUF"), ("p2", "Lamar Jackson", "QB", "BAL"),
    ("p3", "Josh Jacobs", "RB", "GB"), ("p4", "Adoree Jackson", "WR", "NYG"),
    ("p5", "A.J. Brown", "WR", "PHI"), ("p6", "Al", "TE", "X"), ("p7", "100%_x\\y", "WR", "Y"),
    ("p8", "Josh Allen", "WR", "JAX"), ("p9", None, "QB", "Z"), ("q0", "Jo", "WR", "Q"),
]
POINTS = [("p1", 300.5), ("p2", 310.25), ("p3", 200.0), ("p4", 20.0), ("p5", 180.75), ("p6", 1.0),
          ("p8", None), ("q0", 5.5)]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        PLAYERS, "gsis_id string, name string, position string, team_id string"
    )


@pytest.fixture(scope="module")
def stats(spark):
    rows = [(p, 2025, v, 1, 2, 30, 4, 50, 6) for p, v in POINTS]
    rows += [("p4", 2024, 500.0, 0, 0, 0, 0, 0, 0), ("p8", 2024, 7.0, 0, 0, 0, 0, 0, 0)]
    given = spark.createDataFrame(
        rows, "gsis_id string, season int, fantasy_points double, passing_tds bigint, "
              "rushing_tds bigint, passing_yards bigint, receiving_tds bigint, "
              "rushing_yards bigint, receiving_yards bigint",
    )
    return given.selectExpr("*", "0L AS interceptions", "0L AS receptions")


@pytest.fixture(scope="module")
def kb(spark):
    known = [(p[0], p[1], dict(POINTS).get(p[0])) for p in PLAYERS]
    return spark.createDataFrame(known, "gsis_id string, name string, fantasy_points double")


def like_regex(pattern):
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
        i += 1
    return re.compile(out, re.S | re.I)


def brute_match(q, season, all_stats):
    hits = [p for p in PLAYERS if p[1] and like_regex(f"%{q}%").fullmatch(p[1])]
    points = {p: v for p, s, v in all_stats if s == season and v is not None}
    hits.sort(key=lambda p: (p[0] not in points, -points.get(p[0], 0), p[0]))
    return hits[0][0] if hits else None


def test_best_match_equals_like(spark, people, stats):
    asked = ["josh", "JOSH ALLEN", "allen", "a", "ja", "jac", "J_sh", "j%n", "", "%", "_", "___",
             "__________________", "%%", "xyz", "al", "o", ".J.", "x\\", "\\%", "\\_x", "\\\\",
             "%_x", "l\\a", "josh%b", "100\\%", "ckson", "brownx", "_o", "jos_ ", "\\"]
    pairs = [(q, s) for q in asked for s in (2025, 2024, 1990)] + [(None, 2025)]
    lookups = spark.createDataFrame(pairs, "q string, season int")
    known = [(r["gsis_id"], r["season"], r["fantasy_points"]) for r in stats.collect()]
    got = {(r["q"], r["season"]): r["gsis_id"]
           for r in names.best_match(lookups, people, stats).collect()}
    assert len(got) == len(pairs)
    for q, season in pairs:
        expected = None if q is None else brute_match(q.replace("l\\a", "la"), season, known)
        assert got[q, season] == expected, (q, season)


# text, linked player, class. "allen" holds "al" and "josh" holds "jo", both names.
LINKED = [
    ("Josh Allen vs Lamar Jackson", "p2", 1),
    ("lamar", "p2", 3),
    ("jackson?", None, None),
    ("how is JACKSON", "p2", 2),
    ("josh", "q0", 1),
    ("al and jo", "q0", 1),
    ("xAl Pacino", "p6", 1),
    ("", None, None),
    (None, None, None),
    ("a.j. news", "p5", 3),
    ("nobody here", None, None),
    ("brown 100%_x\\y", "p7", 1),
    ("Jacobs   or\tAllen", "p6", 1),
    ("adoree jackson , josh jacobs", "p3", 1),
    ("JACOBS", "p3", 2),
    ("josh  allen", "q0", 1),
    ("vs", None, None),
    ("x" * 5000 + " adoree jackson", "p4", 1),
    ("x" * 255 + "A.J. Brown" + "x" * 600, "p5", 1),
]


def test_linker(spark, kb):
    frame = spark.createDataFrame(
        [(i, t) for i, (t, _, _) in enumerate(LINKED)], "q_id int, text string"
    )
    linked = linking.link_entities(frame, kb).collect()
    got = {r["q_id"]: (r["gsis_id"], r["link_class"]) for r in linked}
    assert len(linked) == len(LINKED)
    names_of = {p[0]: p[1] for p in PLAYERS}
    for i, (text, player, link_class) in enumerate(LINKED):
        assert got[i] == (player, link_class), text
    assert all(r["name"] == names_of.get(r["gsis_id"]) for r in linked)


def test_linking_carries_candidates_only(spark, kb):
    def places(text, wanted):
        texts = spark.createDataFrame([(1, text)], "k int, lowered string")
        return linking.parts_of(texts, "k", wanted, 4)

    filler = "abcdefghij" * 4000
    names = linking.index(kb)
    wanted = lambda part: membership.may_contain(names.filter, F.xxhash64(part))
    # No row per character leaves the scan, and none has more than the surrounding.
    assert places(filler, wanted).count() < len(filler) / 20
    found = places(filler[:-7] + " adoree jackson " + filler, lambda part: part == "adoree").collect()
    assert [(r["part"], r["around"]) for r in found] == [("adoree", "abc adoree jac")]
    every = places(filler, lambda part: F.lit(True))
    assert every.filter("length(part) = 6").count() == len(filler) - 5
    assert every.filter("length(around) > 14").count() == 0


def test_linking_against_a_large_knowledge_base(spark):
    names = [f"{a}{i}{b} {c}" for i in range(40) for a in ("jo", "al", "x") for b in ("", "y") for c in ("smith", "o'neal-long", "é")]
    kb = spark.createDataFrame([(f"p{i}", n, float(i % 17)) for i, n in enumerate(names)], "gsis_id string, name string, fantasy_points double")
    texts = [f"..{n}{'z' * (i % 3)} said {'w' * (i * 97 % 900)}" for i, n in enumerate(names)] + ["no one", "jo1"]
    frame = spark.createDataFrame(list(enumerate(texts)), "q_id int, text string")
    ranked = sorted(range(len(names)), key=lambda i: (-float(i % 17), f"p{i}"))

    def plain(text):
        for test in (
            lambda n: n in text, lambda n: n.split()[-1] in text.split(), lambda n: n.split()[0] in text.split(),
        ):
            for i in ranked:
                if test(names[i]):
                    return f"p{i}"

    got = {r["q_id"]: r["gsis_id"] for r in linking.link_entities(frame, linking.index(kb)).collect()}
    assert got == {k: plain(t) for k, t in enumerate(texts)}
    assert {r["q_id"]: r["gsis_id"] for r in linking.link_entities(frame, kb).collect()} == got


def test_membership(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("key"))
    row = membership.bitmap(keys, "key")
    assert len(row.first()["words"]) == membership.BITS // 64
    assert keys.filter(membership.may_contain(row, F.col("key"))).count() == 20_000
    others = spark.range(1_000_000, 1_200_000).select(F.xxhash64("id").alias("key"))
    passed = others.filter(membership.may_contain(row, F.col("key"))).count()
    assert passed < 200_000 * 2 * membership.false_share(20_000) + 20
    none = membership.bitmap(keys.limit(0), "key")
    assert keys.filter(membership.may_contain(none, F.col("key"))).count() == 0


ROUTED = {
    "Trade Lamar for Josh Allen": ("trade", None, None),
    "top quarterbacks": ("list", None, None),
    # "vs." is no marker, so the better ranked of both names is answered about.
    "Josh Allen vs. Lamar Jackson": ("answer", "p2", None),
    "Josh Allen vs Lamar Jackson": ("comparison", "p1", "p2"),
    # A full name anywhere in the text wins: "allen" holds "al", "josh" holds "jo".
    "compare lamar and allen": ("comparison", "p2", "p6"),
    "jackson or jackson": ("answer", "p2", None),
    "lamar , josh or brown is better": ("comparison", "p2", "q0"),
    "Josh Allen": ("profile", "p1", None),
    "who is Lamar Jackson?": ("profile", "p2", None),
    "how many points did Jacobs score": ("answer", "p3", None),
    "weather": ("fallback", None, None),
}


def test_routes(spark, kb):
    frame = spark.createDataFrame(list(enumerate(ROUTED)), "q_id int, text string")
    got = {r["text"]: (r["route"], r["player1_id"], r["player2_id"])
           for r in questions.route(frame, kb).collect()}
    assert got == ROUTED


def test_trade_verdicts(spark, people, stats):
    trades = spark.createDataFrame(
        [(1, "lamar", "josh allen"), (2, "jacobs", "lamar"), (3, "brown", "adoree"),
         (4, "adoree", "brown"), (5, "nobody", "brown"), (6, "al", "al"), (7, "%_x", "adoree")],
        "q_id int, give string, receive string",
    )
    got = {r["q_id"]: r for r in answers.trade_verdicts(trades, people, stats, 2025).collect()}
    assert (got[1]["verdict"], got[1]["diff"]) == ("FAIR", -9.75)
    assert got[1]["advice"] == "The difference is only -9.8 points. It is a fair trade."
    assert (got[2]["verdict"], got[2]["diff"]) == ("MISMATCH", 0.0)
    assert "You cannot trade a RB (Josh Jacobs) for a QB (Lamar Jackson)" in got[2]["advice"]
    assert got[3]["verdict"] == "LOSS" and got[3]["advice"].startswith("You lose 160.8 points.")
    assert got[4]["verdict"] == "WIN" and got[4]["advice"].startswith("You gain 160.8 points.")
    assert got[5]["verdict"] is None and got[5]["diff"] is None
    assert (got[7]["verdict"], got[7]["diff"]) == ("FAIR", 20.0)


def test_exactly_twenty_points_is_fair(spark, people):
    stats = spark.createDataFrame([("p1", 2025, 120.1), ("p2", 2025, 100.1)],
                                  "gsis_id string, season int, fantasy_points double")
    trades = spark.createDataFrame([(1, "lamar", "josh allen")],
                                   "q_id int, give string, receive string")
    got = answers.trade_verdicts(trades, people, stats, 2025).first()
    assert (got["verdict"], got["diff"]) == ("FAIR", 20.0)


def test_fact_sentences(spark, people, stats):
    requests = spark.createDataFrame(
        [(1, "Lamar Jackson", 2025, "touchdowns"), (2, "josh allen", 2025, "rushing"),
         (3, "Al", 2030, "points"), (4, "nobody", 2025, "passing"), (5, "adoree", 2024, "general"),
         (6, "josh allen", 2025, "passing"), (7, "josh allen", 2025, "receiving")],
        "q_id int, q string, season int, intent string",
    )
    got = {r["q_id"]: r["sentence"]
           for r in answers.fact_sentences(requests, people, stats).collect()}
    assert got[1] == ("In 2025, Lamar Jackson scored 7 total touchdowns "
                      "(2 rushing, 4 receiving, 1 passing).")
    assert got[2] == "In 2025, Josh Allen rushed for 50 yards and 2 touchdowns."
    assert got[3] == "Info: Josh Allen has no recorded stats for the 2030 season."
    assert got[4] == "I couldn't find stats for nobody in 2025."
    assert got[5] == "In 2024, Adoree Jackson scored 500.0 fantasy points."
    assert got[6] == "In 2025, Josh Allen threw for 30 yards and 1 touchdowns."
    assert got[7] == "In 2025, Josh Allen caught 6 receiving yards and 4 touchdowns."


def test_chat_answers_every_question_once(spark, people, stats, kb):
    asked = spark.createDataFrame(list(enumerate(ROUTED)), "q_id int, text string")
    got = {r["q_id"]: r for r in chat.answer_questions(asked, kb, people, stats, 2025).collect()}
    assert len(got) == len(ROUTED)
    responses = [got[i]["response"] for i in range(len(ROUTED))]
    assert responses[1] == "Here are the top QB for 2025:"
    assert responses[3] == "Comparing Josh Allen and Lamar Jackson..."
    assert responses[7] == "Here is the profile for Josh Allen:"
    assert responses[9] == "In 2025, Josh Jacobs scored 200.0 fantasy points."
    assert responses[10] == chat.FALLBACK_TEXT

    def shown(i):
        return [(x["label"], x["name"], x["season"], x["fantasy_points"]) for x in got[i]["items"]]

    assert shown(0) == [("give", "Lamar Jackson", 2025, 310.25), ("receive", "Josh Allen", 2025, 300.5)]
    assert shown(1) == [("QB", "Lamar Jackson", 2025, 310.25), ("QB", "Josh Allen", 2025, 300.5)]
    assert shown(3) == [("1", "Josh Allen", 2025, 300.5), ("2", "Lamar Jackson", 2025, 310.25)]
    assert got[10]["items"] is None


def test_qa_corpus_lines(spark, people, stats):
    lines = answers.qa_corpus(people, stats, 2025, n=2).orderBy("rank", "line_no").collect()
    assert [r["value"] for r in lines] == [
        "Question: Who is Lamar Jackson? Answer: Lamar Jackson is a QB for the BAL.",
        "Question: How many points did Lamar Jackson score in 2025? Answer: Lamar Jackson scored "
        "310.25 fantasy points.",
        "Question: Who is Josh Allen? Answer: Josh Allen is a QB for the BUF.",
        "Question: How many points did Josh Allen score in 2025? Answer: Josh Allen scored "
        "300.5 fantasy points.",
    ]


def test_vocab_encoding_and_decoding(spark):
    values = ["Ja'Marr Ché", "x" * 63, "y" * 64, "ab" * 50, "", "日本 𝄞 z", "é𝄞" * 400]
    lines = spark.createDataFrame(list(enumerate(values)), "n int, value string")
    vocab = corpus.char_vocab(lines)
    expected = {c: i + 1 for i, c in enumerate(sorted(set("".join(values))))}
    assert {r["ch"]: r["idx"] for r in vocab.collect()} == expected
    shifted = {(r["n"], r["seq_no"]): r for r in corpus.encode_shift(lines, vocab).collect()}
    pieces = {
        (n, k): value[64 * k : 64 * k + 64]
        for n, value in enumerate(values)
        for k in range(max(1, -(-len(value) // 64)))
    }
    assert set(shifted) == set(pieces)
    for key, piece in pieces.items():
        ids = [expected[c] for c in piece]
        ids += [0] * (64 - len(ids))
        assert shifted[key]["input_ids"] == ids[:-1] and shifted[key]["target_ids"] == ids[1:]
    decoded = corpus.decode(corpus.encode(lines, vocab), vocab)
    whole = corpus.join_sequences(decoded, ["n"]).collect()
    assert {r["n"]: r["decoded"] for r in whole} == dict(enumerate(values))
    cut = corpus.decode(corpus.encode(lines, vocab, truncate=True), vocab).collect()
    assert {r["n"]: r["decoded"] for r in cut} == {n: v[:64] for n, v in enumerate(values)}
    unknown = spark.createDataFrame([(1, "Q!")], "n int, value string")
    assert corpus.encode(unknown, vocab).first()["encoded"] == [0] * 64
    some = spark.createDataFrame([(1, [1, 9999, 0])], "n int, encoded array<int>")
    assert corpus.decode(some, vocab).first()["decoded"] == sorted(expected)[0]


def test_characters_are_looked_up_by_batches(spark):
    values = ["", "a", "é" * 130, "𝄞b" * 40, "q", None]
    lines = spark.createDataFrame(list(enumerate(values)), "n int, value string")
    vocab = corpus.char_vocab(lines.filter("n <> 4"))
    encoded = corpus.encode(lines, vocab, max_len=50)
    decoded = corpus.decode(encoded, vocab)
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan
    whole = {r["n"]: r["decoded"] for r in corpus.join_sequences(decoded, ["n"]).collect()}
    # A character outside the vocabulary is padding, as a line without text is.
    assert whole == dict(enumerate(values)) | {4: "", 5: ""}
    ids = [[1, None, 3, 0, -2, 99], None, [], [None], [2, 2]]
    arrays = spark.createDataFrame(list(enumerate(ids)), "n int, encoded array<int>").coalesce(1)
    got = {r["n"]: r["decoded"] for r in corpus.decode(arrays, vocab).collect()}
    assert got == {0: "aé", 1: None, 2: "", 3: "", 4: "bb"}
    assert corpus.decode(arrays, vocab.limit(0)).filter("decoded <> ''").count() == 0
    assert corpus.encode(lines, vocab.limit(0)).filter("exists(encoded, i -> i <> 0)").count() == 0
