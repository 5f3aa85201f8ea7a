"""Periodic runs, line dedup and the prefix trie against plain Python versions."""

import collections
import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from corpus_fixtures import CLASHING, DOC_SCHEMA, odd_documents, with_clashes

from gridledger.llm import common, line_runs, periodic, prefix_trie, queries

# --- periodic runs ---------------------------------------------------------------


def plain_runs(ids):
    found = set()
    for q in range(1, len(ids) // 3 + 1):
        i = 0
        while i < len(ids) - q:
            j = i
            while j < len(ids) - q and ids[j] == ids[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                smaller = any(all(ids[x] == ids[x + r] for x in range(i, j + q - r)) for r in range(1, q))
                if not smaller:
                    found.add((i, j + q - i, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, words):
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {k for s, n, p in found for k in range(s + p, s + n)}
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_runs_of_random_sequences():
    rng = random.Random(2)
    for _ in range(600):
        ids = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            if ids:
                start, q = rng.randrange(len(ids)), rng.randint(1, 20)
                for k in range(start + q, min(len(ids), start + rng.randint(1, 90))):
                    ids[k] = ids[k - q]
        assert periodic.runs(ids) == plain_runs(ids)


def test_splitting_leaves_words_that_recur():
    rng = random.Random(4)
    for _ in range(200):
        ids = [rng.randrange(12) for _ in range(rng.randint(0, 80))]
        found = periodic.segments(ids, least=3, shortest=4)
        held = set()
        for low, high in found:
            assert min(collections.Counter(ids[low:high]).values()) >= 3 and high - low >= 4
            held |= set(range(low, high))
        # A split word is rare between its neighbouring splits, whatever the order.
        rest = sorted(set(range(len(ids))) - held)
        assert all(periodic.segments(ids[a:b], 3, 4) == [] for a, b in zip(rest, rest[1:], strict=False) if b == a + 1)


@pytest.mark.parametrize("kind", ["one word", "peeled", "few words"])
def test_long_texts_take_linear_time(kind):
    rng = random.Random(1)
    ids = {
        "one word": [0] * 400_000,
        "peeled": [x for k in range(130_000) for x in (k, k + 1, k)],
        "few words": [rng.randrange(300) for _ in range(400_000)],
    }[kind]
    start = time.time()
    assert len(periodic.runs(ids)) == (kind == "one word")
    assert time.time() - start < 20


def periodic_documents():
    rng = random.Random(6)
    rows = odd_documents()
    for k in range(40):
        words = [rng.choice("abcdefghij") * 2 for _ in range(rng.randint(0, 90))]
        rows.append((1000 + k, " \t".join(words) + "\n", "en", "s1", 1))
    rows.append((2000, "same words over and " * 3_000, "en", "s1", 1))
    rows.append((2001, "a b c \u0085 " * 30, "en", "s1", 1))
    return rows


def test_op11_against_brute_force(spark, tmp_path):
    rows = periodic_documents()
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    expected = collections.Counter()
    for doc_id, text, *_ in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n < 3_000:
            expected[plain_row(doc_id, words)] += 1
    short = {r["doc_id"] for r in got} - {50, 51, 2000}
    assert collections.Counter(tuple(r) for r in got if r["doc_id"] in short) == expected
    (long,) = [r for r in got if r["doc_id"] == 2000]
    assert long["n_runs"] >= 1 and long["length"] > 3_000


def test_detect_keeps_columns_and_takes_empty_tables(spark):
    docs = with_clashes(spark.createDataFrame(odd_documents(), DOC_SCHEMA)).withColumn("runs", docs_lit())
    out = periodic.detect(docs)
    assert out.columns == [*docs.columns, "_runs", "collapsed"]
    assert out.count() == len(odd_documents())
    assert periodic.detect(docs.limit(0)).count() == 0
    assert periodic.detect(docs.drop("text")).select("collapsed").distinct().collect() == [("",)]


def docs_lit():
    from pyspark.sql import functions as F

    return F.lit("own")


# --- line dedup --------------------------------------------------------------------

STRIP = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_lines(rows, least_docs=3):
    """doc_id, lines before and dropped, kept text of each (doc_id, text)."""
    held = collections.defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(STRIP).translate(UPPER)
            if len(key) >= 20:
                held[key].add(doc_id)
    order = lambda i: (i is not None, i or 0)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = held.get(line.strip(STRIP).translate(UPPER), ())
            if len(ids) < least_docs or doc_id == max(ids, key=order):
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_documents(seed=5, count=120):
    rng = random.Random(seed)
    lines = [f"line number {k} with enough of text" for k in range(25)]
    shown = [
        lambda x: x, lambda x: f"  {x}\t", str.upper, lambda x: x + "\r", lambda x: x[:15], lambda x: "É " + x,
    ]
    rows = []
    for k in range(count):
        some = [rng.choice(shown)(rng.choice(lines)) for _ in range(rng.randint(0, 9))]
        some += ["the very common line of all documents"] * rng.randint(0, 3)
        some += [""] * rng.randint(0, 2)
        rng.shuffle(some)
        rows.append((k * 7 - 300, "\n".join(some), "en", "s", 1))
    rows += [(None, "\n".join(lines[:5]), "en", "s", 1), (None, "\n".join(lines[:3]), "en", "s", 1)]
    rows += [(10_000, "\n".join(lines[:4]), "en", "s", 1)] * 2
    rows += [(10_000, lines[0] + "\n" + lines[0] + "\nown line of this row, long enough", "en", "s", 1)]
    return rows + odd_documents()


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_marked_lines(spark, monkeypatch, batches):
    monkeypatch.setattr(common, "HOT_SHARE", 20)
    rows = line_documents()
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA)).repartition(5)
    out = line_runs.marked(docs, batches=batches)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped", "kept"]
    got = collections.Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in out.collect())
    expected = collections.Counter(plain_lines([(r[0], r[1]) for r in rows]))
    assert got == expected
    assert sum(n for _, _, n, _ in expected) > 100


def test_marked_lines_shuffled(spark, monkeypatch):
    monkeypatch.setattr(line_runs, "BROADCAST_BYTES", 0)
    rows = line_documents(seed=8)
    out = line_runs.marked(spark.createDataFrame(rows, DOC_SCHEMA), least_docs=2)
    got = collections.Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in out.collect())
    assert got == collections.Counter(plain_lines([(r[0], r[1]) for r in rows], 2))


def test_deduped_keeps_columns_and_empty_tables(spark):
    docs = with_clashes(spark.createDataFrame(line_documents(), DOC_SCHEMA))
    out = line_runs.deduped(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.filter("text is null").count() == docs.filter("text is null").count()
    assert line_runs.marked(docs.limit(0)).count() == 0
    assert {tuple(r) for r in line_runs.marked(docs.drop("text", "doc_id")).select("n_lines", "n_dropped", "kept").collect()} == {(1, 0, "")}
    assert set(CLASHING) <= set(out.columns)


def test_runs_are_levelled_joined_without_shuffle_and_go_on_after_a_failure(spark, tmp_path):
    docs = spark.createDataFrame(line_documents(), DOC_SCHEMA)
    lines = line_runs.hashed_lines(docs)
    conditions = line_runs._descending(lines, 4)
    parts = [lines.filter(c) for c in conditions]
    assert sum(p.count() for p in parts) == lines.count()
    index = line_runs.LineRuns(spark, f"{tmp_path}/runs", buckets=3)
    for number in range(3):
        assert index.add(f"b{number}", parts[number])
    assert sorted(level for level, _ in index.runs) == [0, 1]
    _, seen = index._written(index.tables()[0].selectExpr("h1", "h2", "keeper", "1L n_docs", "n_lines"), "t", line_runs.SIGHTINGS)
    plan = seen.join(index.tables()[1].hint("merge"), line_runs.HASH, "left_anti")
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    # A repeated batch changes nothing, and a new session finds the runs again.
    index.close()
    again = line_runs.LineRuns(spark, f"{tmp_path}/runs")
    assert not again.add("b1", parts[1]) and again.add("b3", parts[3])
    assert [level for level, _ in again.runs] == [2]
    keys = again.tables()[0]
    assert keys.count() == lines.select("h1", "h2").distinct().count() == keys.select("h1", "h2").distinct().count()
    once = line_runs.LineRuns(spark, f"{tmp_path}/once", buckets=3)
    once.add("all", lines)
    assert sorted(map(tuple, again.frequent().collect()), key=repr) == sorted(map(tuple, once.frequent().collect()), key=repr)
    again.close()
    once.close()


# --- prefix trie --------------------------------------------------------------------


def plain_trie(conversations):
    """Rows by (conv_id, depth) of lists of (role, text) by conversation id."""
    members = collections.defaultdict(list)
    for conv, turns in sorted(conversations.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = collections.Counter(path[:-1] for path in members if path)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, convs in members.items():
        own = (len(convs) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += own
            leaves[path[:d]] += children[path] == 0
    rows = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(conversations[c]) == len(path))
        rows.append((
            convs[0], len(path), members[path[:-1]][0] if path else None, len(convs), children[path],
            leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def plain_rebuilt(conversations):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 6
        # The remainder has the sign of the number, as in SQL.
        head = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        out[c] = conversations.get(head, [])[:h] + turns[h:]
    return out


TURNS = "conv_id bigint, turn bigint, role string, text string"


def turn_rows(seed=3, convs=260):
    rng = random.Random(seed)
    said = ["hello", "how are you", "", "tell me more \U0001f600", "bye", None]
    rows = []
    for c in range(-30, convs):
        if c % 11 == 5:
            continue
        for t in range(rng.choice([0, 1, 2, 3, 6, 9]) if c % 100 else 4):
            rows.append((c, t if t or c % 3 else None, rng.choice(["user", None, "bot"]), rng.choice(said)))
    return rows


def grouped(rows):
    found = collections.defaultdict(list)
    for c, t, role, text in rows:
        found[c].append((t, role or "", text or ""))
    return {c: [(r, x) for _, r, x in sorted(v, key=lambda k: (k[0] is not None, k[0] or 0))] for c, v in found.items()}


def test_op13_against_brute_force(spark, tmp_path, monkeypatch):
    rows = turn_rows()
    for number, (shard, band, pieces) in enumerate([(40, 2, 20), (10**6, 512, 10**6)]):
        monkeypatch.setattr(prefix_trie, "SHARD_ENTRIES", shard)
        monkeypatch.setattr(prefix_trie, "BAND", band)
        monkeypatch.setattr(prefix_trie, "LIST_BYTES", pieces)
        monkeypatch.setattr(common, "HOT_SHARE", 3 if number == 0 else 2_000)
        folder = f"{tmp_path}/{number}"
        spark.createDataFrame(rows, TURNS).write.parquet(f"{folder}/conversations.parquet")
        got = queries.QUERIES["op13_prefix_trie"](spark, folder).collect()
        assert sorted(map(tuple, got), key=repr) == plain_trie(plain_rebuilt(grouped(rows)))


def test_trie_of_a_conversation_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BAND", 16)
    monkeypatch.setattr(prefix_trie, "SHARD_ENTRIES", 50)
    rng = random.Random(9)
    long = [(7, t, "user", f"turn {t}") for t in range(900)]
    twin = [(3, t, "user", f"turn {t}" if t < 700 else f"other {t}") for t in range(800)]
    rows = long + twin + [(c, t, "user", f"turn {t}") for c in range(20, 60) for t in range(rng.randint(1, 4))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, TURNS).repartition(6)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        ranges = prefix_trie.numbered(prefix_trie.digested(docs)).filter("conv_id = 7").select("_range")
        assert ranges.distinct().count() > 1
        got = prefix_trie.trie(docs).collect()
    finally:
        spark.conf.unset(coalesce)
    assert sorted(map(tuple, got), key=repr) == plain_trie(grouped(rows))


def test_trie_of_odd_tables(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.trie(empty).count() == 0
    assert queries.prefix_trie.nodes(prefix_trie.digested(empty), spark.range(3).toDF("conv_id")).collect() == [
        (0, 0, None, 3, 0, 1, 0, hashlib.sha256(b"0,1,2").hexdigest())
    ]
    rows = [(None, 1, "user", "nobody's"), (4, 1, None, None), (4, 1, None, None), (5, 1, "", ""), (5, None, "", "x")]
    docs = with_clashes(spark.createDataFrame(rows, TURNS))
    got = sorted(map(tuple, prefix_trie.trie(docs).collect()), key=repr)
    assert got == plain_trie({4: [("", ""), ("", "")], 5: [("", "x"), ("", "")]})


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    one, two = (rng.integers(0, 2**63, 50_000, dtype=np.uint64) for _ in range(2))
    slots = prefix_trie.Slots(one, two)
    assert sorted(slots.of(one, two)) == list(range(len(one)))
    with pytest.raises(ValueError):
        slots.of(one + np.uint64(1), two)
    assert len(prefix_trie.Slots(one[:0], two[:0]).of(one[:0], two[:0])) == 0
