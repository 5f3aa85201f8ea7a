"""Each corpus operator against a plain version, and on odd input."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from corpus_fixtures import CLASHING, DOC_SCHEMA, odd_documents, sentence, with_clashes, words
from pyspark.sql import functions as F

from gridledger.llm import (
    common,
    decontamination,
    imatch,
    language,
    mixing,
    near_join,
    sharding,
    token_rollup,
)

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def odd(spark):
    return with_clashes(spark.createDataFrame(odd_documents(), DOC_SCHEMA)).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def size_of(text):
    return len((text or "").encode()) + 8


# --- helpers ----------------------------------------------------------------


@pytest.mark.parametrize("hot", [False, True])
def test_total_order_is_a_sort(spark, hot):
    rng = random.Random(4)
    values = [(7 if hot and k % 3 else rng.randint(-50, 50), k, rng.randint(1, 9)) for k in range(900)]
    df = spark.createDataFrame(values, "key bigint, id bigint, weight bigint")
    df = df.withColumn("tie", F.xxhash64("id"))
    placed = common.total_order(df, "key", "tie", ("id",), weight="weight", rows_per_range=20)
    rows = placed.select("key", "tie", "id", "weight", "_place", "_before", "_range").collect()
    assert len(rows) == 900
    expected = sorted(rows, key=lambda r: (r[0], r[1], r[2]))
    before = 0
    for place, row in enumerate(expected):
        assert (row["_place"], row["_before"]) == (place, before)
        before += row["weight"]
    largest = max(collections.Counter(r["_range"] for r in rows).values())
    assert largest < 300  # a key with two thirds of the rows is subdivided


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)]
    edges += [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2000 + k) for k in range(80)] + [(3, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = common.components(spark.createDataFrame(edges, "a bigint, b bigint"), "test").collect()
    assert {r["node"]: r["root"] for r in got} == {x: find(x) for x in parent if find(x) != x}
    assert common.components(spark.createDataFrame([], "a bigint, b bigint"), "test").count() == 0


def test_blocked_meets_every_pair_once(spark):
    rows = [("big", k) for k in range(50)] + [("small", 100), ("small", 101)]
    members = spark.createDataFrame(rows, "g string, id bigint")
    units = collections.defaultdict(list)
    for r in common.blocked(members, "g", "id", 8).collect():
        units[r["_unit"]].append((r["g"], r["id"], r["_left"], r["_right"]))
    met = collections.Counter()
    for unit in units.values():
        assert len({u[0] for u in unit}) == 1
        inside = all(u[2] and u[3] for u in unit)
        for a in unit:
            for b in unit:
                if a[1] < b[1] and (inside or (a[2] and b[3]) or (b[2] and a[3])):
                    met[a[1], b[1]] += 1
    assert set(met.values()) == {1}
    assert len(met) == 50 * 49 // 2 + 1


# --- sharding ---------------------------------------------------------------


def check_shards(rows, texts, shards):
    got = collections.defaultdict(list)
    for r in rows:
        got[r["shard"]].append(r)
    for inside in got.values():
        assert sorted(r["slot"] for r in inside) == list(range(len(inside)))
    total = sum(r["size"] for r in rows)
    largest = max(r["size"] for r in rows)
    groups = collections.Counter()
    for r in rows:
        groups[r["text_crc32"]] += r["size"]
    unit = max([largest, *(g for g in groups.values() if g <= 0.01 * total / shards)])
    for shard in range(shards):
        assert abs(sum(r["size"] for r in got[shard]) - total / shards) <= 2 * unit
    assert collections.Counter((r["doc_id"], r["size"]) for r in rows) == collections.Counter(
        (i, size_of(t)) for i, t in texts
    )


def test_sharding(spark, odd):
    rows = sharding.place(odd, 6).collect()
    documents = [(r[0], r[1]) for r in odd_documents()]
    check_shards(rows, documents, 6)
    crcs = collections.Counter(zlib.crc32((t or "").encode()) for _, t in documents)
    assert collections.Counter(r["text_crc32"] for r in rows) == crcs


def test_sharding_with_a_hot_text(spark):
    rng = random.Random(1)
    texts = [(k, "the same text " * 9 if k % 3 == 0 else sentence(rng, 30)) for k in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = sharding.place(docs, 24).collect()
    check_shards(rows, texts, 24)
    sizes = collections.Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) / min(sizes.values()) < 1.1


def test_sharded_keeps_rows(spark, odd, empty):
    out = sharding.sharded(odd, 6)
    assert out.columns[:-2] == odd.columns
    given = collections.Counter(tuple(r[:5]) for r in odd.collect())
    assert collections.Counter(tuple(r[:5]) for r in out.collect()) == given
    assert sharding.place(empty).count() == 0
    assert sharding.sharded(empty).columns == [*DOC_COLUMNS, "shard", "slot"]


# --- mixing -----------------------------------------------------------------


def plain_mix(documents):
    """Sizes, source totals and targets, straight from the definition."""
    sized = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in documents]
    totals = collections.Counter()
    for _, n, s in sized:
        totals[s] += n
    order = sorted(totals, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    budget, target, open_ = 1.5 * sum(totals.values()), {}, set(order)
    while open_:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * totals[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * totals[s] for s in over}
        open_ -= over
    return sized, totals, target


def test_mixing(spark, odd):
    documents = [(r[0], r[1], r[3]) for r in odd_documents()]
    sized, totals, target = plain_mix(documents)
    rows = mixing.mix(odd).collect()
    assert collections.Counter((r["doc_id"], r["size"]) for r in rows) == collections.Counter(
        (i, n) for i, n, _ in sized
    )
    by_target = {round(t, 6) for t in target.values()}
    assert {round(r["target"], 6) for r in rows} == by_target
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rows)
    taken = sum(r["taken"] for r in rows)
    assert taken <= 1.5 * sum(totals.values())
    largest = max(n for _, n, _ in sized)
    per_source = collections.Counter()
    for r in rows:
        per_source[(r["source_size"], r["target"])] += r["taken"]
    for (_, goal), got in per_source.items():
        assert abs(goal - got) <= 2 * largest
    again = mixing.mix(odd.repartition(3)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr)


def test_mixed_rows(spark, odd, empty):
    plan = mixing.mix(odd)
    times = collections.Counter()
    for r in plan.collect():
        times[r["doc_id"], r["size"]] += r["times"]
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    got = collections.Counter((r["doc_id"], len((r["text"] or "").split())) for r in out.collect())
    assert got == +times
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed(empty).columns == DOC_COLUMNS


def test_mixing_with_many_buckets(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(k, sentence(rng, rng.randint(1, 30)), "hot" if k % 2 else f"s{k % 5}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    whole = sorted(tuple(r) for r in mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 7)
    monkeypatch.setattr(common, "ROWS_PER_RANGE", 20)
    assert sorted(tuple(r) for r in mixing.mix(docs).collect()) == whole


# --- near duplicates --------------------------------------------------------


def shingle_set(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_links(documents, threshold=0.8):
    """Pairs of row numbers that are linked: similar word sets, or equal texts."""
    sets = [shingle_set(t) for _, t in documents]
    where = collections.defaultdict(list)
    pairs = set()
    for a, s in enumerate(sets):
        shared = collections.Counter(b for x in s for b in where[x])
        for b, n in shared.items():
            if n / (len(s) + len(sets[b]) - n) >= threshold:
                pairs.add((b, a))
        for x in s:
            where[x].append(a)
    texts = collections.defaultdict(list)
    for k, (_, t) in enumerate(documents):
        if t is not None:
            texts[t].append(k)
    for same in texts.values():
        pairs |= {(a, b) for a in same for b in same if a < b}
    return pairs


def near_documents():
    rng = random.Random(8)
    rows = [(i, t) for i, t, *_ in odd_documents()]
    base = sentence(rng, 150).split()
    passage = sentence(rng, 60)
    for k in range(60):  # a large group around the threshold
        edited = list(base)
        for _ in range(rng.randint(0, 4)):
            edited[rng.randrange(len(edited))] = sentence(rng, 1)
        rows.append((1000 + k, " ".join(edited)))
    for k in range(40):  # a passage that many share
        rows.append((2000 + k, f"{passage} {sentence(rng, rng.randint(20, 90))}"))
    return rows


@pytest.mark.parametrize("block", [None, 8])
def test_near_duplicates(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(near_join, "BLOCK", block)
        monkeypatch.setattr(near_join, "NODE_BLOCK", 2 * block)
    documents = near_documents()
    pairs = plain_links(documents)
    degree, parent = collections.Counter(), list(range(len(documents)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(documents):
        if i is not None:
            root = find(k)
            least[root] = min(i, least.get(root, i))
    expected = collections.Counter(
        (i, least.get(find(k)), degree[k]) for k, (i, _) in enumerate(documents)
    )
    docs = with_clashes(spark.createDataFrame(documents, "doc_id bigint, text string"))
    got = near_join.classes(docs.repartition(4)).collect()
    assert collections.Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == expected

    kept = near_join.one_per_group(docs)
    assert kept.columns == docs.columns
    stays = collections.Counter()
    for k, (i, t) in enumerate(documents):
        if t is None:
            stays[i, t] += 1
    groups = collections.defaultdict(list)
    for k, (i, t) in enumerate(documents):
        if t is not None:
            groups[find(k)].append((i is None, i, t))
    kept_rows = collections.Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert sum(kept_rows.values()) == len(groups) + sum(stays.values())
    for members in groups.values():
        inside = [r for r in {(m[1], m[2]) for m in members} if kept_rows[r]]
        assert len(inside) == 1
        assert inside[0][0] == min(members, key=lambda m: (m[0], m[1] or 0))[1]


def test_near_duplicates_of_nothing(spark, empty):
    assert near_join.classes(empty).count() == 0
    assert near_join.one_per_group(empty).columns == DOC_COLUMNS
    nulls = spark.createDataFrame([(1, None), (2, None), (3, "...")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_join.classes(nulls).collect()}
    assert got == {1: (1, 0), 2: (2, 0), 3: (3, 0)}


def test_shingle_sets_are_exact():
    texts = [t or "" for _, t, *_ in odd_documents()]
    sets = near_join.shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
    known = {}
    for text, hashes in zip(texts, sets, strict=True):
        assert known.setdefault(frozenset(shingle_set(text)), tuple(hashes)) == tuple(hashes)
    assert near_join.levels() == [8, 7, 6, 5]
    assert near_join.recall(5) >= near_join.TARGET_RECALL > near_join.recall(6)


# --- decontamination --------------------------------------------------------


def plain_hits(text, items):
    w, hit, found = words(text), set(), set()
    for item, item_text in items:
        v = words(item_text)
        for k in range(max(1, len(v) - 9) if v else 0):
            window = v[k : k + 10]
            for at in range(len(w) - len(window) + 1):
                if w[at : at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    found.add(str(item))
    return len(w), hit, sorted(found)


@pytest.fixture(scope="module")
def contaminated():
    rng = random.Random(9)
    items = [(k, sentence(rng, rng.choice((1, 4, 9, 10, 11, 30)))) for k in range(12)]
    items += [(12, None), (13, ""), (14, items[5][1]), (14, items[5][1]), (-3, "tiny item")]
    rows = [(i, t) for i, t, *_ in odd_documents() if t is None or len(t) < 9000]
    for k in range(30):
        item = rng.choice(items[:12])[1].split()
        cut = item[rng.randint(0, 2) :]
        middle = " ".join(cut).upper() if k % 3 else ";\n".join(cut)
        rows.append((100 + k, f"{sentence(rng, 15)} {middle}, {sentence(rng, 8)} {middle} Tiny ITEM!"))
    return rows, items


def test_decontamination(spark, contaminated):
    rows, items = contaminated
    docs = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string")).repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    expected = []
    for i, text in rows:
        n, hit, found = plain_hits(text, items)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        expected.append((i, n, len(hit), len(found), digest, bool(hit)))
    got = [tuple(r) for r in decontamination.report(docs, bench).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)

    clean = decontamination.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(repr(r["doc_id"]) for r in clean.collect()) == sorted(
        repr(e[0]) for e in expected if not e[5]
    )


def test_removed_spans(spark, contaminated):
    rows, items = contaminated
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = collections.Counter(
        (r["doc_id"], None if r["text"] is None else tuple(words(r["text"])))
        for r in decontamination.without_spans(docs, bench).collect()
    )
    expected = collections.Counter()
    for i, text in rows:
        _, hit, _ = plain_hits(text, items)
        rest = tuple(w for k, w in enumerate(words(text)) if k not in hit)
        expected[i, None if text is None else rest] += 1
    assert got == expected


def test_decontamination_of_nothing(spark, empty):
    bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    none = bench.filter("false")
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id bigint, text string")
    assert decontamination.report(empty, bench).count() == 0
    assert {tuple(r)[:4] for r in decontamination.report(docs, none).collect()} == {
        (1, 3, 0, 0), (2, 0, 0, 0)
    }
    assert decontamination.clean_documents(docs, none).count() == 2


# --- fingerprints -----------------------------------------------------------


def test_fingerprints(spark, odd):
    rows = imatch.compare_edited(odd).collect()
    documents = [(i, t or "") for i, t, *_ in odd_documents()]
    assert collections.Counter((r["doc_id"], r["n_chars"]) for r in rows) == collections.Counter(
        (i, len(t)) for i, t in documents
    )
    by_text = collections.defaultdict(set)
    texts = {(i, len(t)): t for i, t in documents}
    for r in rows:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text[texts[r["doc_id"], r["n_chars"]]].add(r["fingerprint"])
    assert all(len(prints) == 1 for prints in by_text.values())
    # Unique ids: the next document is known, so the edited text is.
    single = collections.Counter(i for i, _ in documents)
    order = sorted((d for d in documents if d[0] is not None), key=lambda d: -d[0])
    following = dict(zip([d[0] for d in order], order[1:], strict=False))
    checked = 0
    for r in rows:
        after = following.get(r["doc_id"])
        if r["doc_id"] is None or not after or single[r["doc_id"]] > 1 or single[after[0]] > 1:
            continue
        text = texts[r["doc_id"], r["n_chars"]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[1][:cut]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        checked += 1
    assert checked > 50


def test_fingerprints_of_corpus(spark):
    rows = imatch.compare_edited(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    nearer = sum(r["near_edited"] > r["near_next"] for r in rows)
    assert nearer / len(rows) > 0.9
    one = [r for r in rows if r["fingerprint"].startswith("=")]
    assert len(one) < 0.1 * len(rows)


def test_fingerprints_of_nothing(spark, empty):
    assert imatch.compare_edited(empty).count() == 0
    lone = spark.createDataFrame([(1, "abcdef")], "doc_id bigint, text string")
    row = imatch.compare_edited(lone).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
    assert row["near_next"] == 1.0


# --- language ---------------------------------------------------------------


def test_language(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    dictionaries = language.train(docs)
    assert set(dictionaries) == {"de", "en", "es", "fr"}
    assert all(len(d) <= language.DICTIONARY_BYTES for d in dictionaries.values())
    rows = docs.join(language.predict(docs, dictionaries), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98
    assert language.accepted(docs, dictionaries).count() >= 0.99 * len(rows)

    got = language.predict(odd, dictionaries)
    assert got.count() == len(odd_documents())
    for r in got.filter("lang_pred = 'und'").collect():
        assert r["score"] == 0
        assert r["doc_id"] in {45, 46, 47, 48, 49, None}
    assert language.accepted(odd, dictionaries).columns == odd.columns


def test_language_learns_from_labels_outside_fold_only(spark):
    rows = [(k, "alpha beta " * 9, "xx" if zlib.crc32(str(k).encode()) % 5 else "held", "s", 1) for k in range(40)]
    rows += [(None, "text", "none", "s", 1), (99991, None, "null", "s", 1)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    dictionaries = language.train(docs)
    assert set(dictionaries) == {"xx"}
    assert {r["lang_pred"] for r in language.predict(docs, dictionaries).collect()} == {"xx", "und"}


def test_language_sample_of_repeated_rows(spark, monkeypatch):
    learned = []
    words = language._words
    monkeypatch.setattr(language, "_words", lambda text: learned.append(text) or words(text))
    rows = [(k, f"alpha{'abcdefghij'[k % 10]} beta {k} " * 3, "xx", "s", 1) for k in range(200)]
    for repeated in (rows[1], rows[2], rows[3]):  # whichever of them is held out, others are not
        learned.clear()
        docs = spark.createDataFrame(rows + [repeated] * 3000, DOC_SCHEMA)
        language.train(docs, sample_docs=20)
        assert len(learned) == len(set(learned)) == 20
    one = spark.createDataFrame([(k, f"text {k}", "xx", "s", 1) for k in (1, 2, 3)] * 500, DOC_SCHEMA)
    learned.clear()
    language.train(one)
    assert 1 <= len(learned) <= 3 and len(set(learned)) == len(learned)


def test_language_of_nothing(spark, empty):
    assert language.train(empty) == {}
    assert language.predict(empty, {}).count() == 0
    docs = spark.createDataFrame([(1, "some text")], "doc_id bigint, text string")
    assert language.predict(docs, {}).first()["lang_pred"] == "und"


# --- token rollups ----------------------------------------------------------


def test_token_counts(spark, odd):
    count = token_rollup.byte_bpe()
    got = collections.Counter(
        (r["doc_id"], r["words_1"], r["byte_bpe_50k"]) for r in token_rollup.counts(odd).collect()
    )
    assert got == collections.Counter(
        (i, len((t or "").split()), count(t or "")) for i, t, *_ in odd_documents()
    )


def test_token_counts_do_not_depend_on_the_cut(monkeypatch):
    rng = random.Random(2)
    count = token_rollup.byte_bpe()
    texts = [sentence(rng, 300), "a  b\n\n c" * 90, "it's 12 34,, é é" * 50, "x" * 3000, " " * 500]
    whole = [count(t) for t in texts]
    monkeypatch.setattr(token_rollup, "PIECE_CHARS", 40)
    assert [count(t) for t in texts] == whole


def test_rollup_of_changes(spark, tmp_path):
    rng = random.Random(3)
    snapshots = [
        {k: (rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.randint(0, 9)) for k in range(80)}
    ]
    for _ in range(3):
        after = dict(snapshots[-1])
        for k in list(after):
            roll = rng.random()
            if roll < 0.2:
                del after[k]
            elif roll < 0.5:
                after[k] = (after[k][0], after[k][1], rng.randint(0, 9))
            elif roll < 0.6:
                after[k] = ("c", after[k][1], after[k][2])
        after[100 + len(snapshots)] = ("new", "en", 5)
        snapshots.append(after)
    schema = "doc_id bigint, source string, lang string, tokens bigint"
    frames = [spark.createDataFrame([(k, *v) for k, v in s.items()], schema) for s in snapshots]
    root = str(tmp_path / "rollup")
    before = frames[0].filter("false")
    for number, frame in enumerate(frames):
        rows = token_rollup.changes(before, frame, "v1")
        token_rollup.commit(root, f"batch-{number}", rows)
        token_rollup.commit(root, f"batch-{number}", rows)  # once more, as after a failure
        expected = collections.defaultdict(lambda: [0, 0])
        for source, lang, tokens in snapshots[number].values():
            expected[source, lang, "v1"][0] += 1
            expected[source, lang, "v1"][1] += tokens
        got = {tuple(r)[:3]: list(r)[3:] for r in token_rollup.totals(spark, root).collect()}
        assert got == dict(expected)
        before = frame


def test_folds_and_late_attempts_change_no_totals(spark, tmp_path):
    root = str(tmp_path / "rollup")
    schema = "source string, lang string, tokenizer string, documents bigint, tokens bigint"

    def rows(*lines):
        return spark.createDataFrame(list(lines), schema)

    def shown():
        return sorted((tuple(r) for r in token_rollup.totals(spark, root).collect()), key=repr)

    token_rollup.commit(root, "a", rows(("s", "en", "v", 2, 10), ("t", None, "v", 1, 4)))
    token_rollup.commit(root, "b", rows(("s", "en", "v", -1, -3), (None, "en", "v", 1, 1)))
    token_rollup.commit(root, "a", rows(("s", "en", "v", 9, 90)))  # a second attempt, other rows
    expected = sorted([("s", "en", "v", 1, 7), ("t", None, "v", 1, 4), (None, "en", "v", 1, 1)], key=repr)
    assert shown() == expected
    token_rollup.fold(spark, root)
    assert shown() == expected
    token_rollup.commit(root, "b", rows(("s", "en", "v", 5, 5)))  # already in the base
    assert shown() == expected
    token_rollup.commit(root, "c", rows(("t", None, "v", -1, -4)))
    expected.remove(("t", None, "v", 1, 4))
    assert shown() == expected
    # Two folds at once: one saw batch d, the other did not and is announced last.
    commits = spark.read.schema(token_rollup._COMMITS).parquet(f"{root}/commits")
    early = token_rollup._standing(commits).collect()
    token_rollup.commit(root, "d", rows(("u", "fr", "v", 1, 2)))
    token_rollup.fold(spark, root)
    late = spark.createDataFrame(early, "batch string, attempt string")
    sums = token_rollup._summed(token_rollup._read(spark, root, late))
    token_rollup._announce(root, late, token_rollup._write(root, sums), True)
    expected = sorted([*expected, ("u", "fr", "v", 1, 2)], key=repr)
    assert shown() == expected
    token_rollup.fold(spark, root)
    assert shown() == expected
    token_rollup.commit(root, "e", rows().limit(0))
    assert shown() == expected


def test_changes_of_repeated_and_missing_ids(spark):
    schema = "doc_id bigint, source string, lang string, tokens bigint"
    before = [(1, "a", "en", 5)] * 3 + [(None, "a", None, 2)] * 2 + [(2, "a", "en", 1)]
    after = [(1, "b", "en", 5)] * 2 + [(None, "a", None, 2)] * 2 + [(1, "a", "en", 5)]
    rows = token_rollup.changes(*(spark.createDataFrame(x, schema) for x in (before, after)), "v1").collect()
    assert sorted(tuple(r) for r in rows) == [
        ("a", "en", "v1", -2, -10), ("a", "en", "v1", -1, -1), ("b", "en", "v1", 2, 10),
    ]


def test_rollup_of_nothing(spark, empty, tmp_path):
    counted = token_rollup.counts(empty)
    root = str(tmp_path / "rollup")
    rows = token_rollup.signed(counted, F.col("estimate"), "v1", 1)
    token_rollup.commit(root, "none", rows)
    assert token_rollup.totals(spark, root).count() == 0


def test_clashing_columns_are_really_there(odd):
    assert set(CLASHING) <= set(odd.columns)


def test_shards_never_cut_a_group(spark, monkeypatch):
    import functools

    rng = random.Random(12)
    rows = []
    for group in range(1500):
        text = sentence(rng, rng.randint(0, 60)) + str(group)
        rows += [(text, "en", "s", 1)] * rng.choice([1, 1, 2, 3, 9])
    # Groups of a fortieth to half a shard, and one that is larger than a shard.
    for group, copies in enumerate((6, 15, 30, 60, 90)):
        rows += [(f"{group} " + "large text " * 30, "en", "s", 1)] * copies
    rows += [("hot " * 40, "en", "s", 1)] * 2_000
    rows = [(k, *row) for k, row in enumerate(rows)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(6)
    monkeypatch.setattr(common, "total_order", functools.partial(common.total_order, rows_per_range=2))
    placed = sharding.place(docs, 8).collect()
    assert sorted(r["doc_id"] for r in placed) == [r[0] for r in rows]
    sizes, shards, slots = collections.Counter(), collections.defaultdict(set), collections.defaultdict(list)
    text = {r[0]: r[1] for r in rows}
    for r in placed:
        sizes[r["shard"]] += r["size"]
        shards[text[r["doc_id"]]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    mean = sum(sizes.values()) / 8
    for key, where in shards.items():
        copies = sum(t == key for t in text.values())
        assert len(where) == 1 or copies * (len(key) + 8) > mean
    assert len(shards["hot " * 40]) > 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sizes) == set(range(8)) and all(abs(n - mean) < 0.04 * mean for n in sizes.values())


def test_number_signs_are_no_letters(spark):
    texts = ["\u00b2 \u00bd", "\u2460", "x\u00b2", "12 3", "the word"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, {"en": b"the word and more words of text", "fr": b"le mot et la phrase entiere"}).collect()}
    assert [got[k] for k in range(5)][:2] + [got[3]] == ["und"] * 3
    assert got[2] != "und" and got[4] == "en"
    assert language.accepted(docs.drop("text"), {"en": b"the word and more"}).count() == 0


def test_identity_of_rows_with_nested_maps(spark):
    rows = spark.sql(
        "SELECT map('a', 1) m, struct(map('b', 2) x) s, array(map('c', id % 2)) l, 1 i FROM range(4)"
    )
    assert rows.select(common.row_key(rows).alias("k")).distinct().count() == 2
    assert rows.limit(0).select(common.row_key(rows).alias("k")).schema["k"].dataType.simpleString() == "struct<a:bigint,b:bigint>"
