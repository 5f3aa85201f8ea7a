"""Registered corpus queries: SQL where there is some, and the pipeline."""

import collections
import os

import pytest
from oracle_compare import compare, duck
from test_corpus_operators import plain_hits, plain_links

import __spark_entry__ as entry
import corpus_pipeline
from gridledger.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_query_equals_sql(spark, key):
    for sf_dir in (SF_DIR, "/root/testdata/sf0.01"):
        assert compare(spark, duck(sf_dir), sf_dir, key, queries.QUERIES[key], queries.SQL[key]) is None


def test_all_are_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_op1_columns(spark):
    rows = queries.QUERIES["op1_sharding"](spark, SF_DIR)
    assert rows.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert rows.filter("law <> 'bytes' or grown_shard is not null").count() == 0
    assert rows.select("shard").distinct().count() <= 24


def test_op4_against_all_pairs(spark):
    documents = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    degree = collections.Counter()
    for a, b in plain_links(documents):
        degree[a] += 1
        degree[b] += 1
    rows = queries.QUERIES["op4_near_duplicates"](spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"]: r["n_links"] for r in rows} == {
        i: degree[k] for k, (i, _) in enumerate(documents)
    }


def test_op9_totals(spark):
    rows = queries.QUERIES["op9_token_rollup"](spark, SF_DIR).collect()
    expected = collections.defaultdict(lambda: [0, 0])
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        entry_ = expected[r["source"], r["lang"]]
        entry_[0] += 1
        entry_[1] += len(r["text"].split())
    words = {(r["source"], r["lang"]): [r["n_docs"], r["n_tokens"]] for r in rows if r["tokenizer"] == "words_1"}
    assert words == dict(expected)
    assert len(rows) == 2 * len(words)


def test_op9_deletes_and_moves(spark, monkeypatch):
    commit, net = queries.token_rollup.commit, {}

    def watched(root, batch, rows):
        net[batch] = {tuple(r)[:3]: r["n"] for r in rows.groupBy("source", "lang", "tokenizer").agg({"documents": "sum"}).toDF("source", "lang", "tokenizer", "n").collect()}
        commit(root, batch, rows)

    monkeypatch.setattr(queries.token_rollup, "commit", watched)
    queries.QUERIES["op9_token_rollup"](spark, SF_DIR)
    count = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert sum(net["load"].values()) == 2 * 2 * count
    assert sum(net["count"].values()) == -2 * count
    assert any(n > 0 for n in net["count"].values())
    assert any(source == lang for source, lang, _ in net["load"]) and any(lang is None for _, lang, _ in net["load"])


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "benchmark_decontamination", "source_mix", "shards"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF_DIR)
        assert after.columns[: len(columns)] == columns
        after = spark.createDataFrame(after.collect(), after.schema)
        old = [(r["doc_id"], r["text"]) for r in before.collect()]
        new = [(r["doc_id"], r["text"]) for r in after.collect()]
        if name == "language_id":
            assert len(new) >= 0.98 * len(old)
        elif name == "near_duplicates":
            pairs = plain_links(old)
            linked = {k for pair in pairs for k in pair}
            assert {d for k, d in enumerate(old) if k not in linked} <= set(new)
            place = {d: k for k, d in enumerate(old)}
            kept = {place[d] for d in new}
            assert not any(a in kept and b in kept for a, b in pairs)
        elif name == "benchmark_decontamination":
            assert set(new) == {d for d in old if not plain_hits(d[1], benchmark)[1]}
        elif name == "source_mix":
            assert set(collections.Counter(new).values()) <= {1, 2}
            total = sum(len(t.split()) for _, t in old)
            assert 1.4 * total < sum(len(t.split()) for _, t in new) <= 1.5 * total
        else:
            assert after.columns == [*columns, "shard", "slot"]
            assert sorted(new) == sorted(old)
        before = after


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns[-2:] == ["shard", "slot"]
