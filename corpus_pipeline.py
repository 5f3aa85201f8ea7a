"""The training-data pipeline: five stages, each written and read again.

documents -> language -> near duplicates -> benchmark decontamination -> mix -> shards
"""

from gridledger.llm import common, decontamination, language, mixing, near_join, sharding
from gridledger.sources.tables import materialize


def language_id(spark, docs, sf_dir):
    """Documents whose language is told clearly, by labels of the given rows."""
    return language.accepted(docs, language.train(docs))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return near_join.one_per_group(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents without a window of any benchmark item."""
    return decontamination.clean_documents(docs, common.read(spark, sf_dir, "benchmark"))


def source_mix(spark, docs, sf_dir):
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def shards(spark, docs, sf_dir):
    """The documents with their shard and their place in it."""
    return sharding.sharded(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: Compression by zstandard and component search have no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
