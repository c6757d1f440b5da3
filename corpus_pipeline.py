"""The training-data pipeline over ``documents``: five stages, each stored and read again.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``.  All but the last
return the columns of ``documents``.  A stage begins by deleting the working
tables of earlier ones, whose results have been written by then.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm import decontaminate, language, mixing, ngram_join, sharding
from tabprep.llm.common import drop_stored, release, small_batches, store, stored_paths, table

#: Dimensions of the language profiles, and the least cosine to the nearest language: 3.4 times the
#: noise (1 / sqrt(DIMS)) of a text in a script that no language has.  Letterless texts go as well.
DIMS, MIN_COSINE = 2048, 0.075

#: Working tables of the stages that have run; their results are written before the next stage begins.
_WORK: list[str] = []


def _stage(fn):
    """A stage first deletes the working tables of the ones before it, but for what its input reads."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        release(spark, _WORK, docs)
        before = set(stored_paths(spark))
        out = fn(spark, docs, sf_dir)
        _WORK[:] = [p for p in stored_paths(spark) if p in _WORK or p not in before]
        return out

    return run_stage


@_stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages stay."""
    rows = language.identified(docs, DIMS).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_COSINE))
    return rows.select(*docs.columns)


@_stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of linked documents stays."""
    return ngram_join.one_of_each(docs).select(*docs.columns)


@_stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in benchmark windows go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per draw of a document: none, one or two."""
    return mixing.mixed_rows(docs).select(*docs.columns)


@_stage
def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes: the documents' columns, size, text_crc32, shard and slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
    ("sharding", sharded),
]

#: Language prototypes, block draws and shard cuts have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        last, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store(docs, f"stage-{i + 1}")
            if i:
                drop_stored(last)
    return docs
