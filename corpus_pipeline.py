"""From raw documents to token shards: language, near duplicates, benchmark leaks, mix, token ids.

Each stage takes the documents its predecessor kept and returns documents with all columns; the
last returns one row per document of the token files.  Rows are written between stages.  A stage
begins by deleting what the stage before it landed, whose result is stored by then, and nothing else.

Nulls: a null text has no language and goes; a null source is a source; rows without a doc_id, and
rows of one doc_id, are documents like others.  Ties stay apart by doc_id and text.  Empty tables
give empty results, further columns are handed on, texts of any length are taken whole.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilframe.llm import decontam, langid, mixing, neardup, tokens
from vigilframe.llm.queries import encoder
from vigilframe.llm.ship import ship
from vigilframe.operators.lineage import release, scratch_paths, shared_folder


# What the last stage landed, by application.
_last: dict[str, list[str]] = {}


def _stage(function: Callable) -> Callable:
    @functools.wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        release(spark, _last.pop(app, []))
        ship(spark)
        before = set(scratch_paths(spark))
        try:
            return function(spark, docs, sf_dir)
        finally:
            _last[app] = [p for p in scratch_paths(spark) if p not in before]

    return stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language; those without a letter, or of an unsure one, go."""
    return langid.accepted(docs, langid.train(docs, F.lit(True)))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the least doc_id."""
    return neardup.deduplicated(docs)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


@_stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in order of doc_id, read back: doc_id, start, n_tokens, ids_crc32."""
    path, manifest = tokens.write_tokens(docs, encoder())
    return tokens.read_tokens(path, manifest)


STAGES = [
    ("language ID", language),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token ids", token_ids),
]

#: Hash signatures, a trained model and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}")
    return docs
