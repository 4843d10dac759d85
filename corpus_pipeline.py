"""A training-data pipeline over ``documents``: each stage's result is written and read again as the next one's documents.

A stage's result has to be written before the next stage is called: the tables that it rests on go then, so that a run needs no more room than its largest stage.

Rows count as documents of their own in every stage, whatever their doc_id, which may be null or repeated: stages that choose rows number them in a stage table first. Columns other than those of ``documents`` are left out. A table without rows passes as one.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm import exact_dedup, language_id, mixing, near_dedup, packing
from lotline.llm.common import drop_table, materialize, read, stage_tables, stage_tables_since
from lotline.session import prepare, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The mix takes this share of the tokens that reach it, each document once at most, by these weights among siblings of the tree (domain, language, source); those not named weigh 1.
MIX_SHARE = 0.9
MIX_WEIGHTS = {("domain0",): 2, ("domain1",): 1.5}


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Stage tables of the stage that was called last.
_last: list[str] = []


def stage(f: Stage) -> Stage:
    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        while _last:
            drop_table(spark, _last.pop())
        before = stage_tables()
        out = f(spark, docs, sf_dir)
        _last.extend(stage_tables_since(before))
        return out

    return run


def _numbered(docs: DataFrame) -> DataFrame:
    return materialize(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("__row")))


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: null and empty texts, texts without a letter, and those that two languages encode nearly equally well. Equal texts fare alike."""
    model = language_id.train(docs)
    return language_id.classify(docs.select(*COLUMNS), model).where(~F.col("rejected")).select(*COLUMNS)


@stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each exact text, that of the largest doc_id (of rows that tie, one): the corpus comes as two loads, the first a snapshot whose binary-fuse filters screen the second. Null and empty texts are one text."""
    return exact_dedup.keep_one(_numbered(docs), COLUMNS, "__row", exact_dedup.loads_of())


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class: the one of the least doc_id, one without only if none has any. Null and empty texts, and texts without a word, are one class."""
    d = _numbered(docs)
    kept = near_dedup.near_dedup(d, uid="__row").where("kept").select(F.col("uid").alias("__row"))
    return d.join(kept, "__row", "left_semi").select(*COLUMNS)


@stage
def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes ``MIX_SHARE`` of the tokens, by ``MIX_WEIGHTS`` as far as domains, their languages and their sources have them. Null languages and sources are branches of their own; texts without a token are taken as long as their source's budget isn't used up."""
    d = _numbered(docs)
    tree = [mixing.domain(F.col("source")), "lang", "source"]
    out = mixing.mix_sources(d, tree, MIX_WEIGHTS, total_share=MIX_SHARE, max_epochs=1, uid="__row").select(F.col("uid").alias("__row"))
    return d.join(out, "__row", "left_semi").select(*COLUMNS)


@stage
def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents that are left into windows of the sources' proportions; a null or empty text is the end token alone."""
    return packing.pack(docs)


STAGES = [
    ("language id", identify_language),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_to_weights),
    ("packing", pack_windows),
]
#: SQL has no zstandard, BagMinHash or tokenizer: the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, step) in enumerate(STAGES):
        at = f"{base}/{k}"
        step(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
        if k:  # the table before it is not read again
            drop_table(spark, f"{base}/{k - 1}")
    while _last:
        drop_table(spark, _last.pop())
    return docs
