"""A training corpus from ``documents``: filter, de-duplicate, pack.

Each stage takes what its predecessor left and returns the columns of ``documents``; the
last returns the pieces of the packed sequences. The stages are written as Parquet into
the shared folder and read again, so a lost executor costs one stage's tasks at most.

Cases: null and empty texts fail the quality rules; texts of any length go through whole; of
repeated rows one stays; rows with a null id are documents like others; an empty table
gives an empty result. Columns beyond those of ``documents`` are handed on, whatever their
names, up to the packing, which returns its own columns.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatekit.llm import packing, quality, setsketch, substring_dedup, toxicity
from gatekit.llm.common import prepare, stored


def _plain(docs: DataFrame) -> list[str]:
    """The names of ``documents`` as they are, others as ``more_0`` and so on."""
    return [c if c in ("doc_id", "text", "lang", "source", "n_chars") else f"more_{i}" for i, c in enumerate(docs.columns)]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules, or whose host does, go."""
    prepare(spark)
    return quality.filter_documents(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    prepare(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = _plain(docs)
    scored = toxicity.score(docs.toDF(*names), model)
    return scored.filter(F.col("__score") < toxicity.THRESHOLD).select(*names).toDF(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays."""
    prepare(spark)
    return setsketch.keep_one(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier in the corpus are cut out; n_chars follows the text."""
    prepare(spark)
    names = _plain(docs)
    out = substring_dedup.dedup_documents(docs.toDF(*names))
    changed = F.size("__removed") > 0
    out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*names).toDF(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as sequences of at most 1024 tokens, one row per piece."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("packing", packing_stage),
]
#: A classifier is fitted and tokens are encoded; SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
