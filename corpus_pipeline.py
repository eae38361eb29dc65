"""A training corpus from raw documents, in five stages.

Each stage takes all that its predecessor kept, as stored Parquet, and returns the documents that
go on with all their columns; the last returns what the mix takes of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.llm.decontaminate import contamination
from gaugeframe.llm.mixing import mix_sources
from gaugeframe.llm.near_copies import near_copies
from gaugeframe.llm.pii import mask_personal_data
from gaugeframe.llm.rows import drop_ids, one_row_per_id, with_row_id
from gaugeframe.llm.toxicity import fit_toxicity, with_toxicity
from gaugeframe.sources.scratch import materialize

ID, SCORE = "__gf_id", "__gf_score"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_toxicity(docs, model, SCORE).where(F.col(SCORE) < 0.5).drop(SCORE)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): that with
    the smallest doc_id. Of rows that repeat a doc_id the smallest stays."""
    named = with_row_id(docs, ID)
    found = near_copies(named.select(F.col(ID).alias("doc_id"), "text"))
    gone = materialize(found.where(~F.col("kept")).select("doc_id").distinct(), "copies")
    return one_row_per_id(drop_ids(named, gone, ID), ID).drop(ID)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    named = with_row_id(docs, ID)
    found = contamination(named.select(F.col(ID).alias("doc_id"), "text"), items)
    gone = materialize(found.where("contaminated").select("doc_id").distinct(), "leaks")
    return drop_ids(named, gone, ID).drop(ID)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    masked = mask_personal_data(docs)
    if "n_chars" not in docs.columns:
        return masked
    length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return masked.select(*[length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of each document."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_copies", near_copy_stage),
    ("decontamination", benchmark_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
]

# The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
