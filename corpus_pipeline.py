"""Corpus pipeline: quality filter, line dedup, near-duplicate removal,
benchmark decontamination and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's result
as Parquet below the shared folder and reads it again for the next stage, so
a lost executor costs at most one stage's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoscore.llm import decontam, lines, packing, quality, shingles
from geoscore.llm.common import free_name, written
from geoscore.llm.queries.documents import quality_model
from geoscore.sources.testdata import load

LEAST_QUALITY = 0.3


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Without labels every
    document scores 0.5 and stays."""
    weights = quality_model(spark, docs, load(spark, sf_dir, "labels"))
    mark = free_name(docs, "quality")
    scored = docs.withColumn(mark, quality.score(F.col("text"), weights, spark))
    return scored.where(F.col(mark) >= LEAST_QUALITY).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that resemble an earlier one. A document that
    loses all its lines stays with an empty text; n_chars follows the text."""
    mark = free_name(docs, "kept")
    out = lines.dedup_lines(docs, mark)
    text = F.col(f"{mark}.text")
    changes = {"text": text}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changes["n_chars"] = F.when(F.col(f"{mark}.n_removed") > 0, F.length(text).cast(kind)).otherwise(F.col("n_chars"))
    return out.withColumns(changes).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return shingles.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, load(spark, sf_dir, "benchmark").select("item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and place in it."""
    return packing.pack(packing.pieces(docs.select("doc_id", "text")))


STAGES = [
    ("quality", quality_filter),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

ORACLE_SQL = None  # learnt scores, joins on hashes and packing have no SQL form; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
