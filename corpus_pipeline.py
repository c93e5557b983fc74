"""The corpus pipeline: five stages over ``documents``. Each stage's result is
written as Parquet and read again as the next one's input; all but the last
return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvid.llm import decontaminate, minhash, packing, pu_quality, substring_dedup
from corvid.llm.common import store, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts."""
    model = pu_quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return pu_quality.keep_quality(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, of similarity 0.8 or more."""
    return minhash.drop_near_duplicates(docs, threshold=(8, 10))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages an earlier document has."""
    return substring_dedup.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark to be contaminated."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, packed."""
    return packing.pack_documents(docs)


STAGES = [("pu_quality", quality), ("minhash_near_dedup", near_dedup),
          ("substring_dedup", repeats), ("decontamination", decontamination),
          ("best_fit_packing", pack)]

#: the classifier and the packing are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
