"""A training corpus from documents: quality rules, line dedup, near-dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is written as
Parquet and read again for the next. All but the last return the columns of documents. Rows without
doc_id go through; a document whose lines all went as repeats is dropped by the line stage. Repeated rows of one
document are judged alike; of near-duplicates the smallest doc_id stays. Further columns of any name go through as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import decontaminate, line_chunks, near_dups, packing, quality
from marketloom.llm.bloom import split_by_ids
from marketloom.llm.common import ready, staged, table


#: Columns of documents; others are renamed while a stage adds columns of its own.
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def _set_apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with further columns under names that no stage uses, and the way back."""
    others = {c: f"c{i}_{uuid.uuid4().hex}" for i, c in enumerate(docs.columns) if c not in DOCUMENTS}
    return docs.withColumnsRenamed(others), {new: old for old, new in others.items()}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list keeps."""
    docs, names = _set_apart(docs)
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return model.apply(docs).where("verdict").select(*docs.columns).withColumnsRenamed(names)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the multi-line chunks that occur earlier; emptied documents go."""
    ready(spark)
    docs, names = _set_apart(docs)
    cleaned = line_chunks.drop_repeated_chunks(docs)
    emptied = (F.col("n_removed_chunks") > 0) & (F.trim("text") == "")
    changed = F.when(F.col("n_removed_chunks") > 0, F.length("text")).otherwise(F.col("n_chars"))
    kept = cleaned.where(~emptied).withColumn("n_chars", changed.cast("bigint")).select(*docs.columns)
    return kept.withColumnsRenamed(names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    ready(spark)
    judged = near_dups.near_duplicates(docs, words=5, percent=80)
    gone = staged(judged.where("NOT kept").select("doc_id").distinct(), "near_duplicates")
    likely, rest = split_by_ids(docs, gone, gone.count())
    kept = likely.join(gone, "doc_id", "left_anti").select(*docs.columns)
    return kept.unionByName(rest.select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces with their ids."""
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Learned rules, MinHash and tokenizers are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
