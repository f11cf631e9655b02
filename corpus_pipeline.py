"""Corpus pipeline over `documents`: each stage works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next one's docs. All but the last
return the columns of `documents`; the last returns the tokens' digests.

1. quality: documents that the compression classifier predicts as 1 stay.
2. exact: of equal texts the row with the largest doc_id stays.
3. near: of each class of near duplicates the smallest doc_id stays.
4. decontaminate: documents that hold benchmark passages go.
5. tokens: whole texts are encoded by byte-level BPE, and decoded again.

Defined cases: those of the operators. Rows that share a doc_id stand or
fall together in stages 2 (with their text), 3 (if any of them is kept) and 4
(if none is contaminated); stage 1 judges each row by its own text. A row
with a null doc_id goes in stages 2 and 4 by the group of null ids, and
passes stage 3. Extra columns of `documents` are kept up to
the last stage. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import bpe, decontam, exact_dedup, near_dedup, quality
from fleetpulse.llm.common import table, text_column, written

#: The threshold of the near-duplicate query; the pairs from 80 to 85 percent stay.
NEAR_PERCENT = 85


def _without(docs: DataFrame, dropped: DataFrame, *more) -> DataFrame:
    """Rows of docs whose key is not in `dropped` (column drop_doc_id); null ids are keys too.

    The dropped keys are a written table: the planner broadcasts them if
    that is under Spark's limit, and then the texts are not shuffled.
    """
    same = docs["doc_id"].cast("long").eqNullSafe(dropped["drop_doc_id"])
    for c in more:
        same = same & c
    return docs.join(dropped, same, "left_anti").select(docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_rows(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(docs).filter(~F.col("kept"))
    dropped = written(groups.select(F.col("doc_id").alias("drop_doc_id"), F.col("text_sha256").alias("drop_sha")).distinct(), "drop-exact")
    return _without(docs, dropped, F.sha2(F.encode(text_column(), "UTF-8"), 256) == dropped["drop_sha"])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = near_dedup.similarity_classes(docs, percent=NEAR_PERCENT)
    stay = judged.groupBy(F.col("doc_id").alias("drop_doc_id")).agg(F.max("kept").alias("stay"))
    return _without(docs, written(stay.filter(~F.col("stay")).select("drop_doc_id"), "drop-near"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, written(judged.filter("contaminated").select(F.col("doc_id").alias("drop_doc_id")).distinct(), "drop-contaminated"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(docs, *bpe.vocabulary()))


STAGES = [
    ("quality", quality_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("decontaminate", decontamination_stage),
    ("tokens", token_stage),
]

#: Compression with trained dictionaries and byte-level BPE are not SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
