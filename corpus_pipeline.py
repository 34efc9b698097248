"""A cleaning pipeline over ``documents``: five stages, each written as Parquet and read again for the next.

1. quality: documents that the classifier scores below its threshold go (trained on ``labels`` outside the
   held-out part, whose documents are scored like all others).
2. near_duplicates: of each component of the n-gram Jaccard join one document with the least id stays.
3. decontamination: documents that hold a benchmark passage go.
4. personal_data: spans of personal data become ``<kind>``; ``n_chars`` follows the new text.
5. encoding: each text as byte-level BPE ids, decoded again; the columns of ``documents`` and the ids' digests.

All but the last return the columns of their input. Rows with a null text are scored, kept and encoded as empty
texts; of rows with equal ids and texts one stays, rows with equal ids and unlike texts are documents of their own, and
rows with a null id all stay.
"""

from __future__ import annotations

import functools
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm import bpe, decontaminate, jaccard_join, pii, quality
from turnstile.llm.common import read, scratch_dir, small_batches

#: Characters in a block of the encoder: by the last stage the executors hold memory from the stages before.
ENCODING_BLOCK = 2_000_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.trained(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model, score_col="__score").filter(F.col("__score") >= quality.THRESHOLD).drop("__score")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_row_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.detect(docs, pii.fit(docs), spans_col="__spans", masked_col="__masked")
    changed = F.size("__spans") > 0
    text = F.when(changed, F.col("__masked")).otherwise(F.col("text"))
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("__masked").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.withColumns(columns).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    both = bpe.encode(docs, decoded=True, block_chars=ENCODING_BLOCK)
    return both.select("doc_id", "text", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"))


def _in_small_batches(stage):
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("quality", _in_small_batches(quality_stage)),
    ("near_duplicates", _in_small_batches(near_duplicates_stage)),
    ("decontamination", _in_small_batches(decontamination_stage)),
    ("personal_data", _in_small_batches(personal_data_stage)),
    ("encoding", _in_small_batches(encoding_stage)),
]

#: SQL can express neither the classifier nor byte-pair encoding; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the results of the stages stay in the shared scratch folder."""
    docs = read(spark, sf_dir, "documents")
    folder = scratch_dir(spark)
    for i, (name, stage) in enumerate(STAGES):
        at = os.path.join(folder, f"{i}_{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
