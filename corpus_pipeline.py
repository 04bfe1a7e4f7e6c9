"""The corpus pipeline: documents through the stages of ``panelforge.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each one's rows as Parquet in the shared folder and reads them again
for the next.  All stages but the last return the columns of ``documents``:

* language identification drops the documents that the calibrated model rejects,
* near-duplicate removal keeps one document of each group,
* decontamination cuts benchmark passages out, or drops mostly copied documents,
* personal data is masked in the text,
* packing places the token pieces of what is left into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import decontaminate, langid, packing, pii, probminhash
from panelforge.llm.common import table
from panelforge.operators.common import materialize


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_accepted(docs, langid.fit(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return probminhash.deduplicate(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_identification", language_stage),
    ("minhash_near_dedup", dedup_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("personal_data", pii_stage),
    ("best_fit_packing", packing_stage),
]

#: Trained models, sketches and packing have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else materialize(docs), sf_dir)
    return docs
