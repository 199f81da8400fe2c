"""A pipeline over the table of documents, from the operators of ``plinth.llm``.

Each stage works on all rows its predecessor kept; what it returns is written as Parquet and read
again as the next stage's documents. All stages but the last return the columns of the documents.

1. language: rows that are in no language, or between two, go.
2. near_dedup: of documents linked by their SimHash one stays.
3. suffix_dedup: strings of 200 bytes that stand in two places are cut out of the texts.
4. decontamination: documents that hold much of a benchmark item go.
5. bpe: what is left becomes token ids, decoded again as a check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plinth.llm import bpe, decontaminate, language_id, simhash, suffix_dedup
from plinth.llm.batches import documents
from plinth.session import new_dir

STAGES = [
    ("language", language_id.stage_language),
    ("near_dedup", simhash.stage_near_dedup),
    ("suffix_dedup", suffix_dedup.stage_suffix_dedup),
    ("decontamination", decontaminate.stage_decontaminate),
    ("bpe", bpe.stage_bpe),
]

#: SQL can't express the learned and the hashing stages; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_dir(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{place}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
