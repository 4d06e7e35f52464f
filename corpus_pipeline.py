"""The corpus pipeline: each stage's documents are written as Parquet and read again as the next stage's.

Toxic documents go, repeated lines are cut, one document of each near-duplicate class stays, documents that hold benchmark items go,
and the rest is packed into token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tactus.llm.common import new_path
from tactus.llm.decontamination import stage_decontamination
from tactus.llm.jaccard_join import stage_jaccard_join
from tactus.llm.line_dedup import stage_line_dedup
from tactus.llm.packing import stage_packing
from tactus.llm.toxicity import stage_toxicity

STAGES = [
    ("toxicity", stage_toxicity),
    ("line_dedup", stage_line_dedup),
    ("jaccard_join", stage_jaccard_join),
    ("decontamination", stage_decontamination),
    ("packing", stage_packing),
]

#: SQL can't express the first, third and last stage; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
