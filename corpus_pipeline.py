"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Language identification drops documents without a letter or scored about chance; the n-gram Jaccard join keeps
one document of each class of near copies; the secret scan masks secrets that look live; mixing repeats
and thins out documents so that the sources meet their weights; byte-level BPE encodes what is left and
decodes it again. All stages but the last return the columns of ``documents``. An empty table passes through
all of them as one; null, empty and repeated rows are as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldbook.llm.common import documents, written
from fieldbook.llm.queries import PIPELINE

STAGES = PIPELINE

#: A trained model, a similarity join and exact BPE are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
