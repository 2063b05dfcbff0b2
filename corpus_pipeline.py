"""Documents to tokens: language, near duplicates, secrets, mixture, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnout.llm.bpe import encoded_documents
from turnout.llm.common import stored, table
from turnout.llm.language import spoken_documents
from turnout.llm.mixing import mixed_documents
from turnout.llm.neardup import single_documents
from turnout.llm.secrets import redacted_documents

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("language", spoken_documents),
    ("near_duplicates", single_documents),
    ("secrets", redacted_documents),
    ("mixture", mixed_documents),
    ("encoding", encoded_documents),
]

#: Language, near-duplicate and encoding stages are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is stored and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
