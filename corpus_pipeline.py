"""A corpus pipeline over ``documents``: five stages, each calling one operator.

Stages that filter return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspark.llm.common import read_table, written
from loomspark.llm.langid import keep_identified
from loomspark.llm.near_copies import keep_one
from loomspark.llm.packing import packed_documents
from loomspark.llm.secrets import redact
from loomspark.llm.suffix_trees import cut_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language the model rejects: no letter at all (null and empty texts too), or no language likely.

    Rows without an id are judged like any others; an empty table stays empty.
    """
    return keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group whose five-word shingles agree to 0.8 or more.

    Null and wordless texts are one group, repeated rows of one id and text leave a single row, rows
    without an id stay; an empty table stays empty.
    """
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 13 words and more that a document of smaller id also holds; null texts and rows without an id stay as they are."""
    return cut_repeats(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; all documents stay, null texts as they are."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of all documents into sequences; null and empty texts are the end id alone, an empty table gives no rows."""
    return packed_documents(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("secret_scan", secret_scan), ("packing", packing)]

#: No stage but the cut by a fixed window could be put in SQL; tests compare small runs with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and reread before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
