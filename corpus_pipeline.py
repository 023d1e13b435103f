"""The corpus pipeline: documents through the operators of ``monthwise.llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read back as the
next one's ``docs``.

1. ``toxicity``: documents predicted toxic go.
2. ``line_dedup``: later copies of repeated line runs are deleted from the
   texts; every document stays, if need be with an empty text.
3. ``near_duplicates``: one document of each SimHash component stays, that
   of the smallest doc_id.
4. ``decontaminate``: documents with a benchmark passage go.
5. ``bpe``: doc_id, n_tokens, the token ids, and the text they decode to.

All but the last return the columns of ``documents``, extra ones too.  Null
texts pass every filter as empty texts do; repeated rows are near-duplicates
of each other; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthwise.llm.bpe import bpe_encode_decode, byte_bpe_path
from monthwise.llm.common import read_table, staged
from monthwise.llm.decontaminate import drop_leaks
from monthwise.llm.line_dedup import dedup_lines
from monthwise.llm.simhash import keep_one
from monthwise.llm.toxicity import drop_toxic, fit_on_tables


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier is fitted on the tables' labelled rows, then applied to ``docs``."""
    return drop_toxic(docs, fit_on_tables(spark, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_encode_decode(docs, byte_bpe_path())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("bpe", bpe),
]

#: A trained classifier, SimHash components and BPE have no SQL form;
#: tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
