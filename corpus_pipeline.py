"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of ``documents``. A
stage works on all rows that its predecessor kept. ``run`` writes each stage's result as Parquet to the folder that the
cluster shares and hands the next stage what it reads back.

No stage is expressible in SQL over the tables (a trained model, 64-bit fingerprints, exact repeats of byte strings and
a BPE vocabulary), so ORACLE_SQL is None and tests hold the stages against brute force, an exact encoder or held-out accuracy.

Defined results of every stage: a null text counts as an empty one and stays null, null identifiers are rows like others,
texts of any length are read whole, columns of any name go through unchanged, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseledger.llm.bpe import token_digests
from caseledger.llm.common import materialize, table
from caseledger.llm.decontam import decontaminate
from caseledger.llm.near import drop_similar
from caseledger.llm.quality import select_quality
from caseledger.llm.queries import tokenizer_path
from caseledger.llm.repeats import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of grade 1 or more is at least one half. Repeated rows are graded alike. With a
    single grade known every row has that grade; without labels all rows stay."""
    return select_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose five-word shingles have a Jaccard similarity of 0.8 or more: that of
    the smallest (identifier, text hash), nulls last, and one row where both are equal. Texts without words are alike."""
    return drop_similar(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of more than 50 words, or of 400 bytes in fewer words, that start anywhere else as well.
    No row goes: a text that is repeated as a whole becomes empty, and its size follows."""
    return remove_repeats(docs, words=51)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain less than 0.8 of every benchmark item's shingles of five words, all repeated rows of a text
    alike. Null and empty items match nothing; an item under five words is one shingle."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every kept text; an empty one has no tokens."""
    return token_digests(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats), ("decontamination", decontamination), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", "snappy")
    return STAGES[-1][1](spark, docs, sf_dir)
