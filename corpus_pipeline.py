"""Training-corpus pipeline: quality filter, near-duplicate removal, removal of repeated passages, packing.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir), works on all
rows its predecessor kept and, but for the last, returns the columns of
``documents``.  ``run`` writes every stage's result to the shared folder and
reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from care_analytics.llm.common import prepare, release, tables, written
from care_analytics.llm.minhash import without_near_duplicates
from care_analytics.llm.packing import pack
from care_analytics.llm.quality import good_documents
from care_analytics.llm.queries import tokenizer_path
from care_analytics.llm.suffix_dedup import remove_repeats

# a passage of more than 50 words is longer than this in ordinary text; one of very short words can be shorter and stays (README)
PASSAGE_BYTES = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score at least 0.5).

    Null text counts as empty and is scored like any text; a null ``doc_id`` has no
    label; repeated rows get one score and stay or go together; without labels all
    rows stay; an empty table stays empty; other columns, ``features`` too, stay."""
    return good_documents(docs, tables(prepare(spark), sf_dir, "labels"), held_out=None)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more).

    The smallest ``doc_id`` stays, of repeated rows one; documents without words (null,
    empty, blank) are no duplicates of each other and stay; a null ``doc_id`` stays only
    where its group has no other; an empty table stays empty; other columns stay."""
    prepare(spark)
    return without_near_duplicates(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that other documents repeat; ``n_chars`` follows the text.

    Null and empty texts stay as they are; repeated rows and a passage repeated within
    one document go too; a text that is one passage becomes empty and its row stays; an
    empty table stays empty; other columns, ``removed`` too, stay."""
    prepare(spark)
    cut = remove_repeats(docs, PASSAGE_BYTES)
    out = cut.drop(cut.columns[-1])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    out._care_made = cut._care_made
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the encoded documents in sequences of 1024 tokens.

    Null text is empty (its end id alone is packed); a null ``doc_id`` stays; repeated
    rows are packed each; an empty table gives no pieces; other columns are ignored."""
    return pack(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("packing", packing)]

# no stage can be expressed in SQL; tests compare each with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        staged = stage(spark, docs, sf_dir)
        docs = written(staged, f"stage-{name}")
        release(staged)
    return STAGES[-1][1](spark, docs, sf_dir)
