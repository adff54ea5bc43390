"""A corpus from raw documents in five stages: language, exact copies, near copies, mixing, encoding.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame,
which run() writes as Parquet to the shared folder and reads again as the next stage's docs.  All but
the last stage return the columns of documents, in their order, whatever other columns they have.
No stage fails on an empty table: it gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notara.llm._shared import drop, fold, read, relax, save, scratch, small
from notara.llm.bpe import encoding_digests
from notara.llm.exact_dedup import drop_copies
from notara.llm.language_id import fit, keep_known
from notara.llm.mixing import mixed_documents
from notara.llm.near_dedup import near_duplicates


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised.

    Texts that are null, empty or without a letter go, and those far from every language of the rows
    that it learns from (crc32 of doc_id modulo 4 is not 2; a null lang is not learned from, a null
    doc_id is).  Long texts are judged whole; equal texts are judged alike, and each row stays or goes
    for itself.
    """
    relax(spark)
    model = fit(docs.where(fold("doc_id", 4) != 2))
    return keep_known(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal after each white space run became one space.

    The row of the least doc_id stays (null last; of rows that share it, the first by their other
    columns).  Null and empty texts are one group.  Long texts are compared by SHA-256.
    """
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least doc_id of each group of near copies (five-word shingles, similarity of 0.75 or more).

    Texts that are null, empty or without a word are linked with nothing and stay, as do rows whose
    doc_id is null.  Rows that share a doc_id stay or go together.  Long texts are compared whole.
    """
    relax(spark)
    gone = save(near_duplicates(docs).where("NOT kept").select("doc_id").distinct(), "near")
    return docs.join(small(spark, gone), "doc_id", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents that it leaves out go, those that it takes twice have two rows.

    Texts that are null, empty or without a word are never taken; a null source is a source of its
    own; a long document counts with all its words.  Ties go by the MD5 of doc_id, then doc_id, then
    the row's other columns.
    """
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row; null and empty texts have no token, and repeated rows one result each."""
    relax(spark)
    return encoding_digests(docs)


STAGES = [("language", language), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("mixing", mixing), ("bpe", encoding)]

#: No SQL form: trained language models, MinHash candidates and byte-pair encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  What a stage wrote is deleted once the next one has been written."""
    docs = read(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        with scratch(spark) as keep:
            docs = keep(save(stage(spark, docs, sf_dir), name))
        if before is not None:
            drop(before)
        before = docs
    return docs
