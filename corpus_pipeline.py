"""A corpus pipeline of five stages, from raw documents to packed training sequences.

Each stage takes what its predecessor kept, written as Parquet and read again:
quality (rejects documents that the classifier scores under its threshold), language (rejects texts without a
recognised language), near-duplicates (keeps the smallest doc_id of each group), mix (repeats or leaves out
documents as the schedule's slots play them, in slot order) and pack (best-fit sequences; one row a piece).

Defined results: null, empty and blank texts score as the classifier's prior says, are no language and so go in the
language stage at the latest; very long texts are read whole in every stage; rows with a null doc_id pass quality and
language by their text, are linked with nothing in near-duplicates and are mixed and packed like others; repeated rows
(equal in all columns) have equal scores, all stay in near-duplicates if their doc_id stays, and are mixed each on its
own; ties (equal texts) keep the smallest doc_id; empty tables give no rows in every stage; extra columns, whatever
their names, are kept up to the last stage, and columns that a stage needs get names that are free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import free_name, workspace
from docloom.llm.langid import identify, learn as learn_languages
from docloom.llm.mixing import mixed_documents
from docloom.llm.neardup import near_duplicates
from docloom.llm.packing import pack_documents
from docloom.llm.quality import classify, learn as learn_quality
from docloom.llm.queries import CAPACITY, vocabulary_path

QUALITY_THRESHOLD = 0.3
LANGUAGE_THRESHOLD = 0.2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    model = learn_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs, "quality_score")
    return classify(docs, model, name).where(F.col(name) >= QUALITY_THRESHOLD).drop(name)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learnt languages: not ``und``, and not under the least confidence.

    Text that does not fit the language that the machines choose (a language never learnt, random letters, encoded
    data) scores near 0.
    """
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = identify(docs, learn_languages(docs), lang, score)
    return found.where((F.col(lang) != "und") & (F.col(score) >= LANGUAGE_THRESHOLD)).drop(lang, score)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near-duplicates (words of five, 0.8)."""
    gone = free_name(docs, "gone")
    groups = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(groups, docs["doc_id"] == groups[gone], "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as slots of the mix play them, in the order of the slots."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and offset."""
    return pack_documents(docs, vocabulary_path(), CAPACITY, end_id=1)


STAGES = [("quality", quality), ("language", language), ("dedup", dedup), ("mix", mix), ("pack", pack)]

#: Learnt models, hashes and a tokenizer have no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = workspace(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
