"""From raw documents to packed training sequences, in stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm.ngram_join import ngram_jaccard_components
from sluicework.llm.packing import pack_along_curve
from sluicework.llm.poisson_mix import poisson_mix
from sluicework.llm.quality import classify, grades_of
from sluicework.llm.sentence_spans import remove_repeated_spans
from sluicework.registry.common import Query, table
from sluicework.sources.scratch import written_out

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents more likely of the highest grade than not, by a model of the labels.

    Null and empty texts are graded by their length alone, very long ones are read whole;
    repeated rows get equal grades and stay together. Without labels of two grades all
    stay; an empty table gives no rows. Only the columns of documents are kept.
    """
    return classify(docs, grades_of(table(spark, sf_dir, "labels"))).filter("keep").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; empty ones have none.

    The one of the smallest doc_id stays, null last, then of the smallest hash of its text.
    Equal rows of the one that stays are one row after it. Null, empty and white texts are
    groups of their own, very long texts are compared whole. An empty table gives no rows.
    """
    first = (
        ngram_jaccard_components(docs)
        .filter("is_first")
        .select(F.col("doc_id").alias("first_id"), F.col("text_key").alias("first_key"))
        .distinct()
    )
    keyed = docs.select(*COLUMNS).withColumn("text_key", F.unhex(F.md5("text")))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & F.col("text_key").eqNullSafe(F.col("first_key"))
    return keyed.join(first, same, "left_semi").dropDuplicates(["doc_id", "text_key"]).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document holds.

    Earlier is by doc_id, null last, then by a hash of the text; ties go by the place in
    the text. Null texts stay null, texts of which all is removed become empty, and no row
    is dropped. Very long texts are cut whole. An empty table gives no rows.
    """
    return remove_repeated_spans(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source with an equal share, in random order.

    A null source is a source. Texts play no part, null and long ones are copied as they
    are; rows of one doc_id draw alike, so repeated rows get as many copies each. A
    document may get none. An empty table gives no rows.
    """
    return poisson_mix(docs).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens, neighbours along the curve together.

    Null and empty texts are their end token alone, very long ones fill several
    sequences. Copies are packed once each, in an order given by doc_id. An empty table
    gives no rows.
    """
    return pack_along_curve(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mixing),
    ("packing", packing),
]

#: A fitted model, a tokenizer and hashes of word runs have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written_out(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERY = Query(run, ORACLE_SQL)
