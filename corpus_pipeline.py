"""The corpus pipeline: rules, language, near duplicates, repeated strings, packing.

Each stage works on all that the one before it kept. All but the last return the columns of
``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnmark.llm import langid, ngram_join, packing, quality, suffix_dedup
from kilnmark.llm.common import bounded_batches, durable, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language named with less certainty than this rejects the document.
LEAST_SCORE = 0.4


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and every rule; each row is judged by its text alone.

    Null and empty texts go. Rows without a doc_id and repeated rows are judged like others. Extra columns are dropped.
    """
    return quality.judge(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the net names with some certainty; it learns on the rows given here.

    If none of them can be learned from, there is no net, and every document that has a letter stays.
    """
    bounded_batches(spark)
    net = langid.train(docs.select("doc_id", "lang", "text"))
    if net is None:
        return docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}"))
    told = langid.predict(docs.select(*COLUMNS), net)
    return told.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each component.

    Rows without a doc_id link with nothing and stay. Rows that repeat a doc_id are one document:
    the least of them in the order of the other columns stays.
    """
    bounded_batches(spark)
    first = (ngram_join.ngram_components(docs).where("doc_id = component_id").select(F.col("doc_id").alias("__keep")).distinct())
    rows = docs.select(*COLUMNS)
    kept = rows.join(first, F.col("doc_id") == F.col("__keep"), "left_semi")
    one = kept.groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("x")).select("doc_id", "x.*")
    return one.unionByName(rows.where("doc_id is null"))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that a document of smaller doc_id holds in a repeated string.

    A null text becomes empty, n_chars counts what is left. Rows without a doc_id neither lose nor take anything.
    Extra columns are dropped; an empty table gives no row.
    """
    bounded_batches(spark)
    cut = suffix_dedup.cut_texts(suffix_dedup.dedup(docs.select(*COLUMNS)))
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the packed sequences.

    A null or empty text is the closing id alone. Rows without a doc_id are packed too, with a null there. An empty
    table gives no row.
    """
    bounded_batches(spark)
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality_rules), ("language", language), ("near_duplicates", near_duplicates),
          ("repeated_strings", repeated_strings), ("pack", pack)]
#: The language net and the byte pairs have no form in SQL. tests/llm holds near duplicates, repeated strings and packed
#: lengths against brute force; rules and languages there are the verdicts of their own operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = durable(docs, name)
    return docs
