"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, folder of the tables), works on all that the stage before kept
and returns a DataFrame, which is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.

Rows that share a doc_id are one document. Null texts have no language and go in the first
stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalfed.llm import jaccard, language, mixing, packing, queries, substrings
from tidalfed.llm.common import prepare, settled

#: Tokens and classes decide here; SQL has neither the tokenizer nor the trained network.
ORACLE_SQL = None
#: Near copies in the pipeline: words of a shingle, and least Jaccard similarity in per cent.
#: The query op1_ngram_jaccard_join has numbers of its own (``jaccard.GRAM``, ``SHARE``).
GRAM, SHARE = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Operator 9: texts without a language (null, or no letter) go."""
    prepare(spark)
    return language.in_a_language(docs, language.train_on(docs))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Operator 1: of each group of near copies, the document with the smallest id stays."""
    prepare(spark)
    copies = jaccard.jaccard_components(docs, gram=GRAM, share=SHARE).filter(
        "component_id <> doc_id").select(F.col("doc_id").alias("_copy")).distinct()
    copies = jaccard.sent(copies)
    return docs.join(copies, docs["doc_id"].cast("long") == copies["_copy"], "left_anti")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Operator 4: repeated strings of 100 bytes are cut out of the texts."""
    prepare(spark)
    return substrings.without_repeats(docs)


def mix_to_target_weights(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Operator 7: a document stays as often as the mix takes it."""
    prepare(spark)
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Operator 5: the pieces of the documents and their places in sequences."""
    prepare(spark)
    return packing.pack(docs, queries.tokenizer())


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mix_to_target_weights", mix_to_target_weights),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs
