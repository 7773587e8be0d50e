"""The pipeline's Jaccard stage against brute force over shingles of five words at 0.8."""

import re

import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F


def kept_by_brute_force(texts):
    sets, low = {}, {i: i for i in texts}
    for i, text in texts.items():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(len(words) - 5, 0) + 1)} if (
            words) else set()

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {root(i) for i in ids}


def passage(text, words, at=30):
    """``text`` with so many of its words replaced in one place."""
    parts = text.split(" ")
    return " ".join(parts[:at] + [f"new{at}x{i}" for i in range(words)] + parts[at + words:])


def test_near_copies_of_five_words(spark, small):
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    given = spark.read.parquet(f"{small}/documents.parquet")
    text = " ".join(f"word{i}" for i in range(104))
    # 100 shingles of five words; 7 new words leave 89 of 111 (0.802), 8 leave 88 of 112 (0.786).
    # Of the 101 shingles of four words, 7 new words leave 91 of 111 (0.820).
    made = {10_001: text, 10_002: passage(text, 7), 10_003: passage(text, 8, 70)}
    docs = given.unionByName(given.limit(1).crossJoin(spark.createDataFrame(
        list(made.items()), "_id long, _text string")).withColumn(
        "doc_id", F.col("_id")).withColumn("text", F.col("_text")).select(given.columns))
    kept = kept_by_brute_force({r["doc_id"]: r["text"] for r in docs.collect()})
    assert {10_001, 10_003} <= kept and 10_002 not in kept
    assert sorted(r["doc_id"] for r in stage(spark, docs, small).collect()) == sorted(kept)


def test_batches_of_long_texts_are_bounded(spark):
    corpus_pipeline.prepare(spark)
    docs = spark.range(0, 1500, 1, 1).select("id", F.repeat(F.lit("x"), 10_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    found = [r["size"] for r in docs.mapInArrow(sizes, "size long").collect()]
    assert sum(found) > 14_000_000 and max(found) < 5_000_000
