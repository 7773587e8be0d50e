"""Hashed word features and the bounded samples of labelled rows that models are fitted on."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalfed.llm.common import Codes

TOKEN = re.compile(r"\w+|[^\w\s]+")
BITS = 18
STEM = 4


@lru_cache(maxsize=1)
def codes() -> Codes:
    """One memory of token hashes per Python worker, kept from task to task."""
    return Codes()


def token_codes(text: str) -> np.ndarray:
    tokens = TOKEN.findall(text.lower())
    return np.fromiter(map(codes().__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def spread(values: np.ndarray, bits: int) -> np.ndarray:
    """Multiplicative hash of 64-bit values to ``bits`` bits."""
    return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def ngrams(text: str, bits: int = BITS) -> np.ndarray:
    """Slots of the words and word pairs of a text, repeats included; a word that follows
    itself makes the same pair whatever the word."""
    words = token_codes(text)
    pairs = words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:]
    pairs[words[:-1] == words[1:]] = 0
    return spread(np.concatenate([words + np.uint64(1), pairs]), bits)


def distinct_words(text: str, bits: int = BITS) -> np.ndarray:
    """Slots of the distinct words of a text and of the stems (first letters) they begin with."""
    words = set(TOKEN.findall(text.lower()))
    words |= {word[:STEM] + "*" for word in words if len(word) > STEM}
    found = np.fromiter(map(codes().__getitem__, words), dtype=np.uint64, count=len(words))
    return np.unique(spread(found + np.uint64(1), bits))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, usable: Column,
                    rows: int) -> DataFrame:
    """At most ``rows`` labelled texts, those whose ids hash lowest; ids never leave here."""
    chosen = labels.filter(usable & label.isNotNull()).select(
        F.col("doc_id").alias("_id"), label.alias("_label")).orderBy(
        F.xxhash64("_id"), "_id", "_label").limit(rows)
    texts = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text")).filter(
        F.col("_text").isNotNull())
    joined = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))  # ``rows`` at most
    return joined.orderBy(F.xxhash64("_id"), "_id", "_label", F.xxhash64("_text")).limit(
        rows).select("_text", "_label")
