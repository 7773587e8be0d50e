"""Operator 5: best-fit packing of tokenized documents by minimum bin slack.

Documents are tokenized in Spark tasks and cut only beyond the capacity. The number of
pieces of each length (at most ``capacity`` numbers, whatever the input) is all that the
plan needs: per bin, a subset-sum over a bitset of reachable fills finds the fullest
combination that holds the longest piece left, and the same combination is taken as often
as its pieces last. Pieces then find their place by their rank among pieces of their
length, so no task and not the driver ever holds the pieces.

Null and empty texts give one piece that holds the closing id alone. Repeated rows are
packed as rows of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalfed.llm.common import running_totals, settled

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
#: ASCII marks that end a word; the apostrophe may begin a piece of letters of its own.
MARKS = string.punctuation.replace("'", "")

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long")


class WordIds(dict):
    """Ids of a chunk between spaces as little-endian bytes, remembered up to a limit.

    Letters are split from what is not a letter and lower-cased by the tokenizer itself, so
    a chunk of letters with marks after it is looked up in two parts, in lower case. That
    holds as long as lower-casing leaves letters only: of a dotted capital I it leaves a
    combining mark, to which the mark after it would belong.
    """

    MOST = 1_200_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)

    @staticmethod
    def parts(chunk: str) -> tuple[str, ...]:
        """What a chunk is looked up by: itself, or lower-cased letters and closing marks."""
        letters = chunk.rstrip(MARKS)
        mark, lower = chunk[len(letters):], letters.lower()
        if letters.isalpha() and lower.isalpha() and "\u03a3" not in letters:
            # Sigma is lower-cased by its place in Python only.
            return (lower, mark) if mark else (lower,)
        return (chunk,)

    def __missing__(self, chunk: str) -> bytes:
        parts = self.parts(chunk)
        if parts != (chunk,):
            return b"".join([self[part] for part in parts])  # not kept: the parts are
        if len(self) > self.MOST:
            self.clear()
        ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        code = self[chunk] = np.array(ids, dtype="<u4").tobytes()
        return code


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One memory per Python worker, kept from task to task."""
    return WordIds(path)


def tokenized(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece. The tokenizer drops white space and never joins across it, so the
    ids of a text are those of its chunks between spaces and line ends, one after another.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            out: list[list[int]] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunks = (text.as_py() or "").replace("\n", " ").split(" ")
                ids = b"".join(map(words.__getitem__, chunks)) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for column, value in zip(out, (doc_id, piece, at // 4, len(part) // 4,
                                                   zlib.crc32(part))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int32(), pa.int64(),
                                                      pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as near to ``room`` as can be."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(take, left)
            steps.append((reach, length, take))
            reach |= (reach << take * length) & mask
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + take
            at -= take * length
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(how often, number of each length) until every piece is placed."""
    left, bins = dict(counts), []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        combination = fullest({k: v for k, v in rest.items() if v}, capacity - longest)
        combination[longest] = combination.get(longest, 0) + 1
        times = min(left[n] // c for n, c in combination.items())
        bins.append((times, combination))
        for n, c in combination.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return bins


def places(bins: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, number in a bin, offset of the first)."""
    used: dict[int, int] = {}
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for times, combination in bins:
        offset = 0
        for length in sorted(combination, reverse=True):
            number = combination[length]
            table.setdefault(length, []).append(
                (used.get(length, 0), sequence, number, offset))
            used[length] = used.get(length, 0) + number * times
            offset += length * number
        sequence += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in table.items()}


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = settled(tokenized(docs, tokenizer_path, capacity), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(
        F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    table = places(plan_bins(counts, capacity))
    firsts, seen = {}, 0
    for length in sorted(counts):
        firsts[length] = seen
        seen += counts[length]
    ranked = running_totals(pieces, ["length", "doc_id", "piece", "ids_crc32"], "length",
                            "ranked")
    shared = docs.sparkSession.sparkContext.broadcast((table, firsts))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, firsts = shared.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("_rank").to_numpy()
            sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                rank, segments = ranks[rows] - firsts[length], table[length]
                first, base, number, at = segments[
                    np.searchsorted(segments[:, 0], rank, "right") - 1].T
                sequence[rows] = base + (rank - first) // number
                offset[rows] = at + (rank - first) % number * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"])

    schema = T._parse_datatype_string(PIECES + ", sequence_id long, offset long")
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank").mapInArrow(
        place, schema)
