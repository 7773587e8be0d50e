"""Operator 4: removal of repeated byte strings, decided by suffix arrays.

Texts are UTF-8 bytes. Every byte covered by a 100-byte window that also starts earlier
(smaller doc_id, or the same document and an earlier start) is removed; windows are judged on
the input. No window crosses documents. The steps:

1. Each window is owned by the 32-byte string in it whose hash is least (the first of equals),
   so equal windows have equal owners at equal places. An owner with the run of windows it
   owns is an anchor: its key (hash of the owner), and the context that holds the run.
   Every window lies in just one anchor; a text has about one anchor in 35 bytes.
2. Anchors whose key occurs twice are kept. Of equal contexts the first occurrence stays to be
   judged, the windows of all others are repeats.
3. The different contexts of one key are joined to a string, strings of many keys are sorted
   side by side by ``suffixes`` (linear grouping), and neighbours in suffix order that share 100
   bytes are equal windows: all but the first are repeats. A key with more than ``MOST``
   contexts is dealt anew by longer owners: each context goes on in ``CUTS`` parts, by where
   its windows have the owner, and the windows of a part share more bytes on both sides of it.
   Parts are handled like anchors from step 2 on, until no key has too many contexts or the
   owner is the whole window.
4. Runs of repeats come back to their texts, are merged and cut out.

Contexts are told apart by two 64-bit hashes (owner and context); texts are not compared
beyond that in step 2.

Null and empty texts and those under 100 bytes have nothing removed. Rows without an id come
last, as one id. Rows that share an id are ordered by the hash of their text; rows equal in id
and text are one document, each with its result. Extra columns change nothing. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalfed.llm.common import alone, partitions, runs, settled, whole_text
from tidalfed.llm.suffixes import END, LOWEST, PART, spans, suffix_arrays

WINDOW = 100
#: Bytes of an owner: a power of two, so that its hash is made by doubling.
OWNER = 32
#: Contexts of a key that are sorted together.
MOST = 64
#: Parts of a context when its key has more.
CUTS = 4
#: Window starts looked at together, and contexts sorted together.
CHUNK = 1 << 17
SORTED = 4096
LAST = (1 << 63) - 1

ANCHORS = "key long, context long, doc long, tag long, place long"
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


BYTES = scrambled(np.arange(1, 257, dtype=np.uint64) * MIX[0])


def hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``OWNER`` bytes, and of twice as many, from each position."""
    found, size = BYTES[data], 1
    while size < OWNER:
        found, size = doubled(found, size), size * 2
    return found, doubled(found, size)


def doubled(found: np.ndarray, size: int) -> np.ndarray:
    out = found[:-size] * MIX[1]
    out += found[size:]
    out ^= out >> np.uint64(29)
    out *= MIX[0]
    return out


def owners(found: np.ndarray, window: int) -> np.ndarray:
    """Position of the least hash of each window, the first of equals."""
    span = window - OWNER + 1
    packed = (found & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(found), dtype=np.uint64)
    size = 1
    while size * 2 <= span:
        packed, size = np.minimum(packed[:-size], packed[size:]), size * 2
    if size < span:
        packed = np.minimum(packed[:len(packed) - (span - size)], packed[span - size:])
    return (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchors_of(data: np.ndarray, offsets: np.ndarray,
               window: int = WINDOW) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, context, number of the text, start, windows owned), chunk after chunk.

    ``data`` holds the texts one after another, text k from ``offsets[k]``. An anchor that
    reaches over the end of a chunk gives one for each side.
    """
    for begin in range(0, max(len(data) - window + 1, 0), CHUNK):
        end = min(begin + CHUNK, len(data) - window + 1)
        first = np.searchsorted(offsets, begin, "right") - 1
        last = np.searchsorted(offsets, end, "left")
        starts = np.maximum(offsets[first:last], begin) - begin
        stops = np.minimum(offsets[first + 1:last + 1] - window + 1, end) - begin
        full = starts < stops
        if not full.any():
            continue
        inside = np.zeros(end - begin + 1, np.int32)
        np.add.at(inside, starts[full], 1)
        np.add.at(inside, stops[full], -1)
        inside = np.cumsum(inside[:-1]) > 0
        small, large = hashes(data[begin:end + window - 1])
        owner = owners(small, window)
        change = np.flatnonzero((owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])) + 1
        at = np.concatenate([[0], change])
        number = np.diff(np.append(at, end - begin))
        at, number = at[inside[at]], number[inside[at]]
        key = scrambled(small[owner[at]])
        wide = 2 * OWNER
        room = number + window - 1 - wide
        context = large[at] * MIX[0] + number.astype(np.uint64)
        context = scrambled(context) + large[at + room // 2] * MIX[1]
        context = scrambled(scrambled(context) + large[at + room] * MIX[2])
        text = np.searchsorted(offsets, begin + at, "right") - 1
        yield key, context, text, begin + at - offsets[text], number


def bytes_and_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string column and where each begins; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(
        0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def longs(*columns: np.ndarray) -> list[pa.Array]:
    return [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64))
            for c in columns]


def anchors(texts: DataFrame, window: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = bytes_and_offsets(batch.column("text"))
            doc, tag = (batch.column(c).to_numpy() for c in ("doc", "tag"))
            for key, context, text, start, number in anchors_of(data, offsets, window):
                yield pa.RecordBatch.from_arrays(
                    longs(key, context, doc[text], tag[text], start << 8 | number),
                    names=["key", "context", "doc", "tag", "place"])

    return texts.select("doc", "tag", "text").mapInArrow(scan, ANCHORS)


def whole_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def tag_of(docs: DataFrame) -> Column:
    """What tells rows of one id apart: nothing while ids are unique, else the text's hash."""
    repeated = docs.groupBy(whole_id().alias("doc")).agg(F.count("*").alias("n")).filter(
        "n > 1").limit(1).count()
    return F.xxhash64(whole_text()) if repeated else F.lit(0).cast("long")


def occurrence() -> Column:
    return F.struct("doc", "tag", "place")


def first_occurrences(found: DataFrame) -> DataFrame:
    """The earliest of each key's equal contexts; summed up before the shuffle."""
    return found.groupBy("key", "context").agg(F.min(occurrence()).alias("first"))


def repeats_of(found: DataFrame, first: DataFrame) -> DataFrame:
    return found.join(first, ["key", "context"]).filter(
        occurrence() > F.col("first")).select("doc", "tag", "place")


def contexts(wanted: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``wanted`` anchors with the bytes of their contexts."""
    asked = wanted.groupBy("doc", "tag").agg(
        F.collect_list(F.struct("key", "place", "many")).alias("asked"))  # within one text

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, tag, text, asked in zip(*(batch.column(c) for c in (
                    "doc", "tag", "text", "asked"))):
                data = text.as_py().encode()
                key, place, many = (asked.values.field(c) for c in ("key", "place", "many"))
                places = place.to_numpy()
                bytes_ = [data[p >> 8:(p >> 8) + (p & 255) + window - 1] for p in places.tolist()]
                n = len(places)
                yield pa.RecordBatch.from_arrays(
                    [key, pa.array(np.full(n, doc.as_py())), pa.array(np.full(n, tag.as_py())),
                     place, many, pa.array(bytes_, pa.binary())],
                    names=["key", "doc", "tag", "place", "many", "bytes"])

    return asked.join(texts.dropDuplicates(["doc", "tag"]) if repeated_rows(texts) else texts,
                      ["doc", "tag"]).select("doc", "tag", "text", "asked").mapInArrow(
        scan, "key long, doc long, tag long, place long, many boolean, bytes binary")


def repeated_rows(texts: DataFrame) -> bool:
    return bool(texts.groupBy("doc", "tag").agg(F.count("*").alias("n")).filter(
        "n > 1").limit(1).count())


def sorted_repeats(batch: pa.RecordBatch, window: int) -> np.ndarray:
    """Rows (row of the batch, place) of the window runs that occur earlier in their key."""
    key, doc, tag, place = (batch.column(c).to_numpy() for c in ("key", "doc", "tag", "place"))
    blobs = batch.column("bytes").to_pylist()
    sizes = np.array([len(b) for b in blobs])
    text = np.frombuffer(b"\0".join(blobs) + b"\0", np.uint8).astype(np.int64) + LOWEST
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    closing = begins[1:] - 1
    ends_string = np.append(key[1:] != key[:-1], True)
    text[closing] = np.where(ends_string, END, PART)
    ends = begins[1:][ends_string]
    starts = np.concatenate([[0], ends[:-1]])
    order = suffix_arrays(text, starts, ends)
    number = sizes - window + 1
    row = np.repeat(np.arange(len(sizes)), sizes + 1)
    inside = np.arange(len(text)) - begins[row]
    order = order[inside[order] < number[row[order]]]
    windows = np.lib.stride_tricks.sliding_window_view(text, window)
    same = np.zeros(len(order), bool)
    for at in range(1, len(order), 4096):
        part = order[at - 1:at + 4096]
        same[at:at + 4096] = (windows[part[1:]] == windows[part[:-1]]).all(axis=1)
    same[1:] &= key[row[order[1:]]] == key[row[order[:-1]]]
    group = np.cumsum(~same) - 1
    start = (place >> 8)[row[order]] + inside[order]
    by_place = np.lexsort((start, tag[row[order]], doc[row[order]], group))
    later = np.concatenate([[False], group[by_place][1:] == group[by_place][:-1]])
    at = np.sort(order[by_place[later]])
    if not len(at):
        return np.empty((0, 2), np.int64)
    cut = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]))  # texts are set apart
    run = np.diff(np.append(cut, len(at)))
    rows = row[at[cut]]
    return np.stack([rows, ((place[rows] >> 8) + inside[at[cut]]) << 8 | run], axis=1)


def sorted_apart(found: DataFrame, window: int) -> DataFrame:
    """Repeats among the different contexts of each key, by suffix arrays."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, ["key"], SORTED):
            rows, place = sorted_repeats(batch, window).T
            doc, tag = (batch.column(c).to_numpy()[rows] for c in ("doc", "tag"))
            yield pa.RecordBatch.from_arrays(longs(doc, tag, place),
                                             names=["doc", "tag", "place"])

    return found.select("key", "doc", "tag", "place", "bytes").repartition(
        partitions(found.sparkSession), "key").sortWithinPartitions(
        "key", "doc", "tag", "place").mapInArrow(scan, "doc long, tag long, place long")


def owner_places(data: np.ndarray, begins: np.ndarray, window: int) -> np.ndarray:
    """Place of the owner in each context; its first window has it like all others."""
    first = data[begins[:, None] + np.arange(window)].ravel()
    small = BYTES[first]
    size = 1
    while size < OWNER:
        small, size = doubled(small, size), size * 2
    # Hashes that begin in one window and end in the next are not looked at.
    small = np.append(small, np.zeros(OWNER - 1, np.uint64)).reshape(len(begins), window)
    return np.argmin(small[:, :window - OWNER + 1] >> np.uint64(32), axis=1)


def hashed(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each string of bytes."""
    at = spans(begins, sizes)
    inside = at - np.repeat(begins, sizes)
    mixed = scrambled((inside.astype(np.uint64) * MIX[2]) ^ BYTES[data[at]])
    return scrambled(np.add.reduceat(mixed, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))


def longer_by(window: int, owner: int) -> int:
    """Neighbouring places of the owner that make a part."""
    return -(-(window - owner + 1) // CUTS)


def longer_owners(found: DataFrame, window: int, owner: int) -> DataFrame:
    """The parts of the contexts by owners that reach further to the left and to the right.

    ``owner`` bytes are the owner's size; it lies at one of ``window - owner + 1`` places of a
    window, and ``step`` neighbouring ones make a part. Owners of the anchors themselves are
    looked up; those of parts are at ``at``.
    """
    step = longer_by(window, owner)
    size = window + 1 - step
    names = ["key", "context", "doc", "tag", "place", "at", "bytes"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key, doc, tag, place, at = (batch.column(c).to_numpy() for c in (
                "key", "doc", "tag", "place", "at"))
            blobs = batch.column("bytes").to_pylist()
            data = np.frombuffer(b"".join(blobs), np.uint8)
            sizes = np.array([len(b) for b in blobs])
            begins = np.cumsum(sizes) - sizes
            if owner == OWNER:
                at = owner_places(data, begins, window)
            number = sizes - window + 1
            for part in range(CUTS):
                skip = np.clip(at - (part + 1) * step + 1, 0, number)
                many = np.clip(at - part * step + 1, 0, number) - skip
                rows = np.flatnonzero(many)
                if not len(rows):
                    continue
                skip, many = skip[rows], many[rows]
                reach = at[rows] - min(part * step, size - owner)
                start, length = begins[rows] + skip, many + window - 1
                side = hashed(data, begins[rows] + reach, np.full(len(rows), size))
                context = hashed(data, start, length)
                first = (place[rows] >> 8) + skip
                yield pa.RecordBatch.from_arrays(
                    [*longs(scrambled(side ^ key[rows].view(np.uint64)), context, doc[rows],
                            tag[rows], first << 8 | many, reach - skip),
                     pa.array([data[a:b].tobytes() for a, b in zip(
                         start.tolist(), (start + length).tolist())], pa.binary())],
                    names=names)

    return found.select("key", "doc", "tag", "place", "at", "bytes").mapInArrow(
        scan, ANCHORS + ", at long, bytes binary")


def by_contexts(first: DataFrame, most: int) -> DataFrame:
    """The keys with several contexts, and whether they are ``many``."""
    return first.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(
        "key", (F.col("n") > most).alias("many"))


def repeated_runs(texts: DataFrame, window: int = WINDOW, most: int = MOST) -> DataFrame:
    """``doc``, ``tag``, ``place`` (start << 8 | number of windows) of windows seen earlier."""
    return alone(lambda: runs_of_repeats(texts, window, most), texts.sparkSession, "repeats")


def runs_of_repeats(texts: DataFrame, window: int, most: int) -> DataFrame:
    found = anchors(texts, window)
    shared = found.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    hits = settled(found.join(shared, "key", "left_semi"), "anchors")
    first = settled(first_occurrences(hits), "contexts")
    wanted = first.join(by_contexts(first, most), "key").select("key", "first.*", "many")
    held = settled(contexts(wanted, texts, window).withColumn("at", F.lit(0).cast("long")),
                   "bytes")
    seen = repeats_of(hits, first)
    owner = OWNER
    while True:
        seen = seen.unionByName(sorted_apart(held.filter("NOT many"), window))
        large = held.filter("many")
        if owner >= window or large.isEmpty():
            return seen
        parts = settled(longer_owners(large, window, owner), "parts")
        owner = window + 1 - longer_by(window, owner)
        first = settled(first_occurrences(parts), "contexts")
        seen = seen.unionByName(repeats_of(parts, first))
        held = settled(parts.join(first.join(by_contexts(first, most), "key").select(
            "key", "context", "first", "many"), ["key", "context"]).filter(
            occurrence() == F.col("first")).dropDuplicates(
            ["key", "context"]).drop("context", "first"), "bytes")


def merged(places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that the windows cover."""
    places = np.sort(places)
    starts = places >> 8
    ends = np.maximum.accumulate(starts + (places & 255) + window - 1)
    new = np.concatenate([[True], starts[1:] > ends[:-1]]) if len(places) else np.empty(0, bool)
    at = np.flatnonzero(new)
    return starts[at], ends[np.append(at[1:], len(places)) - 1] if len(at) else starts[at]


def cut_out(data: bytes, places: pa.Array | None, window: int) -> tuple[bytes, int]:
    """What is left of a text, and the number of removed runs."""
    if places is None:
        return data, 0
    starts, ends = merged(places.to_numpy(), window)
    edges = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])), len(starts)


def with_places(docs: DataFrame, columns: list[str], window: int, most: int) -> DataFrame:
    """``columns`` of the documents as ``_0``, ``_1``, ..., their text and ``places``."""
    rows = docs.select(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)),
                       whole_text().alias("text"), whole_id().alias("doc"),
                       tag_of(docs).alias("tag"))
    spans = repeated_runs(rows.select("doc", "tag", "text"), window, most).groupBy(
        "doc", "tag").agg(F.collect_list("place").alias("places"))  # within one text
    return rows.join(spans, ["doc", "tag"], "left").drop("doc", "tag")


def removed_bytes(docs: DataFrame, window: int = WINDOW, most: int = MOST) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, places in zip(batch.column("text"), batch.column("places")):
                data = text.as_py().encode()
                kept, number = cut_out(data, places.values, window)
                for column, value in zip(out, (len(data), len(data) - len(kept), number,
                                               hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_0"), *(pa.array(c, k) for c, k in zip(
                    out, (pa.int64(), pa.int64(), pa.int64(), pa.string())))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    plain = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    return with_places(plain, ["doc_id"], window, most).mapInArrow(
        scan, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW, most: int = MOST) -> DataFrame:
    """The documents with what is left of their texts; null texts stay null.

    A character that was cut in two goes as a whole; ``n_chars``, if there, is set anew.
    """
    others = [c for c in docs.columns if c != "text"]
    rows = with_places(docs, [*others, "text"], window, most)
    last = f"_{len(others)}"
    schema = T.StructType([*(T.StructField(f"_{i}", docs.schema[c].dataType)
                             for i, c in enumerate(others)),
                           T.StructField(last, T.StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [None if not known else cut_out(
                text.as_py().encode(), places.values, window)[0].decode(errors="ignore")
                for known, text, places in zip(batch.column(last).is_valid().to_pylist(),
                                               batch.column("text"), batch.column("places"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f"_{i}") for i in range(len(others))), pa.array(left, pa.string())],
                names=schema.names)

    named = {c: F.col(f"_{i}") for i, c in enumerate(others)} | {"text": F.col(last)}
    if "n_chars" in named:
        named["n_chars"] = F.length(last).cast(docs.schema["n_chars"].dataType)
    return rows.mapInArrow(scan, schema).select(*(named[c].alias(c) for c in docs.columns))
