"""Operator 11: SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by longest prefixes through the model's compiled character map; beside
every normalised byte stands the source byte it comes from, so each piece is projected back
to a span of source bytes. The normalised text is cut where no piece of the vocabulary can
reach across (before a run of space marks, around characters outside the vocabulary) and each
cut-out word is merged pair by pair, best score first, leftmost first among equals. Words are
remembered by the worker up to a limit. A character without a piece becomes its UTF-8 bytes,
each with the span of the whole character, or the unknown id in a model without byte pieces.

Decoding joins the surfaces of ids; runs of byte pieces are read as UTF-8, each byte that
fits nowhere becoming U+FFFD, and the space mark put before the text is taken off.

Null and empty texts have no ids and decode to the empty text. Repeated rows are encoded each.
An empty table gives an empty result. Only byte-pair models are read; others are an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalfed.llm.common import pieces_of

MODEL = "piece_bpe_32k.model"
SLICE_BYTES = 2_000_000

# Fixed values of the model format.
SPACE_MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BYTE_PAIR = 2

ENCODED = ("ids array<int>, begins array<int>, ends array<int>, decoded string")


class CharacterMap:
    """The compiled map: a double array of UTF-8 prefixes and the strings they turn into."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], dtype="<u4").tolist()
        self.strings = blob[4 + size:]
        first = "".join(re.escape(c) for c in self._first_characters()) if self.units else ""
        self.rule = re.compile(f"[{first}]") if first else None

    def _child(self, at: int, byte: int) -> tuple[int, int] | None:
        """(place of the children, unit) reached from ``at`` by one byte."""
        at ^= byte
        if at >= len(self.units):
            return None
        unit = self.units[at]
        if unit & 0x800000FF != byte:
            return None
        return at ^ self._offset(unit), unit

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _first_characters(self) -> list[str]:
        """Characters that some prefix begins with; all others stand for themselves."""
        found, open_ = [], [(b"", self._offset(self.units[0]))]
        while open_:
            head, at = open_.pop()
            for byte in range(256) if not head else range(0x80, 0xC0):
                child = self._child(at, byte)
                if child is None:
                    continue
                whole = head + bytes([byte])
                try:
                    found.append(whole.decode())
                except UnicodeDecodeError:
                    if len(whole) < 4:
                        open_.append((whole, child[0]))
        return found

    def longest(self, source: bytes, start: int) -> tuple[int, bytes] | None:
        """Length of the longest prefix found at ``start`` and what it turns into."""
        at, best = self._offset(self.units[0]), None
        for end in range(start, len(source)):
            child = self._child(at, source[end])
            if child is None:
                break
            at = child[0]
            if child[1] & 0x100:
                best = end + 1 - start, self.units[at] & 0x7FFFFFFF
        if best is None:
            return None
        return best[0], self.strings[best[1]:self.strings.index(b"\0", best[1])]


class Pieces:
    """A model: normalising, encoding and decoding. One per Python worker."""

    MOST, SHORT = 400_000, 100

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != BYTE_PAIR or any(
                p.type in (USER_DEFINED, UNUSED) for p in model.pieces):
            raise ValueError("only byte-pair models without user-defined pieces are read")
        spec = model.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.mark = SPACE_MARK.encode() if spec.escape_whitespaces else b" "
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces)
                         if p.type == BYTE}
        self.is_byte = np.array([p.type == BYTE for p in model.pieces])
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.surface = [
            "" if p.type == CONTROL else model.trainer_spec.unk_surface
            if p.type == UNKNOWN else p.piece.replace(SPACE_MARK, " ") for p in model.pieces]
        self.marked = [p.type == NORMAL and p.piece.startswith(SPACE_MARK) for p in model.pieces]
        self.word = self._words_between_cuts()
        self.codes = {p: np.array([i, n, n], "<i4").tobytes() for p, i in self.ids.items()
                      for n in [len(p.encode())]}
        self.words: dict[str, bytes] = {}

    def _words_between_cuts(self) -> re.Pattern:
        """Words that no merge can leave: characters outside the vocabulary stand alone, and a
        cut is made before a run of marks, or where letters meet others, unless a piece reaches
        across one."""
        mark = self.mark.decode()
        known = {c for piece in self.ids for c in piece} - {mark}
        letters = {c for c in known if c.isalpha()}
        every, some, rest = ("".join(sorted(map(re.escape, group)))
                             for group in (known, letters, known - letters))
        if any(mark in piece.lstrip(mark) for piece in self.ids):
            words = [f"[{every}{mark}]+"]
        elif any((a in letters) != (b in letters) for piece in self.ids
                 for a, b in pairwise(piece.lstrip(mark))):
            words = [f"{mark}*[{every}]+", f"{mark}+"]
        else:
            words = [*(f"{mark}*[{group}]+" for group in (some, rest) if group), f"{mark}+"]
        return re.compile("|".join([*words, f"[^{every}{mark}]"]))

    def normalised(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the source byte each comes from, with the end as last entry."""
        source = text.encode("utf-8", "surrogatepass")
        if not source:
            return b"", np.zeros(1, np.int64)
        chunks, origins = self._replaced(text, source)
        raw, origin = b"".join(chunks), np.concatenate(origins)
        here = np.frombuffer(raw, np.uint8)
        end = len(source)
        if self.squeeze:
            space = here == 0x20
            keep = ~space
            keep[1:] |= space[1:] & ~space[:-1]
            keep[:1] &= ~space[:1]
            kept = np.flatnonzero(keep)
            if len(kept) and space[kept[-1]]:
                end = int(origin[kept[-1]])
                kept = kept[:-1]
            if not len(kept):
                return b"", np.full(1, end)
            here, origin = here[kept], origin[kept]
        first, last = int(origin[0]) if len(origin) else 0, end
        marks = len(self.mark)
        times = np.where(here == 0x20, marks, 1)
        out = here.tobytes().replace(b" ", self.mark)
        align = np.repeat(origin, times)
        if self.prefix and not self.suffix:
            out, align = self.mark + out, np.concatenate([np.full(marks, first), align])
        while self.squeeze and out.endswith(self.mark):  # marks that stood in the text itself
            last, out, align = int(align[-marks]), out[:-marks], align[:-marks]
        if self.prefix and self.suffix:
            out, align = out + self.mark, np.concatenate([align, np.full(marks, last)])
        return out, np.append(align, last)

    def _replaced(self, text: str, source: bytes) -> tuple[list[bytes], list[np.ndarray]]:
        """Chunks after the map, each with the source byte of every byte."""
        if self.map.rule is None:
            return [source], [np.arange(len(source))]
        chunks, origins, done, place, before = [], [], 0, 0, 0
        for found in self.map.rule.finditer(text):
            place += len(text[before:found.start()].encode("utf-8", "surrogatepass"))
            before = found.start()
            if place < done:
                continue  # inside a longer prefix
            match = self.map.longest(source, place)
            if match is None:
                continue
            chunks += [source[done:place], match[1]]
            origins += [np.arange(done, place), np.full(len(match[1]), place)]
            done = place + match[0]
        return [*chunks, source[done:]], [*origins, np.arange(done, len(source))]

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and last source byte (exclusive) of each."""
        out, align = self.normalised(text)
        known, missing = self.words, self._remembered
        codes = np.frombuffer(b"".join([known.get(word) or missing(word) for word in
                                        self.word.findall(out.decode("utf-8", "surrogatepass"))]),
                              dtype="<i4").reshape(-1, 3)
        # The third entry is what a piece moves on by: nothing but for the last byte piece.
        ends = np.cumsum(codes[:, 2])
        begins = ends - codes[:, 2]
        return codes[:, 0], align[begins], align[begins + codes[:, 1]]

    def _remembered(self, word: str) -> bytes:
        """Rows (id, bytes of its span, bytes to move on by) of a word's pieces."""
        if len(self.words) > self.MOST:
            self.words.clear()
        parts = self.merged(word) if len(word) <= self.SHORT else self.merged_long(word)
        codes = self.codes
        code = b"".join([codes.get(part) or self._without_piece(part) for part in parts])
        if len(word) <= self.SHORT:
            self.words[word] = code
        return code

    def _without_piece(self, character: str) -> bytes:
        """Byte pieces share the character's span: all but the last move on by nothing."""
        data = character.encode("utf-8", "surrogatepass")
        size = len(data)
        ids = [self.byte_ids[b] for b in data] if self.byte_ids else [self.unknown]
        return np.array([(i, size, 0) for i in ids[:-1]] + [(ids[-1], size, size)],
                        "<i4").tobytes()

    def merged(self, word: str) -> list[str]:
        """Pieces of a word: neighbours that form a piece are joined, best score first."""
        score, none = self.scores.get, -np.inf
        parts = list(word)
        gains = [score(a + b, none) for a, b in pairwise(parts)]
        while gains:
            best = max(gains)
            if best == none:
                break
            i = gains.index(best)  # the leftmost
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del gains[i]
            if i < len(gains):
                gains[i] = score(parts[i] + parts[i + 1], none)
            if i:
                gains[i - 1] = score(parts[i - 1] + parts[i], none)
        return parts

    def merged_long(self, word: str) -> list[str]:
        """The same with a heap, for words of any length."""
        scores, parts = self.scores, list(word)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(-scores[a + b], i, a + b) for i, (a, b) in enumerate(pairwise(parts))
                if a + b in scores]
        heapify(heap)
        while heap:
            _, i, piece = heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or parts[j] is None or parts[i] + parts[j] != piece:
                continue
            parts[i], parts[j] = piece, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                joined = piece + parts[k]
                if joined in scores:
                    heappush(heap, (-scores[joined], i, joined))
            k = before[i]
            if k >= 0:
                joined = parts[k] + piece
                if joined in scores:
                    heappush(heap, (-scores[joined], k, joined))
        return [part for part in parts if part is not None]

    def decoded(self, ids: np.ndarray) -> str:
        """The text of any sequence of ids."""
        surface, places = self.surface, np.flatnonzero(self.is_byte[ids])
        if not len(places):
            return self._unprefixed("".join([surface[i] for i in ids.tolist()]), ids)
        out, done = [], 0
        runs = np.split(places, np.flatnonzero(np.diff(places) > 1) + 1)
        for run in runs:
            out += [surface[i] for i in ids[done:run[0]].tolist()]
            out.append(read_bytes(bytes(self.byte_of[i] for i in ids[run].tolist())))
            done = int(run[-1]) + 1
        out += [surface[i] for i in ids[done:].tolist()]
        return self._unprefixed("".join(out), ids)

    def _unprefixed(self, text: str, ids: np.ndarray) -> str:
        """Without the mark put before the text; where spaces are squeezed, without the first
        mark of every piece up to the first that leaves anything."""
        if not (self.prefix or self.squeeze) or not text.startswith(" "):
            return text
        cut = 0
        for i in ids.tolist():
            if not self.surface[i]:
                continue
            if not self.marked[i]:
                break
            cut += 1
            if not self.squeeze or self.surface[i] != " ":
                break
        return text[cut:]


def read_bytes(data: bytes) -> str:
    """UTF-8, with U+FFFD for each byte that is part of no character."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[at:at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    """One model and memory of words per Python worker, kept from task to task."""
    return Pieces(path)


def encoded(docs: DataFrame, model_path: str, key: str = "doc_id",
            column: str = "text") -> DataFrame:
    """``key``, ids, begins, ends (source bytes of each piece) and decoded, row by row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        empty = np.zeros(0, np.int32)
        for batch in batches:
            for start, end in pieces_of(batch, 1, SLICE_BYTES):
                part = batch.slice(start, end - start)
                found, texts = [], []
                for text in part.column(1):
                    text = text.as_py()
                    found.append(model.encoded(text) if text else (empty, empty, empty))
                    texts.append(model.decoded(found[-1][0]))
                offsets = np.cumsum([0, *(len(f[0]) for f in found)]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(
                    pa.array(offsets),
                    pa.array(np.concatenate([f[i] for f in found]).astype(np.int32)))
                    for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *lists, pa.array(texts, pa.string())],
                    names=[batch.schema.names[0], "ids", "begins", "ends", "decoded"])

    rows = docs.select(F.col(key), F.col(column).cast("string").alias("_text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(encode, f"`{key}` {kind}, {ENCODED}")


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return encoded(docs, model_path).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
