"""Operator 9: language identification by a byte convolutional network.

Texts are cut into windows of ``WINDOW`` bytes that cover them whole. Filters of several
widths run over the bytes of a window; with one-hot bytes a filter is a table with a row
per byte value and place, so a response is a sum of looked-up rows. The largest response
of each filter goes to a softmax. A document's probabilities are the mean of its windows',
weighted by their bytes.

The network is trained in numpy on windows of at most ``TRAIN_ROWS`` labelled texts. Null
texts and texts without a letter are ``und`` with score 0, and so is everything if there
is no labelled text. Repeated rows get equal results; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalfed.llm.common import remainder
from tidalfed.llm.features import labelled_sample

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Bounds of what the network is trained on: texts, and windows of each.
TRAIN_ROWS = 3000
TRAIN_WINDOWS = 4
HOLD_OUT = (5, 0)
#: A document stays if its best language scores this much. Clean texts of the given tables score
#: 0.48 at least; a text in a language that was not learned may well score higher than that.
LEAST_SCORE = 0.4
#: One rule for fitting and predicting: Unicode category L.
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


@dataclass
class Network:
    """``tables[o]`` (256 x filters wider than ``o``): weights of the byte at place ``o``."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    top: np.ndarray
    top_bias: np.ndarray

    def responses(self, windows: np.ndarray) -> np.ndarray:
        """(windows, places, filters); the widest filters come first."""
        places = windows.shape[1] - len(self.tables) + 1
        out = self.tables[0][windows[:, :places]]
        for o, table in enumerate(self.tables[1:], 1):
            out[:, :, :table.shape[1]] += table[windows[:, o:o + places]]
        return out

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        return np.maximum(self.responses(windows).max(axis=1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return softmax(self.pooled(windows) @ self.top + self.top_bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(data: bytes, window: int = WINDOW, widest: int = max(WIDTHS)) -> np.ndarray:
    """Rows of ``window`` bytes and the first few of the next, padded with zero bytes."""
    number = max(1, -(-len(data) // window))
    padded = np.zeros(number * window + widest - 1, np.uint8)
    padded[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, window + widest - 1)[::window]


def new_network(languages: list[str], rng: np.random.Generator) -> Network:
    total = FILTERS * len(WIDTHS)
    tables = [rng.normal(0, 0.1, (256, FILTERS * sum(w > o for w in WIDTHS))).astype(np.float32)
              for o in range(max(WIDTHS))]
    for table in tables:
        table[0] = 0  # padding
    return Network(languages, tables, np.zeros(total, np.float32),
                   rng.normal(0, 0.3, (total, len(languages))).astype(np.float32),
                   np.zeros(len(languages), np.float32))


def train(windows: np.ndarray, targets: np.ndarray, languages: list[str], passes: int = 12,
          batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network:
    """Cross-entropy by Adam; only the place of each filter's maximum gets a gradient."""
    rng = np.random.default_rng(seed)
    net = new_network(languages, rng)
    parameters = [*net.tables, net.bias, net.top, net.top_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    steps = 0
    for _ in range(passes):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            x = windows[rows].copy()
            short = rng.random(len(rows)) < 0.5  # half of the windows are cut short
            keep = np.where(short, rng.integers(12, x.shape[1], len(rows)), x.shape[1])
            x[np.arange(x.shape[1]) >= keep[:, None]] = 0
            response = net.responses(x)
            where = response.argmax(axis=1)
            pooled = np.maximum(response.max(axis=1) + net.bias, 0)
            error = softmax(pooled @ net.top + net.top_bias)
            error[np.arange(len(rows)), targets[rows]] -= 1
            error /= len(rows)
            back = (error @ net.top.T) * (pooled > 0)
            gradients = []
            for o, table in enumerate(net.tables):
                gradient, filters = np.zeros_like(table), np.arange(table.shape[1])
                seen = x[np.arange(len(rows))[:, None], where[:, :table.shape[1]] + o]
                np.add.at(gradient, (seen, np.broadcast_to(filters, seen.shape)),
                          back[:, :table.shape[1]])
                gradient[0] = 0
                gradients.append(gradient)
            gradients += [back.sum(axis=0), pooled.T @ error, error.sum(axis=0)]
            steps += 1
            for p, g, (m, v) in zip(parameters, gradients, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** steps)) / (
                    np.sqrt(v / (1 - 0.999 ** steps)) + 1e-8)
    return net


def fit(sample: DataFrame) -> Network | None:
    """A network for the sampled texts' languages; None without any text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs, labels = [], []
            for text, label in zip(batch.column(0), batch.column(1)):
                data = text.as_py().encode("utf-8", "surrogatepass")
                cut = windows_of(data)
                for row in np.linspace(0, len(cut) - 1, TRAIN_WINDOWS).astype(int):
                    blobs.append(cut[row].tobytes())
                    labels.append(label.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()),
                                              pa.array(labels, pa.string())],
                                             names=["window", "label"])

    rows = sorted(set(map(tuple, sample.filter(F.col("_text").rlike(r"\p{L}")).mapInArrow(
        scan, "window binary, label string").collect())))  # bounded by rows x windows
    if not rows:
        return None
    languages = sorted({label for _, label in rows})
    windows = np.frombuffer(b"".join(bytes(w) for w, _ in rows), np.uint8)
    return train(windows.reshape(len(rows), -1),
                 np.array([languages.index(label) for _, label in rows]), languages)


def classified(net: Network | None, texts: list[str | None],
               block: int = 128) -> tuple[list[str], list[float]]:
    """Label and score of each text; windows go through the network in blocks."""
    known = [i for i, t in enumerate(texts) if net and t and LETTER.search(t)]
    labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    mass, weight = np.zeros((len(texts), len(net.languages) if net else 0)), {}
    held, owner, sizes = [], [], []

    def flush() -> None:
        found = net.probabilities(np.concatenate(held))
        np.add.at(mass, np.array(owner), found * np.array(sizes)[:, None])
        held.clear(), owner.clear(), sizes.clear()

    for i in known:
        data = texts[i].encode("utf-8", "surrogatepass")
        weight[i] = len(data)
        cut = windows_of(data)
        for at in range(0, len(cut), block):
            part = cut[at:at + block]
            held.append(part)
            owner += [i] * len(part)
            sizes += [min(WINDOW, len(data) - WINDOW * (at + k)) for k in range(len(part))]
            if len(owner) >= block:
                flush()
    if owner:
        flush()
    for i in known:
        best = int(mass[i].argmax())
        labels[i], scores[i] = net.languages[best], min(float(mass[i][best] / weight[i]), 1.0)
    return labels, scores


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred, score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = classified(shared.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        scan, "doc_id long, lang_pred string, score double")


def in_a_language(docs: DataFrame, net: Network | None,
                  least: float = LEAST_SCORE) -> DataFrame:
    """The documents, all columns as they are, whose language the network is sure enough of.

    Texts without a letter go, and those whose best language scores below ``least``. With
    nothing to learn from (``net`` is None) every text that has a letter stays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            if shared.value is None:
                keep = [bool(t and LETTER.search(t)) for t in texts]
            else:
                labels, scores = classified(shared.value, texts)
                keep = [x != UNKNOWN and p >= least for x, p in zip(labels, scores)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)


def train_on(docs: DataFrame, rows: int = TRAIN_ROWS) -> Network | None:
    modulus, held = HOLD_OUT
    usable = F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), modulus) != held)
    return fit(labelled_sample(docs, docs, F.col("lang"), usable, rows))


def languages(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    modulus, held = HOLD_OUT
    return predict(docs, train_on(docs, rows)).select(
        "doc_id", (remainder(F.col("doc_id"), modulus) == held).alias("held_out"),
        "lang_pred", "score")
