"""A quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal.

Words here are runs of letters, of digits or of other signs, case kept. Their 1- and 2-grams are hashed;
a feature's value is its share of the text's n-grams. How often a text repeats its own 2-grams is a
feature too: the shares of 2-grams that occur once, twice, and so on. A score is the logistic function
of a sparse dot product.

The weights are fitted on a bounded sample of labelled rows (``max_rows``), one row after another, each
coordinate with its own step size; the L1 part leaves most weights at zero. Everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrail.llm.common import bounded_batches, gram_hashes, span_hashes, text_blocks

MAX_ROWS = 6000
BITS = 18
THRESHOLD = 0.7
_SCALE = np.float32(16.0)
_REPEATS = 8

_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1
_CLASS[48:58] = 2


def ngram_features(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text (indices, values), indices distinct and ascending; an empty text has none."""
    kind = _CLASS[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    if len(raw):
        edge[1:-1] |= kind[1:] != kind[:-1]
    cuts = np.flatnonzero(edge)
    begin, stop = cuts[:-1], cuts[1:]
    solid = kind[begin] != 0
    begin, stop = begin[solid], stop[solid]
    words = span_hashes(raw, begin, stop)
    first = np.searchsorted(begin, at)
    pairs = gram_hashes(words, 2)
    mask = np.uint64((1 << BITS) - 1)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if a == b:
            yield np.zeros(0, np.int32), np.zeros(0, np.float32)
            continue
        own = pairs[a : b - 1]
        idx, counts = np.unique(np.concatenate([words[a:b], own]) & mask, return_counts=True)
        values = counts.astype(np.float32) * (_SCALE / (2 * (b - a) - 1))
        at_end, share = [], []
        if len(own):
            times = np.minimum(np.unique(own, return_counts=True)[1], _REPEATS)
            held = np.bincount(times, weights=times, minlength=_REPEATS + 1)[1:]
            at_end = np.flatnonzero(held)
            share = held[at_end] / held.sum()
        yield (
            np.concatenate([idx.astype(np.int32), (1 << BITS) + np.asarray(at_end, np.int32)]),
            np.concatenate([values, np.asarray(share, np.float32)]),
        )


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float

    def score(self, idx: np.ndarray, values: np.ndarray) -> float:
        margin = float(self.weights[idx] @ values) + self.bias if len(idx) else self.bias
        return 1.0 / (1.0 + float(np.exp(-np.clip(margin, -30, 30))))


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.05,
    epochs: int = 3,
) -> QualityModel:
    """Follow the regularised leader: a row at a time, in the given order."""
    size = (1 << BITS) + _REPEATS + 1
    z, n = np.zeros(size), np.zeros(size)
    bias_z = bias_n = 0.0
    for _ in range(epochs):
        for idx, values, label in rows:
            own_z, own_n = z[idx], n[idx]
            w = -(own_z - np.sign(own_z) * l1) / ((beta + np.sqrt(own_n)) / alpha + l2)
            w[np.abs(own_z) <= l1] = 0
            bias = -bias_z / ((beta + np.sqrt(bias_n)) / alpha)
            p = 1 / (1 + np.exp(-np.clip(w @ values + bias, -30, 30)))
            g = (p - label) * values
            z[idx] = own_z + g - (np.sqrt(own_n + g * g) - np.sqrt(own_n)) / alpha * w
            n[idx] = own_n + g * g
            g = p - label
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * bias
            bias_n += g * g
    w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
    w[np.abs(z) <= l1] = 0
    return QualityModel(w.astype(np.float32), float(-bias_z / ((beta + np.sqrt(bias_n)) / alpha)))


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = MAX_ROWS,
) -> QualityModel:
    """Fit on at most about ``max_rows`` labelled rows, picked by a hash of the id, whole texts.

    Rows with a null label or id are left out; a label repeated for an id counts once, the largest. Without
    a labelled row every score is 0.5.
    """
    bounded_batches(documents)
    marked = labels.groupBy(id_column).agg(F.max(label).alias("_label")).filter(F.col("_label").isNotNull())
    total = labels.filter(F.col(label).isNotNull()).count()
    place = F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit("quality")), F.lit(1 << 30)) / (1 << 30)
    # At most about max_rows ids.
    picked = marked.filter(place < max_rows / max(total, 1))
    sample = documents.select(id_column, text).join(F.broadcast(picked), id_column)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, at in text_blocks(batches, text):
            idx, values = zip(*ngram_features(raw, at))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index(id_column)).cast(pa.string()),
                    part.column(part.schema.get_field_index("_label")).cast(pa.int32()),
                    pa.array([i.tobytes() for i in idx], pa.binary()),
                    pa.array([v.tobytes() for v in values], pa.binary()),
                ],
                names=["id", "label", "at", "value"],
            )

    found = sample.mapInArrow(features, "id string, label int, at binary, value binary").toPandas()
    found = found.assign(order=[crc32(i.encode()) for i in found["id"]])
    found = found.sort_values(["order", "id"], kind="stable")
    return ftrl(
        [
            (np.frombuffer(i, np.int32), np.frombuffer(v, np.float32), int(y > 0))
            for i, v, y in zip(found["at"], found["value"], found["label"])
        ]
    )


def score_quality(
    documents: DataFrame, model: QualityModel, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 if the score reaches the threshold) to every row.

    Only the text is read. Null and empty texts get the score of the bias alone. Columns of those two
    names are replaced; all others are kept.
    """
    kept = [c for c in documents.columns if c not in ("score", "predicted")]
    schema = documents.select(*kept).schema.add("score", "double").add("predicted", "integer")
    shared = bounded_batches(documents).sparkContext.broadcast(model)  # 2^18 weights

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for part, raw, at in text_blocks(batches, text):
            score = np.array([fitted.score(i, v) for i, v in ngram_features(raw, at)])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))],
                names=[*part.schema.names, "score", "predicted"],
            )

    return documents.select(*kept).mapInArrow(predict, schema)
