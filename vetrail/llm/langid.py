"""Language identification with error-correcting output codes.

Each language has a codeword of bits. One binary classifier per bit, logistic regression over hashed
byte n-grams, predicts that bit; the language is the codeword with the least loss, bits weighted by how
well their classifier does. A text whose two best codewords lose nearly the same is flagged ambiguous.

The classifiers are fitted on a bounded sample: about ``rows_per_language`` labelled rows of each
language, picked by a hash, whole texts. Everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrail.llm.common import bounded_batches, text_blocks

ROWS_PER_LANGUAGE = 400
FEATURES = 1 << 13
ORDERS = (1, 2, 3)
UNKNOWN = "und"
#: Below this difference of the two best codewords' shares a text is ambiguous.
AMBIGUOUS = 0.05

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)]] = 32


def gram_counts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per text (row) its counts of hashed byte n-grams, ASCII letters folded, other ASCII a space."""
    n = len(at) - 1
    out = np.zeros(n * FEATURES, np.float32)
    folded = _FOLD[raw].astype(np.uint32)
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(at)) * FEATURES
    end = np.repeat(at[1:], np.diff(at))
    for k in ORDERS:
        m = len(folded) - k + 1
        if m <= 0:
            continue
        code = np.full(m, k, np.uint32)
        for j in range(k):
            code = code * np.uint32(0x01000193) + folded[j : m + j]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        code ^= code >> np.uint32(13)
        inside = np.arange(k, m + k) <= end[:m]
        out += np.bincount(
            (row[:m] + (code & np.uint32(FEATURES - 1)))[inside], minlength=n * FEATURES
        ).astype(np.float32)
    return out.reshape(n, FEATURES)


def _scaled(counts: np.ndarray) -> np.ndarray:
    """Square roots of shares: unit length, whatever the length of the text."""
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def codewords(classes: int, seed: int = 7, tries: int = 300) -> np.ndarray:
    """Classes x bits of +1 and -1: of many random codes the one whose rows differ most.

    Every bit splits the classes and no two bits split them alike while there are enough splits.
    """
    if classes < 2:
        return np.ones((classes, 1), np.int8)
    splits = 2 ** (classes - 1) - 1 if classes < 16 else 1 << 15
    bits = min(splits, max(7, int(np.ceil(10 * np.log2(classes)))))
    random, best, distance = np.random.default_rng(seed), None, -1
    for _ in range(tries):
        seen: dict[bytes, np.ndarray] = {}
        while len(seen) < bits:
            bit = random.choice(np.array([-1, 1], np.int8), classes)
            if abs(int(bit.sum())) < classes:
                bit = bit * bit[0]
                seen[bit.tobytes()] = bit
        code = np.stack(list(seen.values()), axis=1)
        least = min(
            int((code[i] != code[j]).sum()) for i in range(classes) for j in range(i + 1, classes)
        )
        if least > distance:
            best, distance = code, least
        if len(seen) == splits:
            break
    return best


@dataclass
class LanguageModel:
    """Languages, their codewords, the bits' linear classifiers and weights."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def shares(self, counts: np.ndarray) -> np.ndarray:
        """Per text the share of each language: loss-weighted decoding, as a softmax."""
        margin = _scaled(counts) @ self.weights + self.bias
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None]) * self.trust
        least = -loss.sum(axis=2)
        share = np.exp(least - least.max(axis=1, keepdims=True))
        return share / share.sum(axis=1, keepdims=True)


def _fit(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 150) -> LanguageModel:
    """All bits at once: accelerated gradient descent on the logistic loss, classes weighted equally."""
    code = codewords(len(languages))
    target = code[y].astype(np.float32)
    x = _scaled(x)
    row_weight = 1.0 / (np.bincount(y, minlength=len(languages))[y] * len(languages))
    row_weight = row_weight.astype(np.float32)[:, None]
    w = np.zeros((x.shape[1], code.shape[1]), np.float32)
    b = np.zeros(code.shape[1], np.float32)
    rate, penalty, old_w, old_b = 4.0, 1e-5, w, b
    for t in range(steps):
        pull = t / (t + 3)
        at_w, at_b = w + pull * (w - old_w), b + pull * (b - old_b)
        slope = -target * row_weight / (1 + np.exp(np.clip(target * (x @ at_w + at_b), -30, 30)))
        old_w, old_b = w, b
        w = at_w - rate * (x.T @ slope + penalty * at_w)
        b = at_b - rate * slope.sum(axis=0)
    right = (np.sign(x @ w + b) == target).mean(axis=0)
    trust = np.clip(right, 0.5, 0.999)
    trust = np.log(trust / (1 - trust))
    trust = trust / max(trust.mean(), 1e-9)
    return LanguageModel(languages, code, w, b, trust.astype(np.float32))


def fit_languages(
    labelled: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> LanguageModel:
    """Fit on about ``rows_per_language`` rows of each language; rows without text or label are left out.

    Without any labelled row the model knows no language and every prediction is ``und``.
    """
    bounded_batches(labelled)
    known = labelled.select(id_column, text, lang).filter(
        F.col(lang).isNotNull() & has_letter(F.col(text))
    )
    # One row per language.
    rows = known.groupBy(lang).agg(F.count("*").alias("_n"))
    place = F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit("lang")), F.lit(1 << 30)) / (1 << 30)
    sample = known.join(F.broadcast(rows), lang).filter(place < rows_per_language / F.col("_n"))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, at in text_blocks(batches, text, 1 << 18):
            dense = gram_counts(raw, at)
            idx = [np.flatnonzero(r).astype(np.int32) for r in dense]
            counted = [r[i].tobytes() for r, i in zip(dense, idx)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index(lang)).cast(pa.string()),
                    pa.array([i.tobytes() for i in idx], pa.binary()),
                    pa.array(counted, pa.binary()),
                ],
                names=["lang", "at", "n"],
            )

    # The bounded sample's gram counts, not its texts, go to the driver.
    found = sample.select(text, lang).mapInArrow(counts, "lang string, at binary, n binary")
    found = found.toPandas().sort_values(["lang", "at", "n"], kind="stable")
    languages = sorted(found["lang"].unique())
    x = np.zeros((len(found), FEATURES), np.float32)
    for k, (i, n) in enumerate(zip(found["at"], found["n"])):
        x[k, np.frombuffer(i, np.int32)] = np.frombuffer(n, np.float32)
    y = np.searchsorted(np.array(languages, object), found["lang"].to_numpy()) if languages else np.zeros(0, int)
    if not languages:
        return LanguageModel([], np.ones((0, 1), np.int8), x.T[:, :0], np.zeros(0), np.zeros(0))
    return _fit(x, y, languages)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify_languages(
    documents: DataFrame, model: LanguageModel, text: str = "text", ambiguous: float = AMBIGUOUS
) -> DataFrame:
    """Add ``lang_pred``, ``score`` (share of the best codeword) and ``ambiguous`` to every row.

    Null, empty and letterless texts are ``und`` with score 0, not ambiguous. Only the text is read for the
    prediction, so equal texts get equal results. Ties go to the first language in code point order.
    Columns of those three names are replaced, one named ``_letters`` is dropped; all others are kept.
    """
    kept = [c for c in documents.columns if c not in ("lang_pred", "score", "ambiguous", "_letters")]
    rows = documents.select(*kept, has_letter(F.col(text)).alias("_letters"))
    schema = documents.select(*kept).schema
    schema = schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    shared = bounded_batches(documents).sparkContext.broadcast(model)  # features x bits

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        names = np.array([*fitted.languages, UNKNOWN], object)
        for part, raw, at in text_blocks(batches, text, 1 << 18):
            letters = part.column(part.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            n = part.num_rows
            best, score, close = np.full(n, len(names) - 1), np.zeros(n), np.zeros(n, bool)
            if len(fitted.languages) == 1:
                best[letters], score[letters] = 0, 1.0
            elif fitted.languages and letters.any():
                for s in range(0, n, 128):
                    e = min(s + 128, n)
                    share = fitted.shares(gram_counts(raw[at[s] : at[e]], at[s : e + 1] - at[s]))
                    own = letters[s:e]
                    top = share.argmax(axis=1)
                    two = np.partition(share, -2, axis=1)[:, -2]
                    high = share.max(axis=1)
                    best[s:e] = np.where(own, top, len(names) - 1)
                    score[s:e] = np.where(own, np.clip(high, 0, 1), 0.0)
                    close[s:e] = own & (high - two < ambiguous)
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:-1],
                    pa.array(names[best], pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(close, pa.bool_()),
                ],
                names=[*part.schema.names[:-1], "lang_pred", "score", "ambiguous"],
            )

    return rows.mapInArrow(predict, schema)
