"""Language decoding and the quality classifier against plain loops over dictionaries."""

import math
import re
from collections import Counter

import numpy as np

from vetrail.llm import langid, quality


def _gram_counts(text: str) -> Counter:
    """Hashed byte n-grams of one text, a gram at a time."""
    folded = []
    for byte in text.encode():
        letter = 65 <= byte <= 90 or 97 <= byte <= 122
        folded.append(byte if byte >= 128 else (byte | 32) if letter else 32)
    out = Counter()
    for k in langid.ORDERS:
        for at in range(len(folded) - k + 1):
            code = k
            for byte in folded[at : at + k]:
                code = (code * 0x01000193 + byte) % 2**32
            code ^= code >> 15
            code = code * 0x2C1B3C6D % 2**32
            code ^= code >> 13
            out[code % langid.FEATURES] += 1
    return out


def _decode(model, text: str) -> tuple[str, float, float]:
    """Language, share and lead of the codeword with the least weighted loss, codeword by codeword."""
    counts = _gram_counts(text)
    total = sum(counts.values())
    margins = []
    for bit in range(model.code.shape[1]):
        dot = sum(math.sqrt(n / total) * float(model.weights[f, bit]) for f, n in counts.items())
        margins.append(dot + float(model.bias[bit]))
    losses = []
    for row in model.code.tolist():
        losses.append(sum(math.log1p(math.exp(-m * c)) * float(t) for m, c, t in zip(margins, row, model.trust)))
    shares = [math.exp(min(losses) - loss) for loss in losses]
    first, second = sorted(shares, reverse=True)[:2]
    best = losses.index(min(losses))
    return model.languages[best], shares[best] / sum(shares), (first - second) / sum(shares)


def test_language_decoding(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit_languages(documents)
    rows = langid.identify_languages(documents.select("doc_id", "text"), model).collect()
    assert len(rows) == documents.count()
    checked = 0
    for r in rows:
        text = r["text"] or ""
        if not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"], r["ambiguous"]) == ("und", 0.0, False)
        elif len(text) < 20_000:
            lang, share, lead = _decode(model, text)
            checked += 1
            assert abs(r["score"] - share) < 1e-3
            assert r["lang_pred"] == lang or lead < 1e-3
            assert r["ambiguous"] == (lead < langid.AMBIGUOUS) or abs(lead - langid.AMBIGUOUS) < 1e-3
    assert checked > 150


def _plain_ftrl(rows, alpha=0.3, beta=1.0, l1=0.02, l2=0.05, epochs=3):
    """The published per-coordinate update, with dictionaries; the bias is a coordinate without penalties."""
    z, n = {}, {}

    def weight(key):
        own = z.get(key, 0.0)
        lasso, ridge = (0.0, 0.0) if key == "bias" else (l1, l2)
        if abs(own) <= lasso:
            return 0.0
        return -(own - math.copysign(lasso, own)) / ((beta + math.sqrt(n.get(key, 0.0))) / alpha + ridge)

    for _ in range(epochs):
        for features, label in rows:
            features = features | {"bias": 1.0}
            w = {key: weight(key) for key in features}
            p = 1 / (1 + math.exp(-sum(w[key] * x for key, x in features.items())))
            for key, x in features.items():
                g, old = (p - label) * x, n.get(key, 0.0)
                z[key] = z.get(key, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w[key]
                n[key] = old + g * g
    return {key: weight(key) for key in z}


def test_quality_updates_and_scores(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id")
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    marked = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").orderBy("doc_id").collect()]
    rows, plain = [], []
    for doc, label in [(d, q) for d, q in marked if d in texts and q is not None][:120]:
        raw = np.frombuffer(texts[doc].encode(), np.uint8)
        idx, values = next(quality.ngram_features(raw, np.array([0, len(raw)])))
        rows.append((idx, values, label))
        plain.append((dict(zip(idx.tolist(), map(float, values.tolist()))), label))
    assert len(rows) > 30 and len({label for *_, label in rows}) == 2
    model, weights = quality.ftrl(rows), _plain_ftrl(plain)
    bias = weights.pop("bias")
    assert abs(model.bias - bias) < 1e-6
    assert all(abs(model.weights[key] - w) < 1e-5 for key, w in weights.items())
    assert set(np.flatnonzero(model.weights).tolist()) == {key for key, w in weights.items() if w}

    found = quality.score_quality(documents.select("doc_id", "text"), model).collect()
    for r in found:
        raw = np.frombuffer(texts[r["doc_id"]].encode(), np.uint8)
        idx, values = next(quality.ngram_features(raw, np.array([0, len(raw)])))
        margin = bias + sum(weights.get(int(i), 0.0) * float(x) for i, x in zip(idx, values))
        assert abs(r["score"] - 1 / (1 + math.exp(-margin))) < 1e-4
        assert r["predicted"] == (r["score"] >= 0.7)
    assert len(found) == len(texts)


def test_quality_features_of_words():
    """Shares of words and pairs of words, and of the pairs by how often they occur, counted with dictionaries."""
    text = "One two two, THREE 12ab été one two two, one two"
    words = re.findall(r"[A-Za-z\x80-\U0010ffff]+|[0-9]+|[^A-Za-z0-9\x80-\U0010ffff\t-\r ]+", text)
    pairs = Counter(zip(words, words[1:]))
    grams = sorted([*Counter(words).values(), *pairs.values()])
    raw = np.frombuffer(text.encode(), np.uint8)
    idx, values = next(quality.ngram_features(raw, np.array([0, len(raw)])))
    scale = 16 / (2 * len(words) - 1)
    hashed = idx < 1 << quality.BITS
    assert np.allclose(sorted(values[hashed]), [n * scale for n in grams])
    times = Counter(pairs.values())
    shares = {t: t * k / sum(pairs.values()) for t, k in times.items()}
    got = dict(zip((idx[~hashed] - (1 << quality.BITS) + 1).tolist(), values[~hashed].tolist()))
    assert got.keys() == shares.keys() and all(abs(got[t] - s) < 1e-6 for t, s in shares.items())
