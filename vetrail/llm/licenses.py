"""License scans: templates found in documents by MinHash bands, verified by exact shingle containment.

Words lose punctuation at their edges, so quotes, full stops and the marks of comments do not hide a template. A
document's shingle positions are cut into overlapping windows of ``2 * size`` shingles, ``size`` apart, for each
size class of templates; so a template of up to ``size`` shingles lies whole in one window. Classes are a factor of
1.5 apart, so a window that holds 80 % of a template has a Jaccard likeness of 0.25 or more to it. A band is one
MinHash value; with 64 bands such a window is missed with probability 0.75**64 = 1e-8. Windows that share no shingle with any
template cannot collide in a band and are not hashed. Windows that collide are verified exactly.

The index of templates is told to the tasks in turns of a bounded number of bytes, as sorted arrays of band keys.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrail.llm.common import SHINGLE_WORDS, bounded_batches, buffers, gram_hashes, mix, text_blocks, word_hashes

BANDS = 64
CONTAINMENT = 0.8
#: Bytes of templates, texts and band keys, told to every task at once; more are scanned for in turns.
TEMPLATE_BYTES = 32 << 20
_ROW_BYTES = 2048
_CHUNK = 8192

#: Verbs and names by which notices state a license.
VERBS = ("available", "distributed", "licensed", "released")
LICENSE_NAMES = {
    "agpl-3.0": "the GNU Affero General Public License, version 3",
    "apache-2.0": "the Apache License, Version 2.0",
    "bsd-2-clause": "the BSD 2-Clause License",
    "bsd-3-clause": "the BSD 3-Clause License",
    "cc-by-4.0": "CC BY 4.0",
    "cc-by-nc-4.0": "CC BY-NC 4.0",
    "cc-by-sa-4.0": "CC BY-SA 4.0",
    "gpl-2.0": "the GNU General Public License, version 2",
    "gpl-3.0": "the GNU General Public License, version 3",
    "isc": "the ISC License",
    "lgpl-2.1": "the GNU Lesser General Public License, version 2.1",
    "lgpl-3.0": "the GNU Lesser General Public License, version 3",
    "mit": "the MIT License",
    "mpl-2.0": "the Mozilla Public License, version 2.0",
}
#: Bodies of short licenses, and the headers by which files name long ones: one file per license.
TEXTS = Path(__file__).with_name("license_texts")

_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
_BAND_KEYS = mix(np.arange(1001, BANDS + 1001, dtype=np.uint64))
_MARK = np.isin(np.arange(256), list(string.punctuation.encode()))
_GAP = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def license_templates(spark: SparkSession) -> DataFrame:
    """(template_id, template): ``<license>/text`` for bodies and headers, ``<license>/<verb>`` for notices."""
    rows = [(f"{path.stem}/text", path.read_text("utf-8")) for path in TEXTS.glob("*.txt")]
    rows += [(f"{key}/{verb}", f"{verb} under {name}") for key, name in LICENSE_NAMES.items() for verb in VERBS]
    return spark.createDataFrame(sorted(rows), "template_id string, template string")


def _bare(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The bytes of a block with blanks for punctuation (ASCII, curly quotes) at the edges of words."""
    if not len(raw):
        return raw
    mark = _MARK[raw]
    quote = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x80) & (raw[2:] >= 0x98) & (raw[2:] <= 0x9F))
    for k in range(3):
        mark[quote + k] = True
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    starts, ends = mark.copy(), mark.copy()
    starts[1:] &= ~mark[:-1] | edge[1:-1]
    ends[:-1] &= ~mark[1:] | edge[1:-1]
    begin, stop = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    gap = _GAP[raw]
    outer = edge[begin] | gap[begin - 1] | edge[stop] | gap[np.minimum(stop, len(raw) - 1)]
    step = np.zeros(len(raw) + 1, np.int8)
    step[begin[outer]] += 1
    step[stop[outer]] -= 1
    out = raw.copy()
    out[np.cumsum(step[:-1], dtype=np.int8) > 0] = 32
    return out


def _class_size(n: int) -> int:
    size = 1
    while size < n:
        size = max(size + 1, int(size * 1.5))
    return size


def _keys(tokens: np.ndarray) -> np.ndarray:
    """A key per band: the MinHash value of the shingles, told apart by band."""
    low = np.full(BANDS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(tokens), _CHUNK):
        np.minimum(low, mix(tokens[k : k + _CHUNK, None] ^ _SEEDS).min(axis=0), out=low)
    return mix(low ^ _BAND_KEYS)


@dataclass
class TemplateIndex:
    names: list[str]
    shingles: list[np.ndarray]
    known: np.ndarray
    #: Per size class: sorted band keys, and the template of each.
    bands: dict[int, tuple[np.ndarray, np.ndarray]]


def template_index(names: list[str], texts: list[str]) -> TemplateIndex:
    """Templates without words are left out."""
    raw, at = buffers(pa.array(texts, pa.large_string()))
    words, first = word_hashes(_bare(raw, at), at)
    kept_names, shingles, classes = [], [], defaultdict(list)
    for name, a, b in zip(names, first[:-1].tolist(), first[1:].tolist()):
        if b > a:
            classes[_class_size(len(own := _grams(words[a:b])))].append(len(shingles))
            kept_names.append(name)
            shingles.append(own)
    bands = {}
    for size, members in classes.items():
        keys = np.concatenate([_keys(shingles[t]) for t in members])
        order = np.argsort(keys, kind="stable")
        bands[size] = keys[order], np.repeat(np.array(members, np.int32), BANDS)[order]
    known = np.unique(np.concatenate(shingles)) if shingles else np.zeros(0, np.uint64)
    return TemplateIndex(kept_names, shingles, known, bands)


def _grams(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles; fewer than five words are one."""
    return np.unique(gram_hashes(words, min(len(words), SHINGLE_WORDS)))


def _near(bands: tuple[np.ndarray, np.ndarray], tokens: np.ndarray) -> list[int]:
    """Templates that share a band key with the shingles."""
    keys, templates = bands
    asked = _keys(tokens)
    low, high = np.searchsorted(keys, asked, "left"), np.searchsorted(keys, asked, "right")
    hits = [templates[a:b] for a, b in zip(low[low < high].tolist(), high[low < high].tolist())]
    return np.unique(np.concatenate(hits)).tolist() if hits else []


def _matches(index: TemplateIndex, tokens: np.ndarray, hit: np.ndarray, least: float) -> dict[int, list]:
    """Template -> [best containment, its window's first word, number of windows] for one document."""
    found: dict[int, list] = {}
    for size, bands in index.bands.items():
        windows = np.unique(np.concatenate([hit // size, hit // size - 1]))
        for k in windows[windows >= 0].tolist():
            part = np.unique(tokens[k * size : (k + 2) * size])
            for t in _near(bands, part):
                own = index.shingles[t]
                share = len(np.intersect1d(own, part, assume_unique=True)) / len(own)
                if share >= least:
                    best = found.setdefault(t, [0.0, 0, 0])
                    if share > best[0]:
                        best[0], best[1] = share, k * size
                    best[2] += 1
    return found


def scan_templates(
    documents: DataFrame,
    templates: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    template_id: str = "template_id",
    template_text: str = "template",
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Per document and template it holds: id, template_id, containment, first_word, n_windows.

    ``containment`` is the largest share of the template's shingles found in one window, which starts at word
    ``first_word`` (the first such window on ties); ``n_windows`` counts all windows that reach the limit. Templates
    that share most of their text are each reported, the one that is there with the highest containment. Null and empty texts and
    templates match nothing, as do those of punctuation alone. A text or template of fewer than five words is
    one shingle. Repeated rows are scanned each. An empty table on either side gives an empty result. Other
    columns are not read. A template of over ``TEMPLATE_BYTES`` is a turn of its own.
    """
    spark = bounded_batches(documents)
    kind = documents.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, template_id string, containment double, first_word long, n_windows long"
    rows = templates.select(F.col(template_id).cast("string").alias("id"), F.col(template_text).alias("text"))
    out = None
    for part in _turns(rows):
        told = part.orderBy("id", "text").collect()  # at most TEMPLATE_BYTES
        shared = spark.sparkContext.broadcast(template_index([r[0] for r in told], [r[1] or "" for r in told]))
        found = documents.select(id_column, text).mapInArrow(_scan(shared, id_column, text, containment), schema)
        out = found if out is None else out.union(found)
    return out


def _turns(rows: DataFrame) -> list[DataFrame]:
    """Cut a table of (id, text) into parts of ``TEMPLATE_BYTES`` by measured sums of hash buckets."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + _ROW_BYTES
    total = rows.agg(F.sum(size)).first()[0] or 0
    if total <= TEMPLATE_BYTES:
        return [rows]
    buckets = 8 * -(-total // TEMPLATE_BYTES)
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64("id", "text"), F.lit(buckets)))
    sums = dealt.groupBy("_bucket").agg(F.sum(size).alias("bytes")).orderBy("_bucket").collect()
    starts, held = [0], 0
    for bucket, n in sums:
        if held and held + n > TEMPLATE_BYTES:
            starts.append(bucket)
            held = 0
        held += n
    ends = [*starts[1:], buckets]
    return [dealt.filter((F.col("_bucket") >= a) & (F.col("_bucket") < b)).drop("_bucket") for a, b in zip(starts, ends)]


def _scan(shared, id_column: str, text: str, containment: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for rows, raw, at in text_blocks(batches, text):
            words, first = word_hashes(_bare(raw, at), at)
            grams = gram_hashes(words, SHINGLE_WORDS)
            spot = np.minimum(np.searchsorted(index.known, grams), max(len(index.known) - 1, 0))
            known = np.flatnonzero(index.known[spot] == grams) if len(index.known) and len(grams) else spot[:0]
            which, names, share, start, count = [], [], [], [], []
            for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                if b - a >= SHINGLE_WORDS:
                    hit = known[np.searchsorted(known, a) : np.searchsorted(known, b - SHINGLE_WORDS + 1)] - a
                    tokens = grams[a : b - SHINGLE_WORDS + 1]
                else:
                    tokens = gram_hashes(words[a:b], b - a) if b > a else grams[:0]
                    hit = np.flatnonzero(np.isin(tokens, index.known))
                if not len(hit):
                    continue
                for t, (most, at_word, n) in sorted(_matches(index, tokens, hit, containment).items()):
                    which.append(k)
                    names.append(index.names[t])
                    share.append(most)
                    start.append(at_word)
                    count.append(n)
            key = rows.column(rows.schema.get_field_index(id_column)).take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    key,
                    pa.array(names, pa.string()),
                    pa.array(share, pa.float64()),
                    pa.array(start, pa.int64()),
                    pa.array(count, pa.int64()),
                ],
                names=[id_column, "template_id", "containment", "first_word", "n_windows"],
            )

    return run
