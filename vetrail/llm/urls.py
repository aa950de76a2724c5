"""URL filters: a sorted array of 64-bit digests, memory-mapped and probed by binary search.

Rules are (host, path, verdict). A rule fits its host and all subdomains of it, for paths that start with the
rule's path; the longest fitting rule decides, and urls that no rule fits get a default verdict.

Spark digests the rules (xxHash64), deals them by digest ranges and sorts them; the task of a range writes one
file: the digests, where each one's string and value end, the strings, the values. There are two kinds of strings:
a host alone, whose value is the lengths of its rules' paths, and ``host/path`` for a rule, whose value
is its verdict. Hosts hold no ``/``, so the kinds never meet. A task maps the files into memory and probes all
domains above its urls' hosts at once, then only the path beginnings of lengths that a found host has
rules for. Every digest found is confirmed on the full stored string, so a collision never decides.

Probing shuffles nothing, and its work follows the urls; the rules' files may be larger than memory.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetrail.llm.common import bounded_batches, shared_store
from vetrail.session import fresh_folder

#: Entries of one file; the task that writes a file holds it in memory.
PART_ENTRIES = 500_000
#: Files kept in memory at a time where the store can't be memory-mapped.
OPEN_PARTS = 4
_SEED = 42  # of Spark's xxhash64
_VERDICTS = ("allow", "block")


def url_host(url: str | Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(_raw_host(url), ascii_uppercase, ascii_lowercase)


def url_path(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = _after_scheme(url)
    return F.regexp_extract(F.substring(rest, F.length(_raw_host(url)) + 1, F.length(rest)), r"^[^?#]*", 0)


def _after_scheme(url: str | Column) -> Column:
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _raw_host(url: str | Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)


@dataclass(frozen=True)
class Part:
    """A file of the array: entries whose digests lie between ``first`` and ``last``."""

    path: str
    entries: int
    first: int
    last: int
    text_bytes: int
    value_bytes: int


@dataclass(frozen=True)
class DigestArray:
    """The files of a digest array, in the order of their digests."""

    folder: str
    parts: tuple[Part, ...]


def build_digest_array(rules: DataFrame, folder: str | None = None, part_entries: int = PART_ENTRIES) -> DigestArray:
    """Write the sorted digests of rules (host, path, verdict) into a shared folder, a new one by default.

    Rules without a host are left out, a null path is empty, A-Z in hosts is lower-cased. Of equal rules that
    differ in their verdict ``block`` stays. Other verdicts than ``allow`` and ``block`` raise ``ValueError``.
    The driver gets one row per file.
    """
    spark = bounded_batches(rules)
    folder = folder or f"{fresh_folder(spark)}/digests"
    odd = rules.filter(F.col("host").isNotNull() & ~F.coalesce(F.col("verdict").isin(*_VERDICTS), F.lit(False)))
    if odd.limit(1).count():
        raise ValueError(f"verdicts must be among {', '.join(_VERDICTS)}")
    host = F.translate("host", ascii_uppercase, ascii_lowercase)
    path = F.coalesce(F.col("path"), F.lit(""))
    stated = rules.filter(F.col("host").isNotNull()).select(host.alias("host"), path.alias("path"), "verdict")
    single = stated.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    by_rule = single.select(
        F.concat("host", F.lit("/"), "path").alias("text"), F.col("verdict").cast("binary").alias("value")
    )
    # Distinct lengths of one host's paths: no more than the longest path has characters.
    lengths = single.groupBy("host").agg(F.array_sort(F.collect_set(F.length("path"))).alias("lengths"))
    by_host = lengths.select(
        F.col("host").alias("text"), F.array_join(F.transform("lengths", lambda n: n.cast("string")), ",").cast("binary")
    )
    entries = by_rule.union(by_host).withColumn("digest", F.xxhash64("text"))
    n = entries.count()
    ordered = entries.repartitionByRange(max(1, -(-n // part_entries)), "digest").sortWithinPartitions("digest", "text")
    told = ordered.mapInArrow(
        _write_part(folder), "path string, entries long, first long, last long, text_bytes long, value_bytes long"
    )
    parts = [Part(*row) for row in told.orderBy("first").collect()]
    return DigestArray(folder, tuple(parts))


def _write_part(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        digests = rows["digest"].to_numpy()
        texts = [t.encode() for t in rows["text"].to_pylist()]
        values = rows["value"].to_pylist()
        ends = [np.cumsum([len(x) for x in column]).astype(np.int64) for column in (texts, values)]
        store, root = shared_store(folder)
        store.create_dir(root, recursive=True)
        # Every attempt writes a name of its own; only the one whose row arrives is part of the array.
        path = f"{root}/{uuid.uuid4().hex}.digests"
        with store.open_output_stream(path) as out:
            for array in (digests.astype(np.int64), *ends):
                out.write(array.tobytes())
            out.write(b"".join(texts))
            out.write(b"".join(values))
        told = [path], [len(digests)], [int(digests[0])], [int(digests[-1])], [int(ends[0][-1])], [int(ends[1][-1])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(told[0], pa.string()), *[pa.array(x, pa.int64()) for x in told[1:]]],
            names=["path", "entries", "first", "last", "text_bytes", "value_bytes"],
        )

    return write


class DigestReader:
    """Looks strings up in a digest array; opened inside a task."""

    def __init__(self, array: DigestArray):
        self._parts = array.parts
        self._store, _ = shared_store(array.folder)
        self._mapped = isinstance(self._store, fs.LocalFileSystem)
        self._firsts = np.array([p.first for p in array.parts], np.int64)
        self._open: OrderedDict[int, tuple[np.ndarray, ...]] = OrderedDict()

    def _part(self, k: int) -> tuple[np.ndarray, ...]:
        if k not in self._open:
            part = self._parts[k]
            if self._mapped:
                data = np.memmap(part.path, np.uint8, mode="r")
            else:
                with self._store.open_input_file(part.path) as file:
                    data = np.frombuffer(file.read(), np.uint8)
                if len(self._open) >= OPEN_PARTS:
                    self._open.popitem(last=False)
            edges = np.cumsum([0, *[8 * part.entries] * 3, part.text_bytes, part.value_bytes])
            pieces = [data[a:b] for a, b in zip(edges[:-1], edges[1:])]
            self._open[k] = (*[p.view(np.int64) for p in pieces[:3]], *pieces[3:])
        return self._open[k]

    def find(self, digests: np.ndarray, texts: Sequence[bytes]) -> dict[int, bytes]:
        """Values of the strings that are stored, by their place in ``texts``."""
        found: dict[int, bytes] = {}
        if not len(self._parts) or not len(digests):
            return found
        order = np.argsort(digests, kind="stable")
        which = np.searchsorted(self._firsts, digests[order], "right") - 1
        edges = np.flatnonzero(np.diff(which, prepend=-2))
        for a, b in zip(edges, [*edges[1:], len(order)]):
            if which[a] < 0:
                continue
            keys, text_ends, value_ends, text, value = self._part(int(which[a]))
            asked = digests[order[a:b]]
            places = np.searchsorted(keys, asked)
            inside = np.minimum(places, len(keys) - 1)
            for i in np.flatnonzero(keys[inside] == asked):
                place, spot = int(places[i]), int(order[a + i])
                while place < len(keys) and keys[place] == asked[i]:  # strings that share a digest
                    start = int(text_ends[place - 1]) if place else 0
                    if text[start : int(text_ends[place])].tobytes() == texts[spot]:
                        start = int(value_ends[place - 1]) if place else 0
                        found[spot] = value[start : int(value_ends[place])].tobytes()
                        break
                    place += 1
        return found

    def lookup(self, texts: Sequence[str]) -> dict[int, bytes]:
        """``find`` with the digests of the strings."""
        raw = [t.encode() for t in texts]
        digests = np.array([xxhash.xxh64_intdigest(t, _SEED) for t in raw], np.uint64).view(np.int64)
        return self.find(digests, raw)


def _domains(host: str) -> Iterator[str]:
    """A host and the domains above it, longest first."""
    yield host
    at = host.find(".")
    while at >= 0:
        yield host[at + 1 :]
        at = host.find(".", at + 1)


def _best_rules(reader: DigestReader, hosts: Sequence[str], paths: Sequence[str]) -> list[tuple[str, str] | None]:
    """(rule, verdict) of the longest rule that fits each url; of equally long ones that with the longer host."""
    above = {h: list(_domains(h)) for h in dict.fromkeys(hosts)}
    domains = list(dict.fromkeys(d for ds in above.values() for d in ds))
    ruled = {domains[i]: [int(n) for n in v.decode().split(",")] for i, v in reader.lookup(domains).items()}
    fitting = {h: [(d, ruled[d]) for d in ds if d in ruled] for h, ds in above.items()}
    asked: dict[tuple[str, str], int] = {}
    wanted: list[list[int]] = []
    for host, path in zip(hosts, paths):
        tries = [(d, path[:n]) for d, lengths in fitting[host] for n in lengths if n <= len(path)]
        tries.sort(key=lambda t: (-len(t[0]) - len(t[1]), -len(t[0])))
        wanted.append([asked.setdefault(t, len(asked)) for t in tries])
    keys = list(asked)
    values = reader.lookup([f"{d}/{p}" for d, p in keys])
    best = []
    for places in wanted:
        first = next((i for i in places if i in values), None)
        best.append(None if first is None else ("".join(keys[first]), values[first].decode()))
    return best


def filter_urls(
    pages: DataFrame,
    rules: DigestArray,
    id_column: str = "page_id",
    url: str = "url",
    default: str = "allow",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row: the id, the columns of ``keep``, host, path, rule (host and path of the deciding rule, else null), verdict.

    Null urls and those without ``://`` have an empty host and path and fit no rule. Every row is judged by itself:
    repeated rows stay, null ids too. Columns of ``pages`` other than the id and ``keep`` are not read, so their names
    don't matter; a kept column with the name of a result raises ``ValueError``. An empty table gives an empty result.
    """
    spark = bounded_batches(pages)
    results = {"host", "path", "rule", "verdict"}
    if clash := results & {id_column, *keep}:
        raise ValueError(f"rename {', '.join(sorted(clash))}: these are columns of the result")
    carried = list(dict.fromkeys([id_column, *keep]))
    parted = pages.select(*carried, url_host(url).alias("host"), url_path(url).alias("path"))
    schema = T.StructType([*parted.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = DigestReader(rules)
        for batch in batches:
            hosts, paths = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("host", "path"))
            best = _best_rules(reader, hosts, paths)
            rule = pa.array([b and b[0] for b in best], pa.string())
            verdict = pa.array([b[1] if b else default for b in best], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, rule, verdict], names=[*batch.schema.names, "rule", "verdict"]
            )

    return parted.mapInArrow(judge, schema)


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A few stated rules as a table; large lists are read from files."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")
