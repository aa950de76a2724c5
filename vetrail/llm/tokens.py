"""Token ids of whole texts, word by word, with a memory of words already encoded.

White space ends a token in this vocabulary, so a text's ids are its words' ids one after another.
Words are told apart by a 64-bit hash over the raw bytes of a block of texts; only words that the
Python worker has not seen are given to the tokenizer. The memory is bounded: when it is full it
starts anew. Words over 64 bytes are encoded each time.
"""

from __future__ import annotations

import numpy as np

from vetrail.llm.common import span_hashes, word_spans

LONGEST = 64
REMEMBERED = 2_000_000
#: A word of its own that no text word equals: words holding it are encoded one by one.
_MARK = "\x01"


class WordTokenizer:
    """Encodes blocks of texts with a tokenizer file of the ``tokenizers`` library."""

    def __init__(self, file: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(file)
        if self._tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"{file}: ids beyond 16 bits can't be stored")
        self._mark = self._ids(f" {_MARK} ")
        self._remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self._hashes = np.zeros(0, np.uint64)
        self._first = np.zeros(0, np.uint32)
        self._count = np.zeros(0, np.uint16)
        self._flat = np.zeros(1 << 16, np.uint16)
        self._used = 0

    def _ids(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of words and their number per word."""
        flat, counts = [], np.zeros(len(words), np.int64)
        for start in range(0, len(words), 2000):
            part = words[start : start + 2000]
            ids = np.array(self._ids(f" {_MARK} ".join(part)), np.int64)
            cut = np.flatnonzero(ids == self._mark[0]) if len(self._mark) == 1 else None
            if cut is None or len(cut) != len(part) - 1:
                each = [self._ids(w) for w in part]
                flat += [np.array(x, np.int64) for x in each]
                counts[start : start + len(part)] = [len(x) for x in each]
            else:
                edges = np.concatenate([[-1], cut, [len(ids)]])
                counts[start : start + len(part)] = np.diff(edges) - 1
                flat.append(np.delete(ids, cut))
        return (np.concatenate(flat) if flat else np.zeros(0, np.int64)), counts

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        flat, counts = self._encode_words(words)
        need = self._used + len(flat)
        if need > len(self._flat):
            self._flat = np.concatenate([self._flat, np.zeros(max(need, len(self._flat)), np.uint16)])
        self._flat[self._used : need] = flat
        first = self._used + np.cumsum(counts) - counts
        self._used = need
        merged = np.concatenate([self._hashes, hashes])
        order = np.argsort(merged, kind="stable")
        self._hashes = merged[order]
        self._first = np.concatenate([self._first, first.astype(np.uint32)])[order]
        self._count = np.concatenate([self._count, counts.astype(np.uint16)])[order]

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of texts, one after another, and their number per text."""
        begin, stop, first = word_spans(raw, at)
        if not len(begin):
            return np.zeros(0, np.uint16), np.zeros(len(at) - 1, np.int64)
        short = stop - begin <= LONGEST
        hashes = np.zeros(len(begin), np.uint64)
        hashes[short] = span_hashes(raw, begin[short], stop[short])
        if len(self._hashes) > self._remembered:
            self._forget()
        # Sorted distinct words: looked up in order, which is far kinder to the processor's memory.
        distinct, one, which = np.unique(hashes[short], return_index=True, return_inverse=True)
        place = np.searchsorted(self._hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self._hashes)
        known[inside] = self._hashes[place[inside]] == distinct[inside]
        if not known.all():
            a, b = begin[short][one[~known]], stop[short][one[~known]]
            data = raw.tobytes()
            words = [data[i:j].decode() for i, j in zip(a.tolist(), b.tolist())]
            self._learn(distinct[~known], words)
            place = np.searchsorted(self._hashes, distinct)
        starts, counts = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        starts[short], counts[short] = self._first[place][which], self._count[place][which]
        flat = self._flat
        if not short.all():
            long_ids, long_counts = [], []
            for i, j in zip(begin[~short].tolist(), stop[~short].tolist()):
                ids = self._ids(raw[i:j].tobytes().decode())
                long_ids.append(np.array(ids, np.uint16))
                long_counts.append(len(ids))
            extra = np.concatenate(long_ids)
            counts[~short] = long_counts
            starts[~short] = self._used + np.cumsum(long_counts) - long_counts
            flat = np.concatenate([self._flat[: self._used], extra])
        total = np.cumsum(counts)
        out = flat[np.arange(int(total[-1])) + np.repeat(starts - (total - counts), counts)]
        edges = np.concatenate([[0], total])
        return out, edges[first[1:]] - edges[first[:-1]]


_open: dict[str, WordTokenizer] = {}


def tokenizer(file: str) -> WordTokenizer:
    """The worker's tokenizer of a file; its memory outlives a task."""
    if file not in _open:
        _open[file] = WordTokenizer(file)
    return _open[file]
