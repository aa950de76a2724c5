"""Brute-force versions of the operators, and awkward documents, for small tables."""

from __future__ import annotations

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text: str | None, n: int = 5) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


class Groups:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def jaccard_components(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    sets = [(i, shingles(t)) for i, t in rows]
    groups = Groups({i for i, _ in rows})
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                groups.join(i, j)
    return {i: groups.find(i) for i, _ in rows}


def cut_repeats(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, int, str]]:
    """id -> (bytes, removed, spans, sha256 of the rest); ids are distinct."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                gone[p : p + 100] = [True] * 100
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def awkward_texts(seed: int = 1) -> list[str | None]:
    """Null, empty, short, very long, equal, nearly equal, repeating and mixed-script texts."""
    r = random.Random(seed)

    def prose(n: int) -> list[str]:
        return ["".join(r.choice("abcdeéßñ") for _ in range(r.randint(2, 8))) for _ in range(n)]

    base, passage = prose(150), " ".join(prose(40))
    near = []
    for k in range(12):
        words = list(base)
        for _ in range(k % 5):
            words[r.randrange(len(words))] = "".join(prose(1))
        near.append(" ".join(words))
    framed = [f"{' '.join(prose(25))}\n{passage}\n{' '.join(prose(25))}" for _ in range(8)]
    line = "this line stands in very many documents of the corpus, and it is not so short."
    lined = [f"{' '.join(prose(12))}\n{line}\n{' '.join(prose(12))}" for _ in range(15)]
    return [
        None, "", " \t\n", "one", "one two three", "One TWO three", "!!! ... 123 456", "ab " * 400, "a" * 700,
        "a" * 900, "xyz" * 200, " ".join(base), " ".join(base).upper(), " ".join(prose(9000)), *near, *near[:2],
        *framed, *lined, passage, f"{passage} {passage}", "é" * 350, " Ünï cödé " * 30,
    ]


def awkward_documents(spark):
    """The texts with ids out of order and extra columns of names that operators use inside."""
    texts = awkward_texts()
    rows = [
        (3 * ((k * 17) % len(texts)), t, ["en", "fr", None][k % 3], ["a", "b", None, "c"][k % 4], k, f"x{k}", k, float(k))
        for k, t in enumerate(texts)
    ]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, bucket string, n long, score double",
    )


def texts_by_id(documents) -> list[tuple[int, str | None]]:
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
