"""A hierarchical navigable small-world graph over unit vectors, built and searched in batches.

Layers hold nested subsets of the vectors, each a sixteenth of the one below. A layer is built by
inserting batches: each new vector is searched among those inserted before (entered through the layers
above), compared with its own batch, and tied to a diverse choice of its nearest ones. A search
descends the layers and runs a beam in the lowest. All steps work on many vectors at once.
"""

from __future__ import annotations

import numpy as np

from vetrail.llm.common import mix

NEIGHBOURS = 16
BUILD_BEAM = 48
_SEED_ROWS = 256
_BATCH = 512
_EXPAND = 3


class Hnsw:
    """``vectors`` are unit rows (float32); node numbers are row numbers."""

    def __init__(self, vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors = vectors
        #: From the top: the layer's nodes, and per node of the layer its neighbours (layer positions, -1: none).
        self.layers = layers

    @classmethod
    def build(cls, vectors: np.ndarray, neighbours: int = NEIGHBOURS, beam: int = BUILD_BEAM) -> Hnsw:
        n = len(vectors)
        draw = mix(np.arange(n, dtype=np.uint64) + np.uint64(12345))
        order = np.argsort(draw, kind="stable")
        graph, sizes = cls(vectors, []), [n]
        while sizes[-1] > _SEED_ROWS:
            sizes.append(sizes[-1] // neighbours)
        for size in reversed(sizes):
            # A prefix of the random order: layers are nested.
            graph._add_layer(order[:size], neighbours * (2 if size == n else 1), beam)
        return graph

    def _add_layer(self, nodes: np.ndarray, width: int, beam: int) -> None:
        v = self.vectors[nodes]
        links = np.full((len(nodes), width), -1, np.int32)
        done = min(_SEED_ROWS, len(nodes))
        near = v[:done] @ v[:done].T
        np.fill_diagonal(near, -2)
        take = min(beam, done - 1)
        if take > 0:
            top = np.argsort(-near, axis=1, kind="stable")[:, :take]
            links[:done] = _diverse(v, top, np.take_along_axis(near, top, 1), width)
        while done < len(nodes):
            stop = min(done + min(_BATCH, done), len(nodes))
            new = np.arange(done, stop)
            # Nodes of upper layers come first in this one, under the same position.
            entry = self._entries(v[new])
            entry[entry >= done] = 0
            found, near = _beam(v[:done], links[:done], v[new], entry, beam)
            own = v[new] @ v[new].T
            np.fill_diagonal(own, -2)
            take = min(width, len(new) - 1)
            if take > 0:
                part = np.argpartition(-own, take - 1, axis=1)[:, :take]
                found = np.concatenate([found, part + done], axis=1)
                near = np.concatenate([near, np.take_along_axis(own, part, 1)], axis=1)
                sort = np.argsort(-near, axis=1, kind="stable")
                found, near = np.take_along_axis(found, sort, 1), np.take_along_axis(near, sort, 1)
            links[new, : width // 2] = _diverse(v, found, near, width // 2)
            self._link_back(v, links, new, width)
            done = stop
        self.layers.append((nodes, links))

    @staticmethod
    def _link_back(v: np.ndarray, links: np.ndarray, new: np.ndarray, width: int) -> None:
        """Offer each new node to the neighbours it chose; full ones choose anew."""
        source = np.repeat(new, links.shape[1])
        target = links[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        heads, first, count = np.unique(target, return_index=True, return_counts=True)
        offered = np.full((len(heads), min(int(count.max(initial=1)), 2 * width)), -1, np.int32)
        place = np.arange(len(target)) - np.repeat(first, count)
        row = np.repeat(np.arange(len(heads)), count)
        fits = place < offered.shape[1]
        offered[row[fits], place[fits]] = source[fits]
        both = np.concatenate([links[heads], offered], axis=1)
        both.sort(axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        near = np.einsum("ncd,nd->nc", v[both], v[heads])
        near[both < 0] = -3
        sort = np.argsort(-near, axis=1, kind="stable")
        both, near = np.take_along_axis(both, sort, 1), np.take_along_axis(near, sort, 1)
        room = (both >= 0).sum(axis=1) <= width
        links[heads[room]] = both[room][:, :width]
        if not room.all():
            full = ~room
            links[heads[full]] = _diverse(v, both[full], near[full], width)

    def _entries(self, queries: np.ndarray) -> np.ndarray:
        """Per query the entry positions for the layer below the built ones (none built: position 0)."""
        entry = np.zeros((len(queries), 1), np.int32)
        for nodes, links in self.layers:
            entry, _ = _beam(self.vectors[nodes], links, queries, entry, 4)
        return np.maximum(entry, 0)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query up to ``beam`` node numbers (-1: none) and cosines, the nearest first."""
        entry = np.zeros((len(queries), 1), np.int32)
        for k, (nodes, links) in enumerate(self.layers):
            last = k == len(self.layers) - 1
            entry, near = _beam(self.vectors[nodes], links, queries, entry, beam if last else 4)
            if last:
                return np.where(entry >= 0, nodes[entry], -1), near
            entry = np.maximum(entry, 0)
        return np.full((len(queries), 0), -1), np.zeros((len(queries), 0), np.float32)


def _diverse(v: np.ndarray, found: np.ndarray, near: np.ndarray, width: int) -> np.ndarray:
    """Of candidates sorted by nearness keep those nearer to the base than to any kept; then fill up."""
    found, near = found[:, :96], near[:, :96]
    n, c = found.shape
    kept = np.zeros((n, c), bool)
    closest = np.full((n, c), -2, np.float32)
    count = np.zeros(n, np.int64)
    cand = v[found]
    for j in range(c):
        take = (found[:, j] >= 0) & (near[:, j] > closest[:, j]) & (count < width)
        if take.any():
            rows = np.flatnonzero(take)
            kept[rows, j] = True
            count[rows] += 1
            if j + 1 < c:
                to_it = np.einsum("ncd,nd->nc", cand[rows, j + 1 :], cand[rows, j])
                closest[rows, j + 1 :] = np.maximum(closest[rows, j + 1 :], to_it)
    # Kept ones first, then the nearest of the others.
    rank = np.where(kept, 0, np.where(found >= 0, 1, 2))
    order = np.argsort(rank, axis=1, kind="stable")[:, :width]
    out = np.take_along_axis(found, order, 1).astype(np.int32)
    if out.shape[1] < width:
        out = np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)
    return out


def _beam(
    v: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all queries in one layer: positions (-1: none) and cosines, the nearest first."""
    q, n = len(queries), len(v)
    if not q or not n:
        return np.full((q, 1), -1, np.int32), np.full((q, 1), -2, np.float32)
    beam = min(beam, n)
    seen = np.zeros((q, n), bool)
    ids = np.full((q, beam), -1, np.int32)
    near = np.full((q, beam), -2, np.float32)
    open_ = np.zeros((q, beam), bool)
    live = np.arange(q)
    fresh = entry
    while len(live):
        fresh = np.sort(fresh, axis=1)
        fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
        good = fresh >= 0
        good &= ~seen[live[:, None], np.maximum(fresh, 0)]
        rows, columns = np.nonzero(good)
        seen[live[rows], fresh[rows, columns]] = True
        sims = np.full(fresh.shape, -2, np.float32)
        sims[rows, columns] = np.einsum("kd,kd->k", v[fresh[rows, columns]], queries[live[rows]])
        all_ids = np.concatenate([ids[live], np.where(good, fresh, -1)], axis=1)
        all_near = np.concatenate([near[live], sims], axis=1)
        all_open = np.concatenate([open_[live], good], axis=1)
        top = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        ids[live] = np.take_along_axis(all_ids, top, 1)
        near[live] = np.take_along_axis(all_near, top, 1)
        open_[live] = np.take_along_axis(all_open, top, 1)
        live = live[open_[live].any(axis=1)]
        if not len(live):
            break
        # The beam is sorted: the first open ones are the nearest.
        first = np.argsort(~open_[live], axis=1, kind="stable")[:, :_EXPAND]
        chosen = np.take_along_axis(open_[live], first, 1)
        nodes = np.where(chosen, np.take_along_axis(ids[live], first, 1), -1)
        open_[live[:, None], first] = False
        fresh = np.where(nodes[:, :, None] >= 0, links[np.maximum(nodes, 0)], -1).reshape(len(live), -1)
    return ids, near
