"""One hierarchical navigable small-world graph over the vectors of a shard, in numpy.

Nodes are numbered by falling level, so each layer holds the first nodes of the layer below it, and its
links are one matrix of node numbers with -1 where there is none. Nodes are inserted in that order. The
candidates of a node are the nearest nodes before it, found exactly by block products (a shard is bounded), and
the usual rule picks the links: a candidate is kept if no kept one is nearer to it than the node is, then the
nearest of the others fill up. Links are mutual; a full list is picked anew by the same rule.

Points are scaled into the unit ball and get one more coordinate that puts them on the unit sphere, so the
nearest by angle are those with the largest inner product with a query whose extra coordinate is 0."""

from __future__ import annotations

import numpy as np

LINKS = 16          # of a node in an upper layer; twice as many in the lowest one
CANDIDATES = 64     # nearest earlier nodes among which links are picked
INSERT_AT_ONCE = 512
SEARCH_AT_ONCE = 256
UPPER_WIDTH = 16    # nodes kept while descending through the upper layers
OPENED = 2          # nodes of each search opened in one step


def on_sphere(vectors: np.ndarray) -> np.ndarray:
    """Points as unit vectors of one more dimension; inner products with a query keep their order."""
    squares = (vectors * vectors).sum(axis=1)
    most = max(squares.max(initial=0.0), np.finfo(np.float64).tiny)
    extra = np.sqrt(np.maximum(1.0 - squares / most, 0.0))
    return np.column_stack([vectors / np.sqrt(most), extra]).astype(np.float32)


def as_queries(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.column_stack([vectors / norms, np.zeros(len(vectors))]).astype(np.float32)


def levels_of(draws: np.ndarray) -> np.ndarray:
    """Level of each node from a uniform draw in (0, 1]: one node in LINKS reaches the next layer."""
    return np.floor(-np.log(draws) / np.log(LINKS)).astype(np.int64)


def _pick(points: np.ndarray, nearness: np.ndarray, among: np.ndarray, n: int) -> np.ndarray:
    """For each row, up to n of the candidates `among` (-1: none; sorted by falling nearness)."""
    valid = among >= 0
    held = points[among]
    pairs = held @ held.transpose(0, 2, 1)
    kept = np.zeros_like(valid)
    count = np.zeros(len(among), np.int64)
    for c in range(among.shape[1]):
        shadowed = ((pairs[:, c, :] > nearness[:, c, None]) & kept).any(axis=1)
        kept[:, c] = valid[:, c] & ~shadowed & (count < n)
        count += kept[:, c]
    # kept ones first, then the nearest others
    order = np.argsort(np.where(kept, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :n]
    return np.take_along_axis(among, order, axis=1)


def _insert(points: np.ndarray, links: np.ndarray, start: int, stop: int) -> None:
    """Link nodes start..stop-1 to the nodes before them, and those back."""
    near = points[start:stop] @ points[:stop].T
    near[np.arange(stop)[None, :] >= np.arange(start, stop)[:, None]] = -np.inf
    width = min(CANDIDATES, stop)
    found = np.argpartition(-near, width - 1, axis=1)[:, :width]
    values = np.take_along_axis(near, found, axis=1)
    order = np.argsort(-values, axis=1, kind="stable")
    found, values = np.take_along_axis(found, order, axis=1), np.take_along_axis(values, order, axis=1)
    found[np.isinf(values)] = -1
    # half of a node's places are left for later nodes
    chosen = _pick(points, values, found, max(1, links.shape[1] // 2))
    links[start:stop, :chosen.shape[1]] = chosen
    source, place = np.nonzero(chosen >= 0)
    _link_back(points, links, chosen[source, place], source + start)


def _link_back(points: np.ndarray, links: np.ndarray, targets: np.ndarray, sources: np.ndarray) -> None:
    order = np.argsort(targets, kind="stable")
    targets, sources = targets[order], sources[order]
    nodes, first, counts = np.unique(targets, return_index=True, return_counts=True)
    cap = links.shape[1]
    wide = np.full((len(nodes), cap + int(counts.max(initial=0))), -1, np.int64)
    wide[:, :cap] = links[nodes]
    row = np.repeat(np.arange(len(nodes)), counts)
    wide[row, cap + np.arange(len(targets)) - first[row]] = sources
    # places in use come first
    wide = np.take_along_axis(wide, np.argsort(wide < 0, axis=1, kind="stable"), axis=1)
    full = (wide >= 0).sum(axis=1) > cap
    links[nodes[~full]] = wide[~full, :cap]
    nodes, wide = nodes[full], wide[full]
    step = max(1, INSERT_AT_ONCE * CANDIDATES // max(1, wide.shape[1]))
    for at in range(0, len(nodes), step):
        mine, others = nodes[at:at + step], wide[at:at + step]
        near = np.einsum("nd,nkd->nk", points[mine], points[others])
        near[others < 0] = -np.inf
        order = np.argsort(-near, axis=1, kind="stable")[:, :2 * cap]
        links[mine] = _pick(points, np.take_along_axis(near, order, axis=1),
                            np.take_along_axis(others, order, axis=1), cap)


def build(points: np.ndarray, levels: np.ndarray) -> list[np.ndarray]:
    """Link matrices of the layers, lowest first. `levels` must not rise from node to node."""
    layers: list[np.ndarray] = []
    for level in range(int(levels.max(initial=0)), -1, -1):
        size = int((levels >= level).sum())
        links = np.full((size, LINKS * (2 if level == 0 else 1)), -1, np.int64)
        done = 0
        if layers:  # nodes of the layer above are linked already
            done = len(layers[-1])
            links[:done, :layers[-1].shape[1]] = layers[-1]
        done = max(done, 1)
        while done < size:
            stop = min(size, done + INSERT_AT_ONCE)
            _insert(points, links, done, stop)
            done = stop
        if level == 0:
            _reach_all(points, links)
        layers.append(links)
    return layers[::-1]


def reached(links: np.ndarray) -> np.ndarray:
    """Which nodes a walk from node 0 finds."""
    seen = np.zeros(len(links), bool)
    seen[:1] = True
    edge = np.arange(min(1, len(links)))
    while len(edge):
        after = np.unique(links[edge])
        after = after[after >= 0]
        edge = after[~seen[after]]
        seen[edge] = True
    return seen


def _reach_all(points: np.ndarray, links: np.ndarray) -> None:
    """Give nodes that no walk finds a link from their nearest found node, in place of its last link."""
    while not (seen := reached(links)).all():
        lost, found = np.flatnonzero(~seen), np.flatnonzero(seen)
        lost = lost[:INSERT_AT_ONCE]
        nearest = found[np.argmax(points[lost] @ points[found].T, axis=1)]
        nodes, at = np.unique(nearest, return_index=True)
        row = links[nodes]
        place = np.minimum((row >= 0).sum(axis=1), links.shape[1] - 1)
        replaced = row[np.arange(len(nodes)), place]
        links[nodes, place] = lost[at]
        # what was found only through the replaced link hangs on the new one
        links[lost[at], -1] = np.where(replaced >= 0, replaced, links[lost[at], -1])


def _beam(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray,
          width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best `width` nodes of one layer for each query: (nodes, nearness), best first, -1 where none."""
    n, size = len(queries), len(links)
    seen = np.zeros((n, size), bool)
    ids = np.full((n, width), -1, np.int64)
    near = np.full((n, width), -np.inf, np.float32)
    fresh = np.zeros((n, width), bool)
    rows, nodes = np.repeat(np.arange(n), entries.shape[1]), entries.ravel()
    rows, nodes = rows[nodes >= 0], nodes[nodes >= 0]
    while len(rows):
        keys = np.unique(rows * size + nodes)
        rows, nodes = keys // size, keys % size
        new = ~seen[rows, nodes]
        rows, nodes = rows[new], nodes[new]
        seen[rows, nodes] = True
        values = np.einsum("nd,nd->n", points[nodes], queries[rows])
        better = values > near[rows, -1]
        rows, nodes, values = rows[better], nodes[better], values[better]
        if len(rows):
            at, first, counts = np.unique(rows, return_index=True, return_counts=True)
            line = np.repeat(np.arange(len(at)), counts)
            place = width + np.arange(len(rows)) - first[line]
            shape = (len(at), width + int(counts.max()))
            wide_near = np.full(shape, -np.inf, np.float32)
            wide_ids = np.full(shape, -1, np.int64)
            wide_fresh = np.zeros(shape, bool)
            wide_near[:, :width], wide_ids[:, :width], wide_fresh[:, :width] = near[at], ids[at], fresh[at]
            wide_near[line, place], wide_ids[line, place], wide_fresh[line, place] = values, nodes, True
            order = np.argsort(-wide_near, axis=1, kind="stable")[:, :width]
            near[at] = np.take_along_axis(wide_near, order, axis=1)
            ids[at] = np.take_along_axis(wide_ids, order, axis=1)
            fresh[at] = np.take_along_axis(wide_fresh, order, axis=1)
        opened = fresh & (np.cumsum(fresh, axis=1) <= OPENED)
        fresh &= ~opened
        source, place = np.nonzero(opened)
        after = links[ids[source, place]]
        rows, nodes = np.repeat(source, links.shape[1]), after.ravel()
        rows, nodes = rows[nodes >= 0], nodes[nodes >= 0]
    return ids, near


def search(points: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, width: int) -> np.ndarray:
    """The best `width` nodes found for each query (unit vectors), -1 where there are fewer."""
    out = np.full((len(queries), width), -1, np.int64)
    for at in range(0, len(queries), SEARCH_AT_ONCE):
        part = queries[at:at + SEARCH_AT_ONCE]
        entries = np.zeros((len(part), 1), np.int64)
        for links in layers[:0:-1]:
            entries, _ = _beam(points, links, part, entries, min(UPPER_WIDTH, width))
        out[at:at + SEARCH_AT_ONCE] = _beam(points, layers[0], part, entries, width)[0]
    return out
