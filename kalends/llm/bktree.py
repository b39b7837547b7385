"""BK-trees over 64-bit fingerprints as flat numpy arrays; many shards' trees are built and searched together."""

from __future__ import annotations

import numpy as np


def build(root: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Insert every fingerprint below the root of its shard; a child hangs at its integer distance to its parent.

    ``root`` gives the position of the first fingerprint of each one's shard. Returns the sorted edge keys
    ``parent * 65 + distance`` and the children in that order. One round goes one level down in all trees.
    """
    place, active = root.copy(), np.flatnonzero(root != np.arange(len(root)))
    keys, children = [], []
    while active.size:
        key = place[active] * 65 + np.bitwise_count(prints[active] ^ prints[place[active]])
        order = np.argsort(key, kind="stable")
        key, item = key[order], active[order]
        first = np.r_[True, key[1:] != key[:-1]]
        keys.append(key[first])
        children.append(item[first])
        place[item] = item[first][np.cumsum(first) - 1]
        active = np.sort(item[~first])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key)
    return key[order], child[order]


def search(root: np.ndarray, prints: np.ndarray, tree: tuple[np.ndarray, np.ndarray], queries: np.ndarray, query_root: np.ndarray, radius: int):
    """Yield arrays (query, node) within ``radius``: from each root, only edges whose distance differs by at most the radius are followed."""
    key, child = tree
    width = np.bincount(root, minlength=len(root))[query_root]
    for part in np.split(np.arange(len(queries)), np.flatnonzero(np.diff(np.cumsum(width) // 1_000_000)) + 1):
        of, node = part, query_root[part]
        while of.size:
            gap = np.bitwise_count(queries[of] ^ prints[node]).astype(np.int64)
            near = gap <= radius
            yield of[near], node[near]
            low = np.searchsorted(key, node * 65 + np.maximum(gap - radius, 0))
            n = np.searchsorted(key, node * 65 + np.minimum(gap + radius, 64), "right") - low
            of, at = np.repeat(of, n), np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n)
            node = child[at + np.arange(len(of))]


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of ``a`` and ``b`` in place; every label ends as the smallest position of its class."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label[label] != label).any():
            label[:] = label[label]
