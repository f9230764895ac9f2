"""Overlap search in a path-compressed trie of globally ordered n-gram sets.

All probes walk the trie together: a node keeps, for every probe, the overlap with the n-grams on the
path so far, so sets that share a path share the work. A probe leaves a subtree when its overlap
plus what can still follow cannot reach what the smallest set below it needs; a subtree without
probes is not entered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Links need `NEEDED` hundredths of the union in common.
NEEDED = 75


def least_overlap(n, m):
    """The smallest common count with 100 * common >= NEEDED * union."""
    return -(-NEEDED * (n + m) // (100 + NEEDED))


def overlaps(sets: list[np.ndarray], sizes: np.ndarray, probes: list[np.ndarray], probe_sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(set, linked probes) of every set with linked probes.

    Sets and probes list their n-grams in one global order; n-grams that no other set has may be
    missing, `sizes` count them all the same.
    """
    known, inverse = np.unique(np.concatenate(probes), return_inverse=True)
    member = np.zeros((len(known), len(probes)), np.uint8)
    member[inverse, np.repeat(np.arange(len(probes)), [len(p) for p in probes])] = 1
    rows = []  # of each set: the places of its n-grams in `known`; those of no probe are left out
    for grams in sets:
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        rows.append(at[known[at] == grams])
    order = sorted(range(len(sets)), key=lambda i: rows[i].tolist())
    rows, sizes = [rows[i] for i in order], sizes[order]
    lengths = np.array([len(r) for r in rows])
    shared = [0] * len(rows)  # leading n-grams in common with the set before
    for i in range(1, len(rows)):
        n = min(lengths[i - 1], lengths[i])
        differ = np.flatnonzero(rows[i - 1][:n] != rows[i][:n])
        shared[i] = int(differ[0]) if len(differ) else int(n)
    shared = np.array(shared)
    room = np.array([len(p) for p in probes])
    stack = [(0, len(rows), 0, np.zeros(len(probes), np.int32), np.arange(len(probes)))]
    while stack:
        low, high, depth, overlap, active = stack.pop()
        stop = int(shared[low + 1 : high].min()) if high - low > 1 else int(lengths[low])
        path = rows[low][depth:stop]
        if len(path):
            overlap = overlap + member[np.ix_(path, active)].sum(0, dtype=np.int32)
        ahead = np.minimum(int(lengths[low:high].max()) - stop, room[active] - overlap)
        stay = overlap + ahead >= least_overlap(int(sizes[low:high].min()), probe_sizes[active])
        if not stay.any():
            continue
        overlap, active = overlap[stay], active[stay]
        while low < high and lengths[low] == stop:  # sets that end here come first
            found = active[overlap >= least_overlap(int(sizes[low]), probe_sizes[active])]
            if len(found):
                yield order[low], found
            low += 1
        cuts = [low, *(np.flatnonzero(shared[low + 1 : high] == stop) + low + 1).tolist(), high]
        stack += [(a, b, stop, overlap, active) for a, b in zip(cuts, cuts[1:]) if a < b]
