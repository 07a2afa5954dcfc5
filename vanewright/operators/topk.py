"""What a task does in a nearest-neighbour search. Sent to the workers whole, so they need not have this package."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from heapq import nsmallest

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Numbers of one matrix product, and the share of the largest square that rounding may shift a distance by.
_PRODUCT, _DOUBT = 1 << 22, 1e-10


def as_matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, 0))


def _smallest(distance: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest distances in order with their ids; ties go to the smaller id."""
    if len(distance) > k:
        limit = np.partition(distance, k - 1)[k - 1]
        near, tied = np.flatnonzero(distance < limit), np.flatnonzero(distance == limit)
        # Copies of one vector can make the tie large: only its smallest ids matter.
        tied = np.array(nsmallest(k - len(near), tied, key=lambda j: ids[j]), dtype=np.int64)
        at = np.concatenate([near, tied])
        distance, ids = distance[at], ids[at]
    order = sorted(range(len(distance)), key=lambda j: (distance[j], ids[j]))
    return distance[order], ids[order]


class Nearest:
    """The k nearest rows per query seen so far."""

    def __init__(self, query_ids: Sequence, queries: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = list(query_ids), queries, k
        self.kept = [(np.empty(0), np.empty(0, dtype=object)) for _ in self.query_ids]

    def see(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Compare a block of rows with all queries: one matrix product tells, up to rounding, how near each is, and
        only rows that may be among the k nearest are measured exactly."""
        if not len(vectors) or not len(self.queries):
            return
        squares, own = (vectors ** 2).sum(axis=1), (self.queries ** 2).sum(axis=1)
        step = max(1, _PRODUCT // len(vectors))
        for first in range(0, len(self.queries), step):
            asked = self.queries[first:first + step]
            about = squares - 2 * asked @ vectors.T + own[first:first + step, None]
            doubt = _DOUBT * (squares.max() + own[first:first + step])
            limit = np.full(len(asked), np.inf)
            if len(vectors) > self.k:
                limit = np.partition(about, self.k - 1, axis=1)[:, self.k - 1] + doubt
            for i, query in enumerate(asked, first):
                kept, kept_ids = self.kept[i]
                most = limit[i - first]
                if len(kept) == self.k:  # most rows are out here: farther than the k-th so far
                    most = min(most, kept[-1])
                # written so that rows whose distance is no number stay in
                chosen = np.flatnonzero(~(about[i - first] > most + doubt[i - first]))
                if not len(chosen):
                    continue
                gap = vectors[chosen] - query
                self.kept[i] = _smallest(
                    np.concatenate([kept, np.einsum("ij,ij->i", gap, gap)]), np.concatenate([kept_ids, ids[chosen]]), self.k
                )

    def frame(self, query_id: str, corpus_id: str) -> pd.DataFrame:
        sizes = [len(d) for d, _ in self.kept]
        owners = [q for q, n in zip(self.query_ids, sizes) for _ in range(n)]
        return pd.DataFrame({
            query_id: pd.Series(owners, dtype=object),
            corpus_id: np.concatenate([i for _, i in self.kept]) if sizes else [],
            "distance": np.concatenate([d for d, _ in self.kept]) if sizes else [],
        })


def found_centres(points: np.ndarray, cells: int, rounds: int = 5) -> np.ndarray:
    """At most ``cells`` centres of a sample: rows of it, moved to their means a few times."""
    centres = np.unique(points, axis=0)
    centres = centres[np.random.default_rng(0).permutation(len(centres))[:cells]]
    for _ in range(rounds):
        near = nearest_centre(points, centres)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    # Squared distances up to a term that is the same for all centres.
    return ((centres ** 2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
