"""Sequences of different lengths as flat arrays, walked position by position, all sequences at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class Chains:
    """``first``: n + 1 offsets of the sequences in the flat arrays."""

    def __init__(self, first: np.ndarray) -> None:
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        self.order = order[sizes[order] > 0]
        self.starts = first[:-1][self.order]
        self.sizes = sizes[self.order]
        longest = int(self.sizes[0]) if len(self.sizes) else 0
        # sequences longer than t
        self.active = np.searchsorted(-self.sizes, -np.arange(longest), "left") if longest else np.zeros(0, np.int64)

    def forward(self) -> Iterator[np.ndarray]:
        """Flat positions of the t-th elements, for t = 0, 1, ...; the k-th is of the k-th longest sequence."""
        for t, k in enumerate(self.active):
            yield self.starts[:k] + t

    def backward(self) -> Iterator[np.ndarray]:
        """The same from the last t down to 0."""
        for t in range(len(self.active) - 1, -1, -1):
            yield self.starts[: self.active[t]] + t
