"""Components of a small graph inside a task; numpy only."""

from __future__ import annotations

import numpy as np


class Forest:
    """Sets of the numbers below ``n``, joined by arrays of links; each is known by its smallest member."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.up[a], self.up[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))
            while ((up := self.up[self.up]) != self.up).any():
                self.up = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Every number that is not the smallest of its set, with the smallest: a spanning forest."""
        node = np.flatnonzero(self.up != np.arange(len(self.up)))
        return node, self.up[node]
