"""A mergeable quantile summary with a rank error that is known, for ``grouped.aggregate_states``.

Values are kept in levels; a value of level h stands for 2**h of the input. A level that reaches
``size`` values is sorted and every second one moves up, alternately the odd and the even ones. Each
such step moves the rank of any value by at most 2**h, whatever the data, so the sum of these steps is a
bound on the rank error of every answer, and it travels with the summary. A level h can be halved
at most n / (size * 2**h) times, so the bound is at most n / size for each of about log2(n / size)
levels.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Quantiles:
    """Summary of the values seen so far. Nulls are not values; NaN is the largest one, as in Spark."""

    size: int
    n: int = 0
    error: int = 0
    levels: list[np.ndarray] = field(default_factory=list)
    halved: list[int] = field(default_factory=list)

    def add(self, values: np.ndarray) -> Quantiles:
        values = np.asarray(values, "float64")
        self.n += len(values)
        self._put(0, values)
        return self._shrink()

    def merge(self, other: Quantiles) -> Quantiles:
        """Both summaries as one; the errors add up."""
        self.n += other.n
        self.error += other.error
        for h, values in enumerate(other.levels):
            self._put(h, values)
        return self._shrink()

    def _put(self, h: int, values: np.ndarray) -> None:
        while len(self.levels) <= h:
            self.levels.append(np.empty(0))
            self.halved.append(0)
        self.levels[h] = np.concatenate([self.levels[h], values])

    def _shrink(self) -> Quantiles:
        h = 0
        while h < len(self.levels):
            values = self.levels[h]
            if len(values) >= self.size:
                values = np.sort(values)  # NaN last
                even = len(values) // 2 * 2
                # the largest value stays below if their number is odd
                self.levels[h] = values[even:]
                self._put(h + 1, values[self.halved[h] % 2:even:2])
                self.halved[h] += 1
                self.error += 1 << h
            h += 1
        return self

    def at(self, q: float) -> float | None:
        """A value whose rank is within ``error`` of ``max(1, ceil(q * n))``; None of no values."""
        if not self.n:
            return None
        values = np.concatenate(self.levels)
        weights = np.concatenate([np.full(len(v), 1 << h, "int64") for h, v in enumerate(self.levels)])
        order = np.argsort(values, kind="stable")
        ranks = np.cumsum(weights[order])
        wanted = min(max(1, int(np.ceil(q * self.n))), int(ranks[-1]))
        return float(values[order][np.searchsorted(ranks, wanted)])
