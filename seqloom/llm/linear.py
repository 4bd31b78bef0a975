"""Sparse binary rows and small fits in numpy, shared by the two text classifiers."""

from __future__ import annotations

import math

import numpy as np


class Rows:
    """Rows of binary features: the columns of row i are index[start[i]:start[i + 1]]."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.width, self.start = width, np.cumsum([0, *map(len, rows)])
        self.index = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
        self.owner = np.repeat(np.arange(len(rows)), np.diff(self.start))

    def __len__(self) -> int:
        return len(self.start) - 1

    def row(self, i: int) -> np.ndarray:
        return self.index[self.start[i] : self.start[i + 1]]

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, w[self.index], len(self))

    def gather(self, by_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, by_row[self.owner], self.width)


class Index:
    """Numbers features in the order in which they appear and keeps rows as arrays of numbers, so no text is held twice."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.rows: list[np.ndarray] = []

    def add(self, features: set[str]) -> None:
        number = self.number
        self.rows.append(np.array(sorted(number.setdefault(f, len(number)) for f in sorted(features)), np.int32))

    def kept(self, flags: np.ndarray) -> tuple[list[str], Rows]:
        """The features with a flag, and the rows over them alone."""
        place = np.cumsum(flags) - 1
        return [f for f, k in self.number.items() if flags[k]], Rows([place[r[flags[r]]] for r in self.rows], int(flags.sum()))

    def frequent(self, least: int) -> np.ndarray:
        counts = np.zeros(len(self.number), np.int64)
        for r in self.rows:
            counts[r] += 1
        return counts >= least


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else 1 - 1 / (1 + math.exp(min(x, 700)))


def calibrate(margins: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b) such that sigmoid(a * margin + b) is a probability: Newton steps on smoothed targets, as Platt has it."""
    pos, neg = float((y > 0).sum()), float((y <= 0).sum())
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g, h = p - target, np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[(h * margins**2).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, np.array([(g * margins).sum() + 1e-3 * (a - 1), g.sum()]))
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
        if abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b
