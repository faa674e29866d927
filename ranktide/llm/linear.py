"""Follow-the-regularised-leader (proximal) for sparse linear classifiers, on a bounded training sample."""

from __future__ import annotations

import numpy as np

Example = tuple[np.ndarray, np.ndarray]  # distinct feature indices and their values


class Leader:
    """Per-coordinate FTRL-proximal with elastic-net penalties; one weight column per output.

    The last feature row is the intercept, which carries no penalty. With ``rising`` no feature weight is negative:
    a feature can only raise the score.
    """

    def __init__(
        self, features: int, outputs: int, rate: float, smooth: float, l1: float, l2: float, rising: bool = False
    ) -> None:
        self.pull = np.zeros((features + 1, outputs))
        self.squares = np.zeros((features + 1, outputs))
        self.rate, self.smooth, self.l1, self.l2 = rate, smooth, l1, l2
        self.bias, self.rising = features, rising

    def rows(self, index: np.ndarray) -> np.ndarray:
        """Current weights of some feature rows."""
        pull, squares = self.pull[index], self.squares[index]
        free = (index == self.bias)[:, None]
        l1, l2 = np.where(free, 0.0, self.l1), np.where(free, 0.0, self.l2)
        shrunk = np.sign(pull) * np.maximum(np.abs(pull) - l1, 0)
        weights = -shrunk / ((self.smooth + np.sqrt(squares)) / self.rate + l2)
        return np.where(free, weights, np.maximum(weights, 0)) if self.rising else weights

    def step(self, index: np.ndarray, weights: np.ndarray, gradient: np.ndarray) -> None:
        before = self.squares[index]
        after = before + gradient**2
        self.pull[index] += gradient - (np.sqrt(after) - np.sqrt(before)) / self.rate * weights
        self.squares[index] = after

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """Feature weights, one row per feature, and the intercepts."""
        table = self.rows(np.arange(self.bias + 1))
        return table[:-1].astype(np.float32), table[-1].astype(np.float32)

    def extend(self, example: Example) -> Example:
        index, values = example
        return np.append(index, self.bias), np.append(values, 1.0)


def softmax(scores: np.ndarray) -> np.ndarray:
    shifted = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
