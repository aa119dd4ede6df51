"""A linear-chain conditional random field with two labels per line, in numpy.

Label 1 is good, 0 is bad. The chance of a labelling grows with the sum of one score per good
line and one per pair of neighbouring labels. Chains of many documents run side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chains:
    """Lines of several documents, one after the other, and the places of all first, second … lines."""

    lengths: np.ndarray

    def __post_init__(self):
        self.order = np.argsort(-self.lengths, kind="stable")
        self.starts = np.cumsum(self.lengths) - self.lengths
        longest = int(self.lengths.max()) if len(self.lengths) else 0
        # Documents by falling length: those with a line t are the first active[t].
        falling = np.sort(self.lengths)
        self.active = len(falling) - np.searchsorted(falling, np.arange(longest), "right")

    def places(self, t: int) -> np.ndarray:
        return self.starts[self.order[: self.active[t]]] + t


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))


def marginals(scores: np.ndarray, links: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray]:
    """(chance of good per line, expected number of each pair of neighbours) by forward-backward."""
    own = np.stack([np.zeros(len(scores)), scores], axis=1)
    forward, backward = own.copy(), np.zeros_like(own)
    steps = len(chains.active)
    for t in range(1, steps):
        at = chains.places(t)
        forward[at] = own[at] + _log_sum(forward[at - 1][:, :, None] + links[None], 1)
    pairs = np.zeros((2, 2))
    for t in range(steps - 1, 0, -1):
        at = chains.places(t)
        after = own[at] + backward[at]
        backward[at - 1] = _log_sum(links[None] + after[:, None, :], 2)
        both = forward[at - 1][:, :, None] + links[None] + after[:, None, :]
        top = both.max(axis=(1, 2), keepdims=True)
        weight = np.exp(both - top)
        pairs += (weight / weight.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    joint = forward + backward
    return 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -60, 60))), pairs


@dataclass
class LineField:
    """Weights of the features of a line, and the scores of neighbouring labels."""

    weights: np.ndarray
    links: np.ndarray

    def good(self, features: np.ndarray, chains: Chains) -> np.ndarray:
        if not len(features):
            return np.zeros(0)
        return marginals(features @ self.weights, self.links, chains)[0]


def fit(
    features: np.ndarray,
    labels: np.ndarray,
    line_weights: np.ndarray,
    chains: Chains,
    rounds: int = 200,
    rate: float = 0.1,
    penalty: float = 1e-3,
) -> LineField:
    """Raise the weighted likelihood of the labels by adaptive steps; both kinds of weights are penalised."""
    theta = np.zeros(features.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    total = line_weights.sum()
    observed = np.zeros((2, 2))
    for t in range(1, len(chains.active)):
        at = chains.places(t)
        np.add.at(observed, (labels[at - 1], labels[at]), 1)
    n_pairs = max(1.0, observed.sum())
    for step in range(1, rounds + 1):
        links = theta[-4:].reshape(2, 2)
        good, expected = marginals(features @ theta[:-4], links, chains)
        gradient = np.concatenate(
            [features.T @ (line_weights * (labels - good)) / total, ((observed - expected) / n_pairs).ravel()]
        )
        gradient -= penalty * theta
        gradient[-4:] -= 20 * penalty * theta[-4:]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return LineField(theta[:-4].copy(), theta[-4:].reshape(2, 2).copy())
