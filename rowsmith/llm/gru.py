"""A bidirectional gated recurrent network with attention pooling, in numpy.

The input of a word is the embedding of the word beside the mean embedding of its character
n-grams, both in hashed tables. Two recurrent passes read a window of words, attention pools
their states, and a linear unit gives the logit of the window.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

WORD_BUCKETS = 1 << 14
GRAM_BUCKETS = 1 << 15
GRAM_SIZES = (3, 4, 5)
WIDTH = 6
STATE = 8
ATTENTION = 8
_MIX = 0x9E3779B97F4A7C15


def hashed_words(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket per word, and the buckets of its character n-grams with the number per word.

    N-grams run over the UTF-8 bytes of the word between two marks.
    """
    encoded = [b"<" + w.encode("utf-8", "surrogatepass") + b">" for w in words]
    lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
    octets = np.frombuffer(b"".join(encoded), np.uint8).astype(np.uint64)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(encoded)), lengths)
    room = ends[owner] - np.arange(len(octets))
    grams, owners = [], []
    for n in GRAM_SIZES:
        value = np.full(len(octets), n, np.uint64)
        for i in range(n):
            shifted = np.zeros(len(octets), np.uint64)
            shifted[: len(octets) - i] = octets[i:]
            value = (value ^ shifted) * np.uint64(_MIX)
            value ^= value >> np.uint64(32)
        fits = room >= n
        grams.append((value[fits] % np.uint64(GRAM_BUCKETS)).astype(np.int64))
        owners.append(owner[fits])
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    # A word's own hash: sums over its bytes and places.
    place = (np.arange(len(octets)) - (ends - lengths)[owner] + 1).astype(np.uint64)
    mixed = (octets + place * np.uint64(257)) * np.uint64(_MIX)
    mixed ^= mixed >> np.uint64(29)
    whole = np.add.reduceat(mixed * np.uint64(_MIX), ends - lengths)
    buckets = ((whole ^ (whole >> np.uint64(32))) % np.uint64(WORD_BUCKETS)).astype(np.int64)
    return buckets, grams[order], np.bincount(owners, minlength=len(words))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(np.minimum(x, 30, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


@dataclass
class Network:
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def start(cls, word_scores: np.ndarray, gram_scores: np.ndarray, seed: int) -> Network:
        """Random weights; the first column of each embedding holds the given score of its bucket."""
        random = np.random.default_rng(seed)

        def draw(*shape: int, scale: float) -> np.ndarray:
            return (random.standard_normal(shape) * scale).astype(np.float32)

        words, grams = draw(WORD_BUCKETS, WIDTH, scale=0.05), draw(GRAM_BUCKETS, WIDTH, scale=0.05)
        words[:, 0], grams[:, 0] = word_scores, gram_scores
        weights = {"words": words, "grams": grams}
        for side in "fb":
            weights[f"x{side}"] = draw(2 * WIDTH, 3 * STATE, scale=0.4)
            weights[f"h{side}"] = draw(STATE, 3 * STATE, scale=0.3)
            weights[f"i{side}"] = np.zeros(3 * STATE, np.float32)
        weights["a"] = draw(2 * STATE, ATTENTION, scale=0.3)
        weights["v"] = draw(ATTENTION, scale=0.3)
        weights["o"] = draw(2 * STATE, scale=0.3)
        weights["c"] = np.zeros(1, np.float32)
        return cls(weights)

    def word_inputs(self, buckets: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """A row per word. Every word has an n-gram, as its marks count."""
        starts = np.cumsum(counts) - counts
        mean = np.add.reduceat(self.weights["grams"][grams], starts) / counts[:, None]
        return np.concatenate([self.weights["words"][buckets], mean], axis=1, dtype=np.float32)

    def gates(self, inputs: np.ndarray) -> np.ndarray:
        """What a word adds to the gates of both passes; enough to run the network."""
        found = np.empty((len(inputs), 6 * STATE), np.result_type(inputs, self.weights["xf"]))
        # One half at a time, as the words of a whole sample make large ones.
        for side, half in (("f", found[:, : 3 * STATE]), ("b", found[:, 3 * STATE :])):
            own = inputs @ self.weights[f"x{side}"]
            own += self.weights[f"i{side}"]
            half[:] = own
        return found

    def _pass(self, gates: np.ndarray, mask: np.ndarray, side: str, memory: list | None) -> np.ndarray:
        """States per step; ``gates`` is (steps, windows, 3 * STATE) in the order of reading."""
        recurrent = self.weights[f"h{side}"]
        state = np.zeros((gates.shape[1], STATE), np.float32)
        states = np.empty((*gates.shape[:2], STATE), np.float32)
        for t in range(len(gates)):
            from_state = state @ recurrent
            both = _sigmoid(gates[t, :, : 2 * STATE] + from_state[:, : 2 * STATE])
            update, reset = both[:, :STATE], both[:, STATE:]
            inner = from_state[:, 2 * STATE :]
            candidate = np.tanh(gates[t, :, 2 * STATE :] + reset * inner)
            changed = (1 - update) * (candidate - state) * mask[t]
            if memory is not None:
                memory.append((state, update, reset, inner, candidate))
            state = state + changed
            states[t] = state
        return states

    def run(self, gates: np.ndarray, index: np.ndarray, lengths: np.ndarray, memory: dict | None = None) -> np.ndarray:
        """Logit per window. ``index`` (windows, steps) holds rows of ``gates``."""
        steps = index.shape[1]
        mask = (np.arange(steps)[:, None] < lengths[None, :]).astype(np.float32)[:, :, None]
        given = gates[index.T]
        keep = {s: [] if memory is not None else None for s in "fb"}
        forward = self._pass(given[:, :, : 3 * STATE], mask, "f", keep["f"])
        backward = self._pass(given[::-1, :, 3 * STATE :], mask[::-1], "b", keep["b"])[::-1]
        states = np.concatenate([forward, backward], axis=2)
        hidden = np.tanh(states @ self.weights["a"])
        scores = hidden @ self.weights["v"] - 1e4 * (1 - mask[:, :, 0])
        scores = np.exp(scores - scores.max(axis=0))
        attention = scores * mask[:, :, 0]
        attention = attention / np.maximum(attention.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnd->nd", attention, states)
        if memory is not None:
            memory |= {"mask": mask, "keep": keep, "states": states, "hidden": hidden, "attention": attention, "pooled": pooled}
        return pooled @ self.weights["o"] + self.weights["c"][0]

    def _unroll(self, grad_states: np.ndarray, memory: list, mask: np.ndarray, side: str, grads: dict) -> np.ndarray:
        """Gradient of the gates, (steps, windows, 3 * STATE), in the order of reading."""
        recurrent = self.weights[f"h{side}"]
        out = np.empty((*grad_states.shape[:2], 3 * STATE), np.float32)
        carried = np.zeros(grad_states.shape[1:], np.float32)
        for t in range(len(memory) - 1, -1, -1):
            state, update, reset, inner, candidate = memory[t]
            total = (carried + grad_states[t])
            moved = total * mask[t]
            to_update = -moved * (candidate - state) * update * (1 - update)
            to_candidate = moved * (1 - update) * (1 - candidate**2)
            to_reset = to_candidate * inner * reset * (1 - reset)
            out[t] = np.concatenate([to_update, to_reset, to_candidate], axis=1)
            from_state = np.concatenate([to_update, to_reset, to_candidate * reset], axis=1)
            grads[f"h{side}"] += state.T @ from_state
            carried = total - moved * (1 - update) + from_state @ recurrent.T
        return out

    def gradients(
        self, words: tuple[np.ndarray, np.ndarray, np.ndarray], index: np.ndarray, lengths: np.ndarray, labels: np.ndarray
    ) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss; ``index`` holds places in ``words``."""
        w, memory = self.weights, {}
        inputs = self.word_inputs(*words)
        logits = self.run(self.gates(inputs), index, lengths, memory)
        error = ((1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) / len(labels)).astype(np.float32)
        grads = {k: np.zeros_like(x) for k, x in w.items()}
        states, attention, hidden = memory["states"], memory["attention"], memory["hidden"]
        grads["o"], grads["c"] = memory["pooled"].T @ error, np.array([error.sum()], np.float32)
        to_pooled = error[:, None] * w["o"]
        to_states = attention[:, :, None] * to_pooled
        to_attention = np.einsum("tnd,nd->tn", states, to_pooled)
        to_scores = attention * (to_attention - (attention * to_attention).sum(axis=0))
        grads["v"] = np.einsum("tna,tn->a", hidden, to_scores)
        to_hidden = to_scores[:, :, None] * w["v"] * (1 - hidden**2)
        grads["a"] = np.einsum("tnd,tna->da", states, to_hidden)
        to_states = to_states + to_hidden @ w["a"].T
        mask, keep = memory["mask"], memory["keep"]
        forward = self._unroll(to_states[:, :, :STATE], keep["f"], mask, "f", grads)
        backward = self._unroll(to_states[::-1, :, STATE:], keep["b"], mask[::-1], "b", grads)[::-1]
        to_gates = np.zeros((len(inputs), 6 * STATE), np.float32)
        np.add.at(to_gates, index.T.ravel(), np.concatenate([forward, backward], axis=2).reshape(-1, 6 * STATE))
        to_inputs = np.zeros_like(inputs)
        for side, part in (("f", to_gates[:, : 3 * STATE]), ("b", to_gates[:, 3 * STATE :])):
            grads[f"x{side}"] = inputs.T @ part
            grads[f"i{side}"] = part.sum(axis=0)
            to_inputs += part @ w[f"x{side}"].T
        buckets, grams, counts = words
        np.add.at(grads["words"], buckets, to_inputs[:, :WIDTH])
        np.add.at(grads["grams"], grams, np.repeat(to_inputs[:, WIDTH:] / counts[:, None], counts, axis=0))
        return grads


@dataclass
class Adam:
    """Steps of adaptive size for all weights of a network."""

    network: Network
    rate: float
    step: int = 0
    means: dict = field(default_factory=dict)
    squares: dict = field(default_factory=dict)

    def apply(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        for name, g in grads.items():
            mean = self.means[name] = 0.9 * self.means.get(name, 0) + 0.1 * g
            square = self.squares[name] = 0.999 * self.squares.get(name, 0) + 0.001 * g * g
            fitted = mean / (1 - 0.9**self.step)
            spread = np.sqrt(square / (1 - 0.999**self.step)) + 1e-8
            self.network.weights[name] -= (self.rate * fitted / spread).astype(np.float32)
