"""Toxicity by a recurrent network over all overlapping windows of a text.

The network (``gru``) is trained on the driver from a bounded sample of labelled texts. Labels
are those of whole texts, so training picks windows: those of a toxic text that look most toxic
to the model so far, and of clean texts the hardest and some drawn at random. A text's raw score
is its most toxic window's; a logistic curve fitted on the same sample turns it into a
probability. Scoring reads Arrow batches and keeps the gate inputs of words it has met.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.gru import GRAM_BUCKETS, STATE, WORD_BUCKETS, Adam, Network, hashed_words
from rowsmith.llm.supervision import Sample, calibrate, labelled_sample, logistic
from rowsmith.llm.tables import fresh, held_out, quoted

WINDOW = 32
STRIDE = 16
#: Bound of the sample of labelled texts, per class.
PER_CLASS = 1_500
EPOCHS = 7
#: A small sample is passed through more often, up to this many steps.
MIN_STEPS = 400
BATCH = 128
RATE = 0.01
#: Texts of either class that every word and n-gram is taken to have been seen in.
PRIOR_TEXTS = 6
#: One in so many texts of the sample is kept for the calibration.
CALIBRATION = 5
SEED = 20_240_603
THRESHOLD = 0.3
_KNOWN_WORDS = 1 << 18
_WORDS = 1 << 13  # words whose n-grams are held as 64-bit numbers at once
_RUN = 2_048  # windows run at once
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return _LETTERS.findall((text or "").lower())


def windows(n: int) -> list[tuple[int, int]]:
    """(start, length) of the overlapping windows that cover ``n`` words; one empty window for none."""
    starts = range(0, max(1, n - WINDOW + STRIDE), STRIDE)
    return [(s, min(WINDOW, n - s)) for s in starts]


def window_logits(network: Network, gates: np.ndarray, rows: list[np.ndarray]) -> list[np.ndarray]:
    """Logits of all windows of each text, given as rows of ``gates``; row 0 fills up short windows."""
    spans = [windows(len(r)) for r in rows]
    total = sum(map(len, spans))
    index, lengths = np.zeros((total, WINDOW), np.int32), np.zeros(total, np.int32)
    at = 0
    for row, span in zip(rows, spans):
        padded = np.zeros(span[-1][0] + WINDOW, np.int32)
        padded[: len(row)] = row
        index[at : at + len(span)] = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]
        lengths[at : at + len(span)] = [n for _, n in span]
        at += len(span)
    found = [network.run(gates, index[i : i + _RUN], lengths[i : i + _RUN]) for i in range(0, total, _RUN)]
    return np.split(np.concatenate(found), np.cumsum([len(s) for s in spans])[:-1])


@dataclass
class Scorer:
    """A trained network with its calibration. Without a network the score is constant."""

    network: Network | None
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self):
        self.forget()

    def forget(self) -> None:
        """Drop the words met so far, so that they take bounded memory."""
        self.known: dict[str, int] = {}
        self.gates = np.zeros((1, 6 * STATE), np.float32)

    def __getstate__(self):
        return {"network": self.network, "slope": self.slope, "shift": self.shift}

    def __setstate__(self, state):
        self.__init__(**state)

    def _rows(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of ``gates`` for the words of each text; row 0 stands for no word."""
        if len(self.known) > _KNOWN_WORDS:
            self.forget()
        new = list({w for words in texts for w in words if w not in self.known})
        if new:
            start, end = len(self.known) + 1, len(self.known) + 1 + len(new)
            self.known.update(zip(new, range(start, end)))
            if end > len(self.gates):
                grown = np.zeros((2 * end, 6 * STATE), np.float32)
                grown[:start] = self.gates[:start]
                self.gates = grown
            self.gates[start:end] = self.network.gates(self.network.word_inputs(*hashed_words(new)))
        find = self.known.__getitem__
        return [np.fromiter(map(find, words), np.int32, len(words)) for words in texts]

    def window_logits(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Logits of all windows of each text."""
        rows = self._rows(texts)
        return window_logits(self.network, self.gates, rows)

    def raw(self, texts: list[list[str]]) -> np.ndarray:
        """Logit of the most toxic window per text. Texts are taken in groups of bounded size."""
        out, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size < 1 << 17):
                size += len(texts[end]) + WINDOW
                end += 1
            out += [x.max() for x in self.window_logits(texts[at:end])]
            at = end
        return np.array(out, float)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), logistic(np.array(self.shift)))
        out = np.empty(len(texts))
        # Words of a few texts at a time, as a batch may hold many long ones.
        for at in range(0, len(texts), 64):
            out[at : at + 64] = self.raw([words_of(t) for t in texts[at : at + 64]])
        return logistic(self.slope * out + self.shift)


@dataclass
class Corpus:
    """Texts as numbers of their different words, from 1; 0 is no word. Holds each word once."""

    rows: list[np.ndarray]
    labels: np.ndarray
    buckets: np.ndarray
    grams: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, texts: list[str], labels: np.ndarray) -> Corpus:
        place: dict[str, int] = {" ": 0}
        rows = [
            np.array([place.setdefault(w, len(place)) for w in words_of(t)], np.int32) for t in texts
        ]
        words = list(place)
        parts = [
            [x.astype(np.int32) for x in hashed_words(words[at : at + _WORDS])] for at in range(0, len(words), _WORDS)
        ]
        return cls(rows, labels, *[np.concatenate([p[k] for p in parts]) for k in range(3)])

    def __post_init__(self):
        self.starts = np.cumsum(self.counts, dtype=np.int64) - self.counts

    def grams_of(self, words: np.ndarray) -> np.ndarray:
        """Buckets of the n-grams of some words, one word after the other."""
        n = self.counts[words]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.grams[np.repeat(self.starts[words], n) + inside]

    def inputs(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.buckets[words], self.grams_of(words), self.counts[words]

    def word_inputs(self, network: Network) -> np.ndarray:
        """The network's inputs of all words."""
        every = np.arange(len(self.counts))
        parts = [every[at : at + _WORDS] for at in range(0, len(every), _WORDS)]
        return np.concatenate([network.word_inputs(*self.inputs(part)) for part in parts])

    def logits(self, network: Network, which: np.ndarray) -> list[np.ndarray]:
        """Logits of all windows of some texts."""
        gates = network.gates(self.word_inputs(network))
        found = []
        for at in range(0, len(which), 64):
            found += window_logits(network, gates, [self.rows[i] for i in which[at : at + 64]])
        return found

    def log_odds(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How much likelier a bucket is in a toxic than in a clean text, of words and of n-grams.

        Near 0 for what few texts have.
        """
        seen = [np.zeros((2, n)) for n in (WORD_BUCKETS, GRAM_BUCKETS)]
        for i in which:
            words = np.unique(self.rows[i])
            seen[0][self.labels[i], np.unique(self.buckets[words])] += 1
            seen[1][self.labels[i], np.unique(self.grams_of(words))] += 1
        rate = np.bincount(self.labels[which], minlength=2)[:, None] / len(which)
        shares = [(x + PRIOR_TEXTS * rate) / rate for x in seen]
        return tuple((np.clip(np.log(x[1] / x[0]), -2, 4) / 2).astype(np.float32) for x in shares)


def train(sample: Sample, epochs: int = EPOCHS) -> Scorer:
    """Fit a scorer on most of the sample and calibrate it on the rest; constant if a class is missing."""
    labels = sample.labels
    if len(np.unique(labels)) < 2:
        share = (sample.class_rows[1] + 0.5) / (sum(sample.class_rows) + 1)
        return Scorer(None, shift=float(np.log(share / (1 - share))))
    corpus = Corpus.of(sample.texts, labels)
    # The same share of both classes; a class of few texts is used for both.
    place = np.empty(len(labels), np.int64)
    for y in (0, 1):
        own = np.flatnonzero(labels == y)
        place[own] = np.arange(len(own))
    rest = place % CALIBRATION == CALIBRATION - 1
    if len(np.unique(labels[rest])) < 2:
        rest = np.ones(len(labels), bool)
    trained = ~rest if not rest.all() else rest
    network = _fit(corpus, np.flatnonzero(trained), epochs)
    raw = np.array([x.max() for x in corpus.logits(network, np.flatnonzero(rest))], float)
    slope, shift = calibrate(raw, labels[rest], sample.weights[rest])
    return Scorer(network, slope, shift)


def _fit(corpus: Corpus, which: np.ndarray, epochs: int) -> Network:
    random = np.random.default_rng(SEED)
    labels = corpus.labels[which]
    network = Network.start(*corpus.log_odds(which), SEED)
    first = corpus.word_inputs(network)
    hint = first[:, 0] + 2 * first[:, first.shape[1] // 2]
    guesses = [
        np.array([np.sort(hint[r[s : s + n]])[-3:].sum() if n else -9.0 for s, n in windows(len(r))])
        for r in (corpus.rows[i] for i in which)
    ]
    steps = Adam(network, RATE)
    per_epoch = sum(min(len(g), 2 if y else 6) for g, y in zip(guesses, labels)) / BATCH
    epochs = max(epochs, math.ceil(MIN_STEPS / max(1, math.ceil(per_epoch))))
    renewed = {epochs // 4, epochs // 2, 3 * epochs // 4} - {0}
    for epoch in range(epochs):
        if epoch in renewed:
            guesses = corpus.logits(network, which)
        chosen = []
        for d, guess, y in zip(which, guesses, labels):
            best = np.argsort(-guess)[: 2 if y and 2 * epoch < epochs else 1 if y else 4]
            drawn = [] if y else random.integers(0, len(guess), 2).tolist()
            chosen += [(d, i) for i in {*best.tolist(), *drawn}]
        order = random.permutation(len(chosen))
        for at in range(0, len(order), BATCH):
            _step(network, steps, [chosen[i] for i in order[at : at + BATCH]], corpus)
        steps.rate = RATE * 0.2 ** ((epoch + 1) / epochs)
    return network


def _step(network: Network, steps: Adam, batch: list[tuple[int, int]], corpus: Corpus) -> None:
    index, lengths = np.zeros((len(batch), WINDOW), np.int64), np.zeros(len(batch), np.int64)
    for i, (d, window) in enumerate(batch):
        part = corpus.rows[d][window * STRIDE : window * STRIDE + WINDOW]
        index[i, : len(part)], lengths[i] = part, len(part)
    used, local = np.unique(index, return_inverse=True)
    y = corpus.labels[[d for d, _ in batch]]
    steps.apply(network.gradients(corpus.inputs(used), local.reshape(index.shape), lengths, y))


def scored(docs: DataFrame, scorer: Scorer, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text; all columns pass through."""
    at, names = docs.columns.index(text), [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scorer.scores(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names)

    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(run, ", ".join([*fields, f"`{name}` double"]))


def fitted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Scorer:
    return train(labelled_sample(docs, labels, label, PER_CLASS, doc_id, text))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    A null text and one without letters are scored as one empty window. Labels of held-out ids
    are not learnt. If a class has no labelled rows, all scores are the share of toxic labels.
    Repeated rows give repeated rows. No documents: no rows.
    """
    scorer = fitted(docs, labels, doc_id, text)
    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    return scored(narrow, scorer).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents whose score reaches ``THRESHOLD``."""
    name = fresh(docs, "__score")
    found = scored(docs, fitted(docs, labels, doc_id, text), text, name)
    return found.filter(F.col(name) < THRESHOLD).select(*[quoted(c) for c in docs.columns])
