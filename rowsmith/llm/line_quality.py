"""Document quality by a conditional random field over lines.

Every line of a whole text is labelled good or bad from features of its own and of its
neighbours; forward-backward gives the chance of good per line, and their mean, weighted by
length, is the quality of the text. A logistic curve fitted on the training sample turns it into
a probability. The field is trained on the driver from a bounded sample of labelled texts whose
lines take the label of their text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.crf import Chains, LineField, fit
from rowsmith.llm.supervision import Sample, calibrate, labelled_sample, logistic
from rowsmith.llm.tables import held_out, quoted

#: Bound of the sample of labelled texts, per class.
PER_CLASS = 1_500
THRESHOLD = 0.7
_GROUP = 1 << 22  # characters of the texts that are labelled together
_UPPER = bytes(range(65, 91))
_LETTER = _UPPER + bytes(range(97, 123))
_DIGIT = b"0123456789"
_SYMBOL = b"#*$%&|<>{}[]=_~^\\/@"
N_OWN = 20


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(own features of each line, length of each line in bytes). An empty text is one empty line."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    seen: set[bytes] = set()
    found = np.zeros((len(lines), N_OWN))
    lengths = np.empty(len(lines))
    for i, line in enumerate(lines):
        words = line.split()
        n, chars = len(words), len(line)
        lengths[i] = chars
        if not n:
            found[i, 0] = 1
            continue
        solid = chars - line.count(b" ")
        letters = solid - len(line.translate(None, _LETTER)) + line.count(b" ")
        upper = chars - len(line.translate(None, _UPPER))
        digits = chars - len(line.translate(None, _DIGIT))
        symbols = chars - len(line.translate(None, _SYMBOL))
        high = sum(1 for b in (line.decode("utf-8", "replace") if not line.isascii() else "") if b > "\x7f")
        again = sum(map(bytes.__eq__, words, words[1:]))
        known = set(words)
        ends = line.rstrip()[-1:] in (b".", b"!", b"?", b'"', b"'", b")")
        shares = (
            symbols / solid, upper / max(1, letters), digits / solid, high / solid,
            line.count(b"!") / n, again / n, 1 - len(known) / n, words.count(b"|") / n,
        )
        found[i, 1:9] = shares
        found[i, 9:14] = [min(1.0, 8 * x) for x in (shares[0], shares[1], shares[4], shares[5], shares[7])]
        found[i, 14] = np.log1p(n) / 5
        found[i, 15] = solid / n / 10
        found[i, 16] = line in seen
        found[i, 17] = ends
        found[i, 18] = n < 4
        found[i, 19] = solid / n > 12
        seen.add(line)
    return found, lengths


def with_neighbours(own: list[np.ndarray]) -> tuple[np.ndarray, Chains]:
    """Features of each line beside those of the lines before and after, and a constant."""
    lengths = np.array([len(x) for x in own], np.int64)
    flat = np.concatenate(own) if own else np.zeros((0, N_OWN))
    first = np.zeros(len(flat) + 1, bool)
    first[np.cumsum(lengths)] = True
    first[0] = True
    before = np.zeros_like(flat)
    before[1:] = flat[:-1]
    before[first[:-1]] = 0
    after = np.zeros_like(flat)
    after[:-1] = flat[1:]
    after[first[1:]] = 0
    return np.concatenate([flat, before, after, np.ones((len(flat), 1))], axis=1), Chains(lengths)


@dataclass
class Judge:
    """A trained field with its calibration. Without a field the score is constant."""

    field: LineField | None
    slope: float = 1.0
    shift: float = 0.0

    def lines(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(chance of good, length) of each line, per text."""
        found = [line_features(t) for t in texts]
        features, chains = with_neighbours([f for f, _ in found])
        good = self.field.good(features, chains)
        return list(zip(np.split(good, np.cumsum(chains.lengths)[:-1]), [n for _, n in found]))

    def raw(self, texts: list[str]) -> np.ndarray:
        """Log odds of the length-weighted mean chance of good, per text."""
        shares = [((good * (n + 1)).sum() / (n + 1).sum()) for good, n in self.lines(texts)]
        shares = np.clip(np.array(shares, float), 1e-4, 1 - 1e-4)
        return np.log(shares / (1 - shares))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.field is None:
            return np.full(len(texts), logistic(np.array(self.shift)))
        out, at, plain = [], 0, [t or "" for t in texts]
        while at < len(plain):
            end, size = at, 0
            while end < len(plain) and (end == at or size + len(plain[end]) <= _GROUP):
                size += len(plain[end])
                end += 1
            out.append(self.raw(plain[at:end]))
            at = end
        return logistic(self.slope * np.concatenate(out or [np.zeros(0)]) + self.shift)


def train(sample: Sample) -> Judge:
    """Fit a judge; constant if a class is missing."""
    labels = sample.labels
    if len(np.unique(labels)) < 2:
        share = (sample.class_rows[1] + 0.5) / (sum(sample.class_rows) + 1)
        return Judge(None, shift=float(np.log(share / (1 - share))))
    found = [line_features(t) for t in sample.texts]
    features, chains = with_neighbours([f for f, _ in found])
    # A text weighs the same however many lines it has; its long lines weigh more.
    weights = np.concatenate([(n + 1) / (n + 1).sum() for _, n in found])
    balance = len(labels) / (2 * np.bincount(labels, minlength=2))
    weights *= np.repeat(balance[labels], chains.lengths)
    judge = Judge(fit(features, np.repeat(labels, chains.lengths), weights, chains))
    slope, shift = calibrate(judge.raw(sample.texts), labels, sample.weights)
    return Judge(judge.field, slope, shift)


def scored(docs: DataFrame, judge: Judge, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) per row."""
    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judge.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    return narrow.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double")


def line_labels(docs: DataFrame, judge: Judge, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line, good): the chance that a line, counted from 0, is good."""
    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text_ in enumerate(batch.column(1).to_pylist()):
                good = judge.lines([text_ or ""])[0][0] if judge.field else judge.scores([text_])
                at = pa.array(np.full(len(good), row))
                columns = [batch.column(0).take(at), pa.array(np.arange(len(good), dtype=np.int32)), pa.array(good)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "line", "good"])

    return narrow.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, line int, good double")


def fitted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Judge:
    return train(labelled_sample(docs, labels, label, PER_CLASS, doc_id, text))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    A null text is empty, and an empty text is one empty line. Labels of held-out ids are not
    learnt. If a class has no labelled rows, all scores are the share of good labels. Repeated
    rows give repeated rows. No documents: no rows.
    """
    return scored(docs, fitted(docs, labels, doc_id, text), doc_id, text).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
