"""Language of a text: averaged embeddings of hashed subwords and a linear softmax.

A text is lower-cased; runs of letters and marks are words, everything else is a gap. Its
subwords are the character n-grams inside a word, where the gap before and after the word counts
as a character. Each is hashed to one of ``BUCKETS`` embeddings, the text is their mean, and a
linear softmax gives a probability per language. Embeddings and softmax are trained together by
stochastic gradient descent on pieces of a bounded sample of texts. Pieces kept from training
calibrate the probabilities (one temperature) and set the confidence below which a prediction is
rejected.

The mean and the softmax are both linear, so a trained model is one table with a logit per
bucket and language: a text of any length is scored in one pass, in chunks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.tables import held_out, quoted

UNDETERMINED = "und"
#: Rows whose crc32 of the id has this remainder are never learnt from.
FOLDS, HELD_OUT_FOLD = 5, 0
#: The training sample: this many texts per language, and of a long text a piece of this many characters.
PER_LANGUAGE = 600
PIECE_CHARS = 2_048
#: A prediction is rejected below the confidence at which this share of the accepted ones is right.
PRECISION = 0.99
N_GRAMS = (2, 3, 4)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
DIMENSION = 16
STEPS = 400
BATCH = 48
RATE = 5.0
MAX_STEP = 0.5
MIN_CROP = 12
SEED = 20_261_202
_GAP = 32
_CHUNK = 1 << 18  # subwords gathered at once
_GROUP = 1 << 19  # characters of the texts scored together


@cache
def _kinds() -> np.ndarray:
    """Per code point: 2 for a letter, 1 for a mark inside words, 0 for all else."""
    found = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind in "LM":
            found[i] = 2 if kind == "L" else 1
    return found


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def has_letter(text: str | None) -> bool:
    """Does the text hold a letter, in any script?"""
    return bool(text) and any(map(str.isalpha, text))


def folded(text: str) -> np.ndarray:
    """Code points of the words of a text, with one gap before, between and after them."""
    points = _points(text)
    inside = _kinds()[points] > 0
    # A gap stays if a word ends before it.
    stays = inside.copy()
    stays[1:] |= inside[:-1]
    words = np.where(inside, points, _GAP)[stays]
    closed = len(words) and words[-1] == _GAP
    return np.concatenate([[_GAP], words, [] if closed else [_GAP]]).astype(np.uint32)


def subwords(chars: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, buckets) of the n-grams of folded characters, per length of n-gram."""
    gap = chars == _GAP
    found = []
    for n in N_GRAMS:
        count = len(chars) - n + 1
        if count <= 0:
            continue
        mixed = np.full(count, n * 0x9E3779B1 % 2**32, np.uint32)
        crosses = np.zeros(count, bool)
        for i in range(n):
            mixed = (mixed ^ chars[i : i + count]) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(13)
            if 0 < i < n - 1:
                crosses |= gap[i : i + count]
        if n == 2:
            crosses = gap[:count] & gap[1:]
        places = np.flatnonzero(~crosses)
        mixed = mixed[places] * np.uint32(0xC2B2AE35)
        found.append((places, (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)))
    return found


def buckets_of(text: str) -> np.ndarray:
    return np.concatenate([b for _, b in subwords(folded(text))])


def _softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class Model:
    """Languages in order, a logit per bucket and language, and the calibration."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    #: Predictions of less confidence are rejected.
    least: float = 0.0

    def logits(self, texts: list[str]) -> np.ndarray:
        """Mean logits per text; the bias alone for one without words."""
        found = np.tile(self.bias, (len(texts), 1))
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= _GROUP):
                size += len(texts[end])
                end += 1
            found[at:end] += self._means(texts[at:end])
            at = end
        return found

    def _means(self, texts: list[str]) -> np.ndarray:
        # Each text brings its own gaps; n-grams across the gap of two texts are left out.
        parts = [folded(t) for t in texts]
        ends = np.cumsum([len(p) for p in parts])
        chars = np.concatenate(parts)
        sums, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for places, buckets in subwords(chars):
            for start in range(0, len(places), _CHUNK):
                owner = np.searchsorted(ends, places[start : start + _CHUNK], "right")
                firsts = np.flatnonzero(np.diff(owner, prepend=-1))
                values = self.table[buckets[start : start + _CHUNK]]
                sums[owner[firsts]] += np.add.reduceat(values, firsts, axis=0)
                counts += np.bincount(owner, minlength=len(texts))
        return sums / np.maximum(counts, 1)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, is the prediction rejected) per text."""
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        languages, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if self.languages and known:
            chances = _softmax(self.logits([texts[i] for i in known]) / self.temperature)
            for i, best, chance in zip(known, chances.argmax(axis=1), chances.max(axis=1)):
                languages[i], scores[i] = self.languages[best], min(1.0, chance)
        return languages, scores, (scores < self.least) | (np.array(languages) == UNDETERMINED)


def training_pieces(
    docs: DataFrame,
    per_language: int = PER_LANGUAGE,
    chars: int = PIECE_CHARS,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> list[tuple[str, str]]:
    """(lang, piece) of at most ``per_language`` texts per language, drawn by a hash of their id.

    Held-out ids, null ids and null languages are not drawn. A text longer than ``chars`` gives
    the piece at a place that a hash chooses; rows that share id and language give one piece.
    """
    rows = docs.select(
        quoted(doc_id).alias("id"), quoted(lang).cast("string").alias("lang"), quoted(text).alias("text")
    ).filter("id is not null and lang is not null")
    rows = rows.filter(~held_out(F.col("id"), FOLDS, HELD_OUT_FOLD))
    turn = F.xxhash64(F.col("id").cast("string"), F.lit(SEED))
    known = rows.select("id", "lang").distinct().withColumn("turn", turn)
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # A share of the ids that holds the wanted number with room to spare, so that no language is sorted whole.
    near = F.pmod("turn", F.lit(1 << 30)) * F.col("n") < F.lit(4 * per_language * (1 << 30)).cast("decimal(20,0)")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("turn", "id"))
    drawn = known.join(F.broadcast(counts), "lang").filter(near).withColumn("place", place).filter(F.col("place") <= per_language)
    wanted = drawn.select(F.col("id").alias("drawn_id"), F.col("lang").alias("drawn_lang"), "turn")
    start = F.pmod(F.xxhash64("turn"), F.greatest(F.length("text") - chars + 1, F.lit(1))).cast("int") + 1
    found = (
        rows.join(F.broadcast(wanted), (F.col("id") == F.col("drawn_id")) & (F.col("lang") == F.col("drawn_lang")))
        .groupBy("lang", "turn", "id")
        .agg(F.min(F.col("text").substr(start, F.lit(chars))).alias("piece"))
        .orderBy("lang", "turn", "id")
    )
    return [(r["lang"], r["piece"]) for r in found.collect() if has_letter(r["piece"])]


def _crop(piece: str, random: np.random.Generator) -> str:
    """A stretch of the piece, short ones as likely as long ones."""
    if len(piece) <= MIN_CROP:
        return piece
    size = int(np.exp(random.uniform(np.log(MIN_CROP), np.log(len(piece)))))
    start = int(random.integers(0, len(piece) - size + 1))
    return piece[start : start + size]


def gradients(
    embeddings: np.ndarray, weights: np.ndarray, bias: np.ndarray, bags: list[np.ndarray], labels: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(loss, buckets used, gradients of their embeddings, of the weights, of the bias), summed over ``bags``."""
    used, share = _shares(bags, embeddings.dtype)
    means = share @ embeddings[used]
    chances = _softmax(means @ weights + bias)
    rows = np.arange(len(bags))
    loss = -float(np.log(np.maximum(chances[rows, labels], 1e-30)).sum())
    chances[rows, labels] -= 1
    return loss, used, share.T @ (chances @ weights.T), means.T @ chances, chances.sum(axis=0)


def _shares(bags: list[np.ndarray], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all bags, and how much of each bag each of them makes up."""
    used, local = np.unique(np.concatenate(bags), return_inverse=True)
    owner = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    share = np.zeros((len(bags), len(used)), kind)
    np.add.at(share, (owner, local), 1)
    return used, share / np.array([max(1, len(b)) for b in bags], kind)[:, None]


def _bounded(step: np.ndarray, most: float) -> np.ndarray:
    """``step``, shortened so that no row is longer than ``most``."""
    longest = np.sqrt((step * step).sum(axis=1).max(initial=0))
    return step * np.float32(most / longest) if longest > most else step


def train(pieces: list[tuple[str, str]], steps: int = STEPS, precision: float = PRECISION) -> Model:
    """Fit embeddings and softmax to four fifths of the pieces and calibrate on the others."""
    languages = sorted({lang for lang, _ in pieces})
    if len(languages) < 2:
        return Model(languages, np.zeros((BUCKETS, len(languages)), np.float32), np.zeros(len(languages)))
    random = np.random.default_rng(SEED)
    by_language = [[p for lang, p in pieces if lang == name] for name in languages]
    held = [own[::5] if len(own) >= 5 else own for own in by_language]
    fitted = [[p for i, p in enumerate(own) if i % 5] if len(own) >= 5 else own for own in by_language]
    embeddings = random.uniform(-1, 1, (BUCKETS, DIMENSION)).astype(np.float32) / DIMENSION
    weights = np.zeros((DIMENSION, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    for step in range(steps):
        labels = random.integers(0, len(languages), BATCH)
        crops = [_crop(fitted[y][random.integers(0, len(fitted[y]))], random) for y in labels]
        bags = [buckets_of(c) for c in crops]
        _, used, of_rows, of_weights, of_bias = gradients(embeddings, weights, bias, bags, labels)
        rate = np.float32(RATE * (1 - step / steps))
        # Few different subwords add up in a batch: neither they nor the weights move by leaps.
        embeddings[used] -= _bounded(rate * of_rows, MAX_STEP)
        weights -= _bounded(rate / BATCH * of_weights, MAX_STEP)
        bias -= rate / BATCH * of_bias
    model = Model(languages, embeddings @ weights, bias.astype(float))
    return calibrated(model, held, random, precision)


def calibrated(model: Model, held: list[list[str]], random: np.random.Generator, precision: float) -> Model:
    """``model`` with the temperature and the least confidence that fit the held pieces."""
    crops = [(y, c) for y, own in enumerate(held) for p in own for c in (p, _crop(p, random), _crop(p, random)) if has_letter(c)]
    if not crops:
        return model
    labels = np.array([y for y, _ in crops])
    logits = model.logits([c for _, c in crops])
    rows = np.arange(len(labels))
    tried = np.exp(np.linspace(np.log(0.2), np.log(20), 200))
    losses = [-np.log(np.maximum(_softmax(logits / t)[rows, labels], 1e-30)).mean() for t in tried]
    temperature = float(tried[int(np.argmin(losses))])
    chances = _softmax(logits / temperature)
    order = np.argsort(-chances.max(axis=1), kind="stable")
    right = np.cumsum((chances.argmax(axis=1) == labels)[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(right >= precision)
    least = float(chances.max(axis=1)[order[enough[-1]]]) if len(enough) else 1.0
    return Model(model.languages, model.table, model.bias, temperature, least)


def labelled(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) per row of ``docs``, from whole texts.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if no
    language was learnt. Other texts get a learnt language; ``rejected`` marks those whose
    calibrated confidence is too low, and the undetermined ones.
    """
    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores, rejected = model.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages, pa.string()), pa.array(scores), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) per row of ``docs``; learns from rows that are not held out.

    Of a prediction only the text is an input. Repeated rows give repeated rows; a null id is
    neither held out nor learnt from. No documents: no rows.
    """
    model = train(training_pieces(docs, per_language, PIECE_CHARS, doc_id, text, lang))
    is_held = held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD).alias("held_out")
    return labelled(docs, model, doc_id, text).select("doc_id", is_held, "lang_pred", "score", "rejected")
