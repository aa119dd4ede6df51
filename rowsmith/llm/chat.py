"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as

    <|turn|>ROLE<|text|>TEXT<|end|>   per turn, in order

with roles and texts escaped so that no control string can occur inside them. The rendering is
encoded once with offsets, control strings being tokens of their own, and the sorted spans of
the assistant's texts are met with the sorted token spans by binary search. As no token reaches
across a control token, the mask covers the assistant's texts exactly.

Rows are grouped by conversation and sorted inside the partition; a task streams over them and
holds a run of turns, not a conversation. Because control tokens split the rendering, encoding it
run by run gives the tokens of the whole. The runs, with their ids, offsets and mask, are the
result; digests are read back from them.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.tables import quoted

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROLS = (TURN, TEXT, END)
ASSISTANT = "assistant"
#: Characters rendered before they are encoded; a single longer turn is taken whole.
WINDOW_CHARS = 1 << 18
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """A text without the start of any control string. ``unescape`` gives the text back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> str:
    return f"{TURN}{escape(role)}{TEXT}{escape(text)}{END}"


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) per turn of a rendering."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix(TURN).partition(TEXT)
        turns.append((unescape(role), unescape(text)))
    return turns


def load_tokenizer(path: str = TOKENIZER):
    """The tokenizer with the control strings as tokens of their own."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens(list(CONTROLS))
    return tokenizer


def text_spans(formatted: str) -> list[tuple[str, int, int]]:
    """(role, start, end) of each turn's text inside a rendering, in order."""
    found, role, start = [], "", 0
    for match in _CONTROL.finditer(formatted):
        if match[0] == TURN:
            start = match.end()
        elif match[0] == TEXT:
            role, start = unescape(formatted[start : match.start()]), match.end()
        else:
            found.append((role, start, match.start()))
    return found


def masked_tokens(
    spans: list[tuple[int, int]], offsets: list[tuple[int, int]]
) -> list[tuple[int, int]]:
    """(first, last + 1) token that meets each span; both lists are sorted. Empty spans meet none."""
    starts, ends = [s for s, _ in offsets], [e for _, e in offsets]
    return [
        (bisect_right(ends, start), bisect_left(starts, end)) if end > start else (0, 0) for start, end in spans
    ]


def _sorted_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    plain = turns.select(
        quoted(conv_id).alias("conv_id"),
        quoted(turn).alias("turn"),
        F.coalesce(quoted(role), F.lit("")).alias("role"),
        F.coalesce(quoted(text), F.lit("")).alias("text"),
    )
    return plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def runs_of(rows: Iterator[tuple], window: int = WINDOW_CHARS) -> Iterator[tuple]:
    """(conversation, number of the run, rendering) of whole turns, for rows (conversation, role, text) in order."""
    current, number, waiting, size, started = None, 0, [], 0, False
    for key, role, text in rows:
        if started and key != current:
            if waiting:
                yield current, number, "".join(waiting)
            number, waiting, size = 0, [], 0
        current, started = key, True
        waiting.append(render(role, text))
        size += len(waiting[-1])
        if size >= window:
            yield current, number, "".join(waiting)
            number, waiting, size = number + 1, [], 0
    if waiting:
        yield current, number, "".join(waiting)


def loss_mask(formatted: str, offsets: list[tuple[int, int]]) -> list[bool]:
    """Which tokens of a rendering are part of an assistant's text."""
    mask = [False] * len(offsets)
    spans = [(s, e) for role, s, e in text_spans(formatted) if role == ASSISTANT]
    for first, last in masked_tokens(spans, offsets):
        mask[first:last] = [True] * (last - first)
    return mask


def format_conversations(
    turns: DataFrame,
    tokenizer_path: str = TOKENIZER,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    window: int = WINDOW_CHARS,
) -> DataFrame:
    """(conv_id, run, formatted, ids, starts, ends, loss): a row per run of turns of a conversation.

    The runs of a conversation in order, joined end to end, are its rendering, its token ids and
    its loss mask; starts and ends are the places of the tokens in the run. Null ids are one
    conversation. Turns go by number, null first, then role and text, so rows with one number have
    a fixed order and repeated rows repeat the turn. Null roles and texts are empty. A single turn
    longer than ``window`` characters is a run of its own. No rows: no conversations.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, kind = None, pa.null()

        def rows() -> Iterator[tuple]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield from zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)))

        done, size = [], 0
        for key, number, formatted in runs_of(rows(), window):
            tokenizer = tokenizer or load_tokenizer(tokenizer_path)
            encoding = tokenizer.encode(formatted, add_special_tokens=False)
            offsets = encoding.offsets
            done.append(
                (key, number, formatted, encoding.ids, [s for s, _ in offsets], [e for _, e in offsets], loss_mask(formatted, offsets))
            )
            size += len(formatted)
            if size >= window:
                yield _runs_batch(done, kind)
                done, size = [], 0
        if done:
            yield _runs_batch(done, kind)

    kind = turns.schema[conv_id].dataType.simpleString()
    return _sorted_turns(turns, conv_id, turn, role, text).mapInArrow(
        run, f"conv_id {kind}, run int, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
    )


def _runs_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    numbers = pa.list_(pa.int32())
    kinds = (kind, pa.int32(), pa.string(), numbers, numbers, numbers, pa.list_(pa.bool_()))
    names = ["conv_id", "run", "formatted", "ids", "starts", "ends", "loss"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def masked_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The texts under the mask, unescaped: one per stretch of masked tokens."""
    edges = np.flatnonzero(np.diff(loss.astype(np.int8), prepend=0, append=0))
    return [unescape(formatted[starts[a] : ends[b - 1]]) for a, b in zip(edges[::2], edges[1::2])]


@dataclass
class Conversation:
    """What is read back from the runs of one conversation."""

    n_turns: int = 0
    chars: int = 0
    loss_chars: int = 0
    turns_hash: object = field(default_factory=hashlib.sha256)
    loss_hash: object = field(default_factory=hashlib.sha256)

    def add(self, formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> None:
        for text in masked_texts(formatted, starts, ends, loss):
            self.loss_chars += len(text)
            self.loss_hash.update(text.encode("utf-8", "surrogatepass"))
        for role, text in parse(formatted):
            self.n_turns += 1
            self.turns_hash.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.chars += len(formatted)

    def row(self) -> tuple:
        return (self.n_turns, self.turns_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars)


def digests(runs: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of ``format_conversations``.

    Rows come as that function leaves them, the runs of a conversation one after the other in one
    partition; a hash is all that is kept of those before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, done, kind = None, None, [], pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            keys, texts = (batch.column(i).to_pylist() for i in (0, 2))
            for i, key in enumerate(keys):
                if state is None or key != current:
                    if state is not None:
                        done.append((current, *state.row()))
                    current, state = key, Conversation()
                state.add(texts[i], *(batch.column(j)[i].values.to_numpy(zero_copy_only=False) for j in (4, 5, 6)))
            if len(done) >= 1_000:
                yield _digests_batch(done, kind)
                done = []
        if state is not None:
            yield _digests_batch([*done, (current, *state.row())], kind)

    kind = runs.schema["conv_id"].dataType.simpleString()
    narrow = runs.select("conv_id", "run", "formatted", "ids", "starts", "ends", "loss")
    return narrow.mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def _digests_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
