"""Chat formatting with a loss mask aligned by offsets.

A conversation is rendered whole and encoded once, and the character offsets of
its tokens are kept. The spans of the assistant's texts are sorted, as are the
tokens, so binary search finds the tokens that each span touches: these are
under the loss mask. What is learned is read back from mask and offsets alone:
the characters of each stretch of masked tokens, without the parts of control
strings that a token at its edge reaches into.

Control strings inside roles and texts get a backslash, which read_turns takes
off again: what looks like one after any number of backslashes gets one more.

Defined cases: null roles and texts count as empty; turns with equal numbers
follow each other by role and text, null numbers come first; a null conv_id is
a conversation; conversation and turn numbers are cast to long; an empty table
gives no rows. A conversation is one row of any length, held whole by one task;
where its text or ids would pass what a value can hold (2 GB), it raises.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loyaltide.llm.common import quoted, text_of
from loyaltide.llm.tokenfile import kept_encoder

ROLE, SAYS, END = "<s>[INST]", "[/INST]", "</s>"
LARGEST = (1 << 31) - 1  # bytes of a value
_CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
_ESCAPED = re.compile(r"([<\[])(\\*)\\(/?(?:s>|INST\]))")
_TEMPLATE = re.compile(r"</?s>|\[/?INST\]")  # texts hold none: theirs are escaped
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]], learned: str = "assistant") -> tuple[str, list[int], list[int]]:
    """The text of the turns, and where the texts of the learned role begin and end."""
    parts, begins, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{ROLE}{escape(role)}{SAYS}", escape(text)
        if role == learned:
            begins.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), begins, ends


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns behind a rendered text."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def aligned(offsets: np.ndarray, begins: list[int], ends: list[int]) -> np.ndarray:
    """Mask of the tokens (rows of begin, end, in order) that the spans touch."""
    begins, ends = np.array(begins, dtype=np.int64), np.array(ends, dtype=np.int64)
    first = np.searchsorted(offsets[:, 1], begins, side="right")  # ends after the span begins
    last = np.searchsorted(offsets[:, 0], ends, side="left")  # begins before the span ends
    some = (begins < ends) & (first < last)
    edges = np.zeros(len(offsets) + 1, dtype=np.int64)
    np.add.at(edges, first[some], 1)
    np.add.at(edges, last[some], -1)
    return (np.cumsum(edges[:-1]) > 0).astype(np.uint8)


def learned_texts(formatted: str, mask: np.ndarray, offsets: np.ndarray) -> Iterator[str]:
    """The texts under the mask, unescaped, one for each stretch of masked tokens."""
    at = np.flatnonzero(mask)
    if not len(at):
        return
    control = np.array([m.span() for m in _TEMPLATE.finditer(formatted)], dtype=np.int64).reshape(-1, 2)
    cuts = np.flatnonzero(np.diff(at) > 1) + 1
    for first, last in zip(at[np.concatenate([[0], cuts])], at[np.concatenate([cuts - 1, [len(at) - 1]])]):
        begin, end = offsets[first, 0], offsets[last, 1]
        ahead = np.searchsorted(control[:, 0], begin, side="right") - 1
        if ahead >= 0:
            begin = max(begin, control[ahead, 1])
        behind = np.searchsorted(control[:, 1], end, side="left")
        if behind < len(control):
            end = min(end, control[behind, 0])
        yield unescape(formatted[begin:end])


def formatted(turns: DataFrame, tokenizer_path: str, conv_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text", learned: str = "assistant") -> DataFrame:
    """A row per conversation: conv, formatted, ids, offsets (begin and end of every token in characters, as
    little-endian 32-bit integers) and loss_mask (a byte per token)."""
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = turns.sparkSession.sparkContext.broadcast(file.read())
    rows = turns.select(quoted(conv_col).cast("long").alias("conv"), quoted(turn_col).cast("long").alias("turn"),
                        text_of(role_col).alias("role"), text_of(text_col).alias("text"))
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = kept_encoder(shared.value, literal=True).tokenizer

        def done(conv: int | None, said: list[tuple[str, str]]) -> pa.RecordBatch:
            text, begins, ends = render(said, learned)
            encoding = tokenizer.encode(text, add_special_tokens=False)
            offsets = np.array(encoding.offsets, dtype="<i4").reshape(-1, 2)
            if max(len(text.encode("utf-8", "surrogatepass")), offsets.nbytes) > LARGEST:
                raise ValueError(f"conversation {conv} is longer than a value can hold")
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([text]), pa.array([encoding.ids], pa.list_(pa.int32())),
                 pa.array([offsets.tobytes()], pa.binary()), pa.array([aligned(offsets, begins, ends).tobytes()], pa.binary())],
                ["conv", "formatted", "ids", "offsets", "loss_mask"])

        held: list[tuple[str, str]] = []
        now = None
        for conv, role, text in chain.from_iterable(
                zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))) for batch in batches):
            if held and conv != now:
                yield done(now, held)
                held = []
            now = conv
            held.append((role, text))
        if held:
            yield done(now, held)

    return ordered.select("conv", "role", "text").mapInArrow(
        run, "conv long, formatted string, ids array<int>, offsets binary, loss_mask binary") \
        .withColumnRenamed("conv", conv_col)


def digests(rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the rows of ``formatted`` say, read back from them, one row per conversation: the turns from the text, and
    what is learned from mask and offsets."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for conv, text, offsets, mask in zip(*(column.to_pylist() for column in batch.columns)):
                turns = read_turns(text)
                said = hashlib.sha256("".join(f"{role}\n{words}\n" for role, words in turns).encode("utf-8", "surrogatepass"))
                learned = "".join(learned_texts(text, np.frombuffer(mask, np.uint8),
                                                np.frombuffer(offsets, "<i4").reshape(-1, 2)))
                loss = hashlib.sha256(learned.encode("utf-8", "surrogatepass"))
                for column, value in zip(out, (conv, len(turns), said.hexdigest(), len(learned), loss.hexdigest(), len(text))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return rows.select(quoted(conv_col), "formatted", "offsets", "loss_mask").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long").withColumnRenamed("conv_id", conv_col)
