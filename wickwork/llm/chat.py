"""Chat formatting in budgeted windows.

Every turn is written as `<|im_start|>role\\ntext<|im_end|>\\n`. A control string inside a text
is escaped by a backslash after its `<` (one more where some are already), which is undone
when reading; roles also have backslashes and line feeds escaped.

A conversation is cut into windows of about `budget` tokens, at turns only: prefix sums of
turn tokens choose the longest run of new turns that fits. Each window but the first repeats
the system turn (the conversation's first turn, if its role is system) and the last turns
before it, up to `history` tokens, as far as the next new turn still fits. Repeated turns
are never targets; the loss mask holds the texts of new assistant turns, so each is learnt
once. A turn longer than the budget makes a longer window alone; a system turn of more than
half the budget is not repeated.

Conversations are sorted inside partitions and read as a stream, so a very long one
passes through memory one window at a time. Turns are in the order of turn, role and text,
nulls first; null roles and texts are empty. Rows without conv_id form one conversation.
Repeated rows are turns of their own. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET, HISTORY = 2048, 256
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
START, END = "<|im_start|>", "<|im_end|>"
#: Fixed value: how the tokenizer of that vocabulary splits text.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PIECE = 4096  # characters encoded at once
_WINDOW = "conv_id long, window int, formatted string, repeated int, n_tokens long, loss array<struct<start:int,end:int>>"
_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def tokenizer(vocabulary: bytes):
    """Function that counts the tokens of a text."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    encode = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda text: sum(len(encode(text[i: i + _PIECE])) for i in range(0, len(text), _PIECE))


class Windows:
    """Windows of one conversation, from its turns in order."""

    def __init__(self, conv_id: int | None, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.number = 0
        self.system: tuple | None = None
        self.past: list[tuple] = []  # last turns of earlier windows, up to the history
        self.new: list[tuple] = []

    def add(self, role: str, text: str, tokens: int) -> Iterator[tuple]:
        turn = (role, text, tokens)
        if not self.number and not self.new and self.system is None and role == "system":
            self.system = turn
        if self.new and self._head_tokens() + sum(t[2] for t in self.new) + tokens > self.budget:
            yield self.close()
        self.new.append(turn)

    def _head_tokens(self) -> int:
        return self.system[2] if self.number and self.system and self.system[2] <= self.budget // 2 else 0

    def close(self) -> tuple:
        """The window of all new turns, with what it repeats."""
        head = [self.system] if self.number and self.system and self.system[2] <= self.budget // 2 else []
        room = min(self.history, self.budget - sum(t[2] for t in head) - sum(t[2] for t in self.new))
        sums = list(accumulate(t[2] for t in reversed(self.past)))
        repeat = bisect_right(sums, max(room, 0))
        head += self.past[len(self.past) - repeat:]
        out, loss, at = [], [], 0
        for i, (role, text, _) in enumerate(head + self.new):
            lead = f"{START}{escape_role(role)}\n"
            body = escape(text)
            if i >= len(head) and role == "assistant":
                loss.append({"start": at + len(lead), "end": at + len(lead) + len(body)})
            out.append(f"{lead}{body}{END}\n")
            at += len(out[-1])
        tokens = sum(t[2] for t in head + self.new)
        row = (self.conv_id, self.number, "".join(out), len(head), tokens, loss)
        turns = self.past + [t for t in self.new if t is not self.system]
        sums = list(accumulate(t[2] for t in reversed(turns)))
        keep = bisect_right(sums, self.history)
        self.past = turns[len(turns) - keep:]
        self.number, self.new = self.number + 1, []
        return row


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _in_order(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of one key together and in order, in a stream; the key's rows are never gathered."""
    return df.repartition(key).sortWithinPartitions(key, *order)


def format_chats(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokenizer_path: str = TOKENIZER
) -> DataFrame:
    """(conv_id, window, formatted, repeated, n_tokens, loss): windows; `repeated` turns come first."""
    with open(tokenizer_path, "rb") as file:  # on the driver; tasks get the vocabulary itself, of a fixed size
        vocabulary = turns.sparkSession.sparkContext.broadcast(file.read())

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer(vocabulary.value)
        marks = 8  # tokens of the template around a turn
        out: list[tuple] = []
        now: Windows | None = None
        for conv_id, _, role, text in _turns(batches):
            role, text = role or "", text or ""
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    out.append(now.close())
                now = Windows(conv_id, budget, history)
            out.extend(now.add(role, text, count(text) + count(role) + marks))
            if len(out) >= 256:
                yield _batch(out, _WINDOW)
                out = []
        if now is not None:
            out.append(now.close())
        yield _batch(out, _WINDOW)

    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    return _in_order(own, "conv_id", "turn", "role", "text").mapInArrow(of, _WINDOW)


_TYPES = {
    "long": pa.int64(), "int": pa.int32(), "string": pa.string(),
    "array<struct<start:int,end:int>>": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def read_back(windows: DataFrame) -> DataFrame:
    """Turns and loss text of each conversation, read from formatted windows alone."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        state: list | None = None

        def done() -> None:
            conv_id, turns, whole, chars, loss, formatted, n = state
            out.append((conv_id, turns, whole.hexdigest(), chars, loss.hexdigest(), formatted, n))

        for conv_id, _, formatted, repeated, spans in _turns(batches):
            if state is None or state[0] != conv_id:
                if state is not None:
                    done()
                state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, text in list(_TURN.findall(formatted))[repeated:]:
                state[1] += 1
                state[2].update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
            for span in spans:
                text = unescape(formatted[span["start"]: span["end"]])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(formatted)
            state[6] += 1
            if len(out) >= 1024:
                yield _batch(out, _READ)
                out.clear()
        if state is not None:
            done()
        yield _batch(out, _READ)

    own = windows.select("conv_id", "window", "formatted", "repeated", "loss")
    return _in_order(own, "conv_id", "window").mapInArrow(of, _READ)
