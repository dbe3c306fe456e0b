"""Chat formatting in windows of a token budget, and the way back.

A turn is written as ``<s>[INST]role[/INST]text</s>``. Inside role and text a backslash doubles, and each control string
gets one behind its first character, so that it reads as text and the way back is exact.

A conversation is cut between turns: running sums of the turns' tokens say how far a window reaches. Each window
repeats the system turn that opens the conversation and then the latest turns before it as far as `history_turns` and a quarter of
the budget allow. Only text of assistant turns that are new in a window is under its loss mask, so every target is
learned once. A turn longer than the budget has a window of its own and stays whole.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

BUDGET = 1024
HISTORY_TURNS = 2
TOKENIZER = "byte_bpe_50k.json"

_CONTROL = re.compile(r"\\|<(?=s>)|<(?=/s>)|\[(?=INST\])|\[(?=/INST\])")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
WINDOW = (
    "window bigint, first_turn bigint, n_repeated bigint, n_new bigint, n_tokens bigint, formatted string, "
    "loss array<struct<start:bigint,end:bigint>>"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


class Turn(NamedTuple):
    role: str
    text: str
    tokens: int


def windows_of(turns: Iterator[Turn], budget: int, history_turns: int) -> Iterator[dict]:
    """The windows of one conversation; holds no more than a window and its history."""
    system: Turn | None = None
    history: deque[Turn] = deque(maxlen=history_turns)
    new: list[Turn] = []
    total = begun = seen = number = 0  # running sum of tokens, its value where this window's new turns begin, turns before them

    def repeated() -> list[Turn]:
        out, room = [], budget // 4
        for turn in reversed(history):
            if (room := room - turn.tokens) < 0:
                break
            out.append(turn)
        return ([system] if system and seen else []) + out[::-1]

    def window() -> dict:
        text, loss, at = [], [], 0
        old = repeated()
        for i, turn in enumerate([*old, *new]):
            head, body = f"<s>[INST]{escape(turn.role)}[/INST]", escape(turn.text)
            if i >= len(old) and turn.role == "assistant":
                loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
            text.append(f"{head}{body}</s>")
            at += len(text[-1])
        return {
            "window": number, "first_turn": seen, "n_repeated": len(old), "n_new": len(new),
            "n_tokens": sum(t.tokens for t in [*old, *new]), "formatted": "".join(text), "loss": loss,
        }

    for turn in turns:
        if system is None and not seen and not new and turn.role == "system":
            system = turn
        if new and total + turn.tokens - begun > budget - sum(t.tokens for t in repeated()):
            yield window()
            history.extend(t for t in new if t is not system)
            seen, number, begun, new = seen + len(new), number + 1, total, []
        new.append(turn)
        total += turn.tokens
    if new:
        yield window()


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for some in range(0, batch.num_rows, 256):
            yield from batch.slice(some, 256).to_pylist()


def _batched(rows: Iterator[dict], schema: pa.Schema, most: int = 256) -> Iterator[pa.RecordBatch]:
    out = []
    for row in rows:
        out.append(row)
        if len(out) == most:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _arrow(df: DataFrame, sql: str) -> pa.Schema:
    """The Arrow schema of a Spark DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(sql))


def format_windows(
    conversations: DataFrame, *, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
    tokenizer: str = TOKENIZER,
) -> DataFrame:
    """One row per window: conv_id and the columns of `WINDOW`. ``loss`` holds code-point ranges of ``formatted``.

    Turns go by ``turn``, NULL first, then role and text, so ties and repeated rows have one order; each repeated row is a
    turn. NULL role or text counts as empty; rows with NULL conv_id make one conversation. Other columns are
    ignored, an empty table gives no window. A conversation passes through one task as a stream: memory holds a window, not the conversation.
    """
    key_type = conversations.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {key_type}, {WINDOW}"
    arrow = _arrow(conversations, schema)
    path = public_tokenizers.path(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Tokenizer.from_file(path)
        encoder.encode_special_tokens = True

        def turns(rows: Iterator[dict]) -> Iterator[tuple]:
            for row in rows:
                turn = f"<s>[INST]{escape(row['role'])}[/INST]{escape(row['text'])}</s>"
                yield row["conv_id"], Turn(row["role"], row["text"], len(encoder.encode(turn, add_special_tokens=False).ids))

        def windows() -> Iterator[dict]:
            for conv_id, group in groupby(turns(_by_key(batches)), key=lambda x: x[0]):
                for window in windows_of((t for _, t in group), budget, history_turns):
                    yield {"conv_id": conv_id, **window}

        yield from _batched(windows(), arrow)

    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
        .mapInArrow(run, schema)
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """What the windows say of each conversation, from their text, masks and counts of repeated turns alone.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn), loss_chars, loss_sha256 (all text under
    the masks), formatted_chars, n_windows.
    """
    key_type = windows.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {key_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, n_windows bigint"
    )
    arrow = _arrow(windows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[dict]:
            for conv_id, group in groupby(_by_key(batches), key=lambda r: r["conv_id"]):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = chars = n_windows = 0
                for row in group:
                    text = row["formatted"]
                    for i, m in enumerate(_TURN.finditer(text)):
                        if i >= row["n_repeated"]:
                            turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                            n_turns += 1
                    for span in row["loss"]:
                        target = unescape(text[span["start"] : span["end"]])
                        loss.update(target.encode())
                        loss_chars += len(target)
                    chars += len(text)
                    n_windows += 1
                yield dict(zip(arrow.names, (conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, n_windows), strict=True))

        yield from _batched(read(), arrow)

    return (
        windows.select("conv_id", "window", "n_repeated", "formatted", "loss")
        .repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "window")
        .mapInArrow(run, schema)
    )
