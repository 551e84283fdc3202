"""Chat examples by prefix-target expansion: every assistant turn becomes an example of its own.

An example holds all turns before its target as context, and the target, of which only the text is trainable. Turns
after the last assistant turn are no context of any target; they come as one last example without a target,
so that the output holds every conversation whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"
# Rows of output that are handed on at once: at most so many characters, but one row at least.
BATCH_CHARS = 1 << 21


def escape(text: str) -> str:
    """No control string can be read out of the result, and ``unescape`` gives ``text`` again."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def _escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.DOTALL)


def turn_head(role: str) -> str:
    return f"{START}{_escape_role(role)}\n"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted example."""
    turns = []
    for part in formatted.split(f"{END}\n")[:-1]:
        role, _, text = part.removeprefix(START).partition("\n")
        turns.append((_unescape_role(role), unescape(text)))
    return turns


def prefix_examples(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per example: conv_id, example, n_turns, formatted, loss_start and loss_end.

    ``formatted`` is the turns' template text; the characters (code points) from loss_start up to loss_end
    are the trainable ones, none where both are null. Turns are taken by ``turn``, nulls first, ties by role and text;
    repeated rows are repeated turns. A null text or role counts as empty. Rows without conv_id are one
    conversation. Other columns are ignored; an empty table gives an empty result.

    A conversation's turns meet in one task, sorted, and stream through it: the task holds the text so far, which is
    one output row. Examples of a conversation stay together and in order.
    """
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    kind = turns.schema["conv_id"].dataType.simpleString()
    turns = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def expanded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "example", "n_turns", "formatted", "loss_start", "loss_end"]
        rows: list[tuple] = []
        chars, conv, example, n, pending, so_far, started, id_type = 0, None, 0, 0, False, "", False, None

        def tail() -> None:
            if started and pending:
                rows.append((conv, example, n, so_far, None, None))

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [id_type, pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            id_type = batch.column("conv_id").type
            for c, who, said in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if not started or c != conv:
                    tail()
                    conv, example, n, pending, so_far, started = c, 0, 0, False, "", True
                so_far += turn_head(who)
                begin = len(so_far)
                so_far += escape(said)
                stop = len(so_far)
                so_far += f"{END}\n"
                n, pending = n + 1, who != TARGET_ROLE
                if who == TARGET_ROLE:
                    rows.append((conv, example, n, so_far, begin, stop))
                    example += 1
                    chars += len(so_far)
                if chars >= BATCH_CHARS:
                    yield flushed()
                    rows.clear()
                    chars = 0
        tail()
        if rows:
            yield flushed()

    schema = f"conv_id {kind}, example int, n_turns bigint, formatted string, loss_start bigint, loss_end bigint"
    return turns.mapInArrow(expanded, schema)


def example_digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from ``prefix_examples``: what it holds and what of it is trainable.

    conv_id, n_turns, turns_sha256 (of role, newline, text, newline by turn, from the longest example), loss_chars and
    loss_sha256 (all text under the loss mask, unescaped, in order) and formatted_chars. Reads the
    examples where they are, in their order, with one conversation's running digest held at a time.
    """
    kind = examples.schema["conv_id"].dataType.simpleString()

    def digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, started, last, loss, loss_chars, chars = None, False, "", hashlib.sha256(), 0, 0

        def close() -> None:
            turns = read_turns(last)
            told = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode())
            done.append((conv, len(turns), told.hexdigest(), loss_chars, loss.hexdigest(), chars))

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            kinds = [batch.column("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = (batch.column(k).to_pylist() for k in ("conv_id", "formatted", "loss_start", "loss_end"))
            for c, formatted, begin, stop in zip(*columns, strict=True):
                if not started or c != conv:
                    if started:
                        close()
                    conv, started, loss, loss_chars, chars = c, True, hashlib.sha256(), 0, 0
                # Each example continues the one before, so the last is the longest.
                last, chars = formatted, chars + len(formatted)
                if begin is not None:
                    said = unescape(formatted[begin:stop])
                    loss.update(said.encode())
                    loss_chars += len(said)
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names
                )
                done.clear()
        if started:
            close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names
            )

    schema = (
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
    return examples.mapInArrow(digested, schema)
