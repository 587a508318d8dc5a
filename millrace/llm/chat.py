"""Chat formatting at the level of tokens.

A turn is  START role SEP text END, where START, SEP and END are reserved ids beyond the vocabulary. Role and text are encoded
separately, so no merge crosses a mark, and the reserved ids are spliced in. The loss mask holds the text of assistant turns: +1 at
its first token, -1 after its last one, summed up. Control strings inside a role or text are escaped: ``<`` and backslashes before
``|`` get one more backslash, which unescaping takes away, so content never spells a mark. ``formatted`` is that text with the marks
``<|im_start|>``, ``<|im_sep|>`` and ``<|im_end|>``.

Turns are formatted and read back one by one, in any number of tasks; only the digests over a whole conversation, which
are sequential, are made in one pass over its sorted turns with a state of fixed size.

Defined results: a null role or text is empty; turns come by turn (null first), then role, then text; repeated rows are turns of their own; a
null conversation id is one conversation; other columns aren't read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import staged, width

MARKS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


@lru_cache(maxsize=2)
def encoding(path: str):
    """The byte-level vocabulary of a rank file, and its three reserved ids."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    first = max(ranks.values()) + 2
    return tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), (first, first + 1, first + 2)


def assemble(enc, marks: tuple[int, int, int], role: str, text: str) -> tuple[list[int], list[int]]:
    """(ids, loss mask) of a turn."""
    segments = [[marks[0]], enc.encode_ordinary(escape(role)), [marks[1]], enc.encode_ordinary(escape(text)), [marks[2]]]
    ends = np.cumsum([len(s) for s in segments])
    step = np.zeros(ends[-1] + 1, np.int8)
    if role == "assistant":
        step[ends[2]] += 1
        step[ends[3]] -= 1
    return [i for s in segments for i in s], np.cumsum(step[:-1]).tolist()


def disassemble(enc, marks: tuple[int, int, int], ids: list[int], mask: list[int]) -> tuple[str, str, str | None, int]:
    """(role, text, text under the loss mask or None, formatted characters) of a turn's ids."""
    sep = ids.index(marks[1])
    if ids[0] != marks[0] or ids[-1] != marks[2]:
        raise ValueError("not one turn")
    role, text = (enc.decode_bytes(x).decode() for x in (ids[1:sep], ids[sep + 1 : -1]))
    on = [i for i, m in zip(ids, mask, strict=True) if m]
    trained = unescape(enc.decode_bytes(on).decode()) if on else None
    return unescape(role), unescape(text), trained, len(role) + len(text) + sum(map(len, MARKS))


def formatted(conversations: DataFrame, path: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, ids, loss_mask): every turn formatted."""
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, marks = encoding(path)
        for b in batches:
            made = [assemble(enc, marks, r, t) for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), b.column("role"), pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([m[1] for m in made], pa.list_(pa.int8()))], ["conv_id", "turn", "role", "ids", "loss_mask"])

    return rows.mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, ids array<int>, loss_mask array<tinyint>")


def read_back(turns: DataFrame, path: str) -> DataFrame:
    """(conv_id, turn, role, text, trained, formatted_chars) from formatted turns."""
    kinds = dict(turns.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, marks = encoding(path)
        for b in batches:
            made = [disassemble(enc, marks, i, m) for i, m in zip(b.column("ids").to_pylist(), b.column("loss_mask").to_pylist(), strict=True)]
            cols = list(zip(*made, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), *(pa.array(c, pa.string()) for c in cols[:3]), pa.array(cols[3], pa.int64())], ["conv_id", "turn", "role", "text", "trained", "formatted_chars"])

    return turns.mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, trained string, formatted_chars bigint")


def digests(turns: DataFrame) -> DataFrame:
    """A row per conversation from turns as read back."""
    kind = dict(turns.dtypes)["conv_id"]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    # hash partitions of sorted turns: a conversation of any length is a stream, never a list
    dealt = turns.repartition(width(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list | None = None
        for b in batches:
            type_, out = b.column("conv_id").type, []
            for conv, role, text, trained, chars in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text", "trained", "formatted_chars")), strict=True):
                if open_ is None or open_[0] != conv:
                    if open_ is not None:
                        out.append(open_)
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                open_[1] += 1
                open_[2].update(f"{role}\n{text}\n".encode())
                open_[5] += chars
                if trained is not None:
                    open_[3] += len(trained)
                    open_[4].update(trained.encode())
            yield batch(out, type_)
        if open_ is not None:
            yield batch([open_], type_)

    def batch(rows: list, type_) -> pa.RecordBatch:
        cols = [[r[0] for r in rows], [r[1] for r in rows], [r[2].hexdigest() for r in rows], [r[3] for r in rows], [r[4].hexdigest() for r in rows], [r[5] for r in rows]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (type_, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names)

    return dealt.mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def round_trip(conversations: DataFrame, path: str) -> DataFrame:
    return digests(read_back(staged(formatted(conversations, path)), path))
