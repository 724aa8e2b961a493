r"""Chat formatting by columnar byte assembly.

A turn becomes ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and texts every ``<``, k
backslashes, ``|`` gets one more backslash, so the two control strings occur only as marks and the
originals come back exactly; a role's backslashes and line ends are written ``\\`` and ``\n``.

A sorted batch of turns is laid out at once: the lengths of headers, texts and footers give running
offsets, scatter indices copy all bytes into one preallocated Arrow buffer, and the same offsets
give the spans under the loss mask (assistant texts). Output rows are parts: a conversation's turns
of one batch, at most PART_BYTES and a turn. A long conversation has several parts and may lie in
several tasks, since rows are dealt by ranges of (conversation, turn).

Defined cases: NULL texts and roles are empty; a NULL conversation is one of its own, NULL turns come
first; equal turn numbers follow role and text; an empty table gives no parts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premiere.llm.common import bounded_batches

START, END = b"<|im_start|>", b"<|im_end|>"
LOSS_ROLE = b"assistant"
PART_BYTES = 1 << 20
PART_SCHEMA = "conv_id long, part long, n_turns long, formatted binary, loss_starts array<long>, loss_lengths array<long>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escaped_role(role: Column) -> Column:
    doubled = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escaped(doubled)


_MARKED = re.compile(rb"<\\(\\*)\|")
_ROLE_MARK = re.compile(rb"\\(.)", re.S)


def unescape(text: bytes) -> bytes:
    return _MARKED.sub(rb"<\1|", text)


def unescape_role(role: bytes) -> bytes:
    return _ROLE_MARK.sub(lambda m: b"\n" if m[1] == b"n" else m[1], unescape(role))


# Assembly ------------------------------------------------------------------------------


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buffer of a text column with starts and lengths of its values."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw, at[:-1], np.diff(at)


def _scatter(out: np.ndarray, to: np.ndarray, raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
    """Copy segments raw[start:start+length] to out[to:to+length], all at once."""
    first = np.cumsum(length) - length
    within = np.arange(int(length.sum())) - np.repeat(first, length)
    out[np.repeat(to, length) + within] = raw[np.repeat(start, length) + within]


def assemble(roles: pa.Array, contents: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray]:
    """One buffer with all turns, the turns' offsets in it, and where each content begins.

    Roles and contents are escaped and not NULL.
    """
    raw_r, start_r, len_r = _bytes_of(roles)
    raw_c, start_c, len_c = _bytes_of(contents)
    fixed = np.frombuffer(START + b"\n" + END + b"\n", np.uint8)
    n_start, n_end, turns = len(START), len(END) + 1, len(len_r)
    size = n_start + len_r + 1 + len_c + n_end
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = offsets[:-1]
    buffer = pa.allocate_buffer(int(offsets[-1]))
    out = np.frombuffer(buffer, np.uint8) if offsets[-1] else np.zeros(0, np.uint8)
    content = at + n_start + len_r + 1

    def constant(to: np.ndarray, start: int, length: int) -> None:
        _scatter(out, to, fixed, np.full(turns, start), np.full(turns, length))

    constant(at, 0, n_start)
    _scatter(out, at + n_start, raw_r, start_r, len_r)
    constant(content - 1, n_start, 1)
    _scatter(out, content, raw_c, start_c, len_c)
    constant(content + len_c, n_start + 1, n_end)
    return buffer, offsets, content


def _cuts(conv: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First turns of the parts: where the conversation changes or PART_BYTES is passed."""
    change = np.flatnonzero(conv[1:] != conv[:-1]) + 1
    cuts = [0]
    for stop in [*change.tolist(), len(conv)]:
        while offsets[stop] - offsets[cuts[-1]] > PART_BYTES:
            nxt = int(np.searchsorted(offsets, offsets[cuts[-1]] + PART_BYTES, side="right")) - 1
            nxt = max(nxt, cuts[-1] + 1)
            if nxt >= stop:
                break
            cuts.append(nxt)
        cuts.append(stop)
    return np.array(cuts)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id")
        key = np.stack([conv.fill_null(0).to_numpy(), conv.is_null().to_numpy(zero_copy_only=False)], 1)
        code = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(axis=1))])
        buffer, offsets, content = assemble(batch.column("role"), batch.column("text"))
        cuts = _cuts(code, offsets)
        loss = batch.column("is_loss").to_numpy(zero_copy_only=False)
        ends = offsets[1:] - len(END) - 1
        begins = np.repeat(offsets[cuts[:-1]], np.diff(cuts))
        kept = np.concatenate([[0], np.cumsum(loss)])[cuts].astype(np.int32)
        spans = [
            pa.ListArray.from_arrays(pa.array(kept, pa.int32()), pa.array(values[loss], pa.int64()))
            for values in (content - begins, ends - content)
        ]
        where = pa.py_buffer(offsets[cuts].astype(np.int32).tobytes())
        formatted = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, where, buffer])
        yield pa.RecordBatch.from_arrays(
            [
                conv.take(pa.array(cuts[:-1])),
                pa.array(number + np.arange(len(cuts) - 1), pa.int64()),
                pa.array(np.diff(cuts), pa.int64()),
                formatted,
                *spans,
            ],
            ["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_lengths"],
        )
        number += len(cuts) - 1


def format_chats(conversations: DataFrame) -> DataFrame:
    """Parts of formatted conversations, in order of `part` within a conversation.

    `formatted` is UTF-8; loss_starts and loss_lengths are byte spans in it.
    """
    bounded_batches(conversations.sparkSession)
    role = F.coalesce("role", F.lit(""))
    turns = conversations.select(
        "conv_id",
        "turn",
        escaped_role(role).alias("role"),
        escaped(F.coalesce("text", F.lit(""))).alias("text"),
        (role == LOSS_ROLE.decode()).alias("is_loss"),
    )
    return turns.orderBy("conv_id", "turn", "role", "text").drop("turn").mapInArrow(_parts, PART_SCHEMA)


# Reading back --------------------------------------------------------------------------

_TURN = re.compile(re.escape(START) + rb"([^\n]*)\n(.*?)" + re.escape(END) + rb"\n", re.S)


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """Roles and texts of a formatted part; raises when anything is left between turns."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text between turns")
        turns.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("text after the last turn")
    return turns


DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a stream sorted by conversation and part; holds one part at a time."""
    done, open_ = [], None

    def chars(raw: bytes) -> int:
        return len(raw.decode())

    def closed(o: dict) -> dict:
        return o | {"turns_sha256": o["turns_sha256"].hexdigest(), "loss_sha256": o["loss_sha256"].hexdigest()}

    for batch in batches:
        columns = [batch.column(c) for c in ("conv_id", "formatted", "loss_starts", "loss_lengths")]
        for i in range(batch.num_rows):
            conv, formatted, starts, lengths = (c[i].as_py() for c in columns)
            if open_ is None or open_["conv_id"] != conv:
                if open_ is not None:
                    done.append(closed(open_))
                open_ = {"conv_id": conv, "n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0}
                open_ |= {"loss_sha256": hashlib.sha256(), "formatted_chars": 0}
            open_["formatted_chars"] += chars(formatted)
            for role, text in parse(formatted):
                open_["n_turns"] += 1
                open_["turns_sha256"].update(role + b"\n" + text + b"\n")
            for start, length in zip(starts, lengths):
                text = unescape(formatted[start : start + length])
                open_["loss_chars"] += chars(text)
                open_["loss_sha256"].update(text)
        if len(done) >= 1000:
            yield _rows(done)
            done = []
    if open_ is not None:
        done.append(closed(open_))
    if done:
        yield _rows(done)


def _rows(done: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in DIGEST_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([d[n] for d in done], k) for n, k in zip(names, kinds)], names)


def digests(parts: DataFrame) -> DataFrame:
    """What the formatted parts say when read back, one row per conversation.

    A digest runs through its conversation in order, so one conversation is one task's stream; the
    task holds one part at a time.
    """
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_digest, DIGEST_SCHEMA)
