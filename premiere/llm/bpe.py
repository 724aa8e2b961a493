"""Byte-level BPE encoding and decoding; long unsplit text by tree concatenation.

Ids equal those of the tokenizers library for the same file. Text is cut where a blank follows a
character that is no white space: no match of the splitting pattern crosses such a place. Units between
the cuts repeat a lot and are looked up in a bounded cache; new units are split by the pattern and
merged.

A piece without any split longer than LEAF bytes is halved down to leaves, which are encoded on
their own; halves are then joined level by level. A join re-encodes a window around the seam and
doubles it until its first token is the left side's token there and its last token the right side's.
Every two neighbours of the joined row then stand side by side in some exact encoding, which for
ranked merges makes the whole row exact.

The same is done between tasks: texts over LONG_TEXT characters become rows of segments, encoded in
parallel and joined in pairs. A seam that has no safe cut is re-encoded from pieces that both sides
agree on.

Defined cases: NULL texts are empty (no ids); control strings of the vocabulary are single ids, as in
the library; repeated rows and NULL ids are encoded row by row; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from premiere.llm.common import bounded_batches, per_batch, texts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LEAF = 128  # bytes of an unsplit piece encoded at once
LONG_TEXT = 1 << 16  # characters of a segment
CACHED_UNITS = 150_000
CACHED_CHARS = 64

_CUT = re.compile(r"(?<=\S)(?=[ \t\n\r\f\v])")
_COMMON = re.compile("[\x00-ɏ]*")  # letters and digits here are old enough for every Unicode version


class Recent(dict):
    """A dictionary of computed values that keeps the last one or two `limit` keys in use."""

    def __init__(self, compute: Callable[[str], bytes], limit: int):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > CACHED_CHARS:
                return value
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Units(dict):
    """Learned ids of units; one that is too long to keep is computed when asked for."""

    def __init__(self, compute: Callable[[str], bytes]):
        super().__init__()
        self.compute = compute

    def __missing__(self, key: str) -> bytes:
        return self.compute(key)


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Codec:
    """Encodes and decodes with one vocabulary file. Ids are bytes: little-endian 32-bit numbers."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        self._symbol_table = {b: s for b, s in symbols.items()}
        back = {s: b for b, s in symbols.items()}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = added
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self._pattern = regex.compile(public_tokenizers.PATTERN)
        ids = {i: bytes(back[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in added}
        ids |= {i: t.encode() for t, i in added.items()}
        self.bytes_of = [ids.get(i, b"") for i in range(max(ids) + 1)]
        self._units = Recent(self._unit, CACHED_UNITS // 4)
        self._after_blank = Units(self._blank_unit)
        self._after_blank_older = Units(self._blank_unit)
        merged = [a + b for a, b in map(tuple, spec["model"]["merges"])]
        vocab = spec["model"]["vocab"]
        if any(vocab[m] != vocab[merged[0]] + i for i, m in enumerate(merged)):
            raise ValueError("ids must follow the order of the merges")
        ranks = {raw: i for i, raw in ids.items() if i not in added.values()}
        self._whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._opens = np.array([raw[:1] == b" " for raw in self.bytes_of])

    # Pieces and merges

    def pieces(self, text: str) -> list[str]:
        """The text split by the pattern, without control strings."""
        if _COMMON.fullmatch(text):
            return self._pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _merge(self, symbols: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(symbols)]

    def _symbols(self, raw: bytes) -> str:
        return raw.decode("latin-1").translate(self._symbol_table)

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of one unsplit piece; over LEAF bytes by tree concatenation."""
        if len(raw) <= LEAF:
            return self._merge(self._symbols(raw))
        level = [self._merge(self._symbols(raw[i : i + LEAF])) for i in range(0, len(raw), LEAF)]
        return self.join_all(level)

    def join_all(self, level: list[list[int]]) -> list[int]:
        while len(level) > 1:
            pairs = [self.join(a, b) for a, b in zip(level[::2], level[1::2])]
            level = pairs + level[len(pairs) * 2 :]
        return level[0] if level else []

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of the concatenation of two encoded stretches of one piece."""
        a, b = min(4, len(left)), min(4, len(right))
        while True:
            head, tail = left[len(left) - a :], right[:b]
            window = self._merge(self._symbols(self.raw(head) + self.raw(tail)))
            left_agrees = a == len(left) or (bool(window) and window[0] == head[0])
            right_agrees = b == len(right) or (bool(window) and window[-1] == tail[-1])
            if left_agrees and right_agrees:
                return left[: len(left) - a] + window + right[b:]
            a = a if left_agrees else min(2 * a, len(left))
            b = b if right_agrees else min(2 * b, len(right))

    def _unit(self, text: str) -> bytes:
        return b"".join([_packed(self.encode_piece(p.encode())) for p in self.pieces(text)])

    def _blank_unit(self, unit: str) -> bytes:
        return self._unit(" " + unit) if unit and not unit[-1].isspace() else b""

    # Texts

    def _learn(self, units: set[str]) -> None:
        """Cache the ids of all new units as they stand after a blank.

        Units hold no blank, so in one text of all new units every id that opens with a blank opens a
        unit. A unit that is empty or ends in white space is not a unit before another blank: it is
        marked by empty ids.
        """
        cache, older = self._after_blank, self._after_blank_older
        new = units.difference(cache)
        if len(cache) + len(new) > CACHED_UNITS:
            self._after_blank_older, self._after_blank = cache, Units(self._blank_unit)
            cache, older, new = self._after_blank, cache, units
        known = {unit for unit in new if unit in older}
        for unit in known:
            cache[unit] = older[unit]
        common = []
        for unit in new - known:
            if not unit or unit[-1].isspace():
                cache[unit] = b""
            elif len(unit) > CACHED_CHARS:
                continue
            elif unit.isascii() or _COMMON.fullmatch(unit):
                common.append(unit)
            else:
                cache[unit] = self._blank_unit(unit)
        if common:
            ids = np.array(self._whole.encode_ordinary(" " + " ".join(common)), "<u4")
            at = (np.flatnonzero(self._opens[ids]) * 4).tolist()
            packed = ids.tobytes()
            cache.update(zip(common, map(packed.__getitem__, map(slice, at, [*at[1:], len(packed)]))))

    def _plain(self, text: str, units: list[str] | None = None) -> bytes:
        """Ids of text without control strings."""
        if units is None:
            units = text.split(" ")
            self._learn(set(units[1:]))
        found = list(map(self._after_blank.__getitem__, units[1:]))
        if found and not found[-1]:
            found[-1] = self._unit(" " + units[-1])
        if not units[0] or units[0][-1].isspace() or b"" in found or not found[-1:] or not units[-1]:
            return b"".join(map(self._units.__getitem__, _CUT.split(text)))
        return self._units[units[0]] + b"".join(found)

    def _parts(self, text: str) -> list[str]:
        """Stretches of text at even places, control strings at odd ones."""
        if self._special and any(s in text for s in self.special):
            return self._special.split(text)
        return [text]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        split = [None if self._special and any(c in t for c in self.special) else t.split(" ") for t in texts]
        self._learn(set().union(*(u[1:] for u in split if u)))
        done = []
        for text, units in zip(texts, split):
            if units is not None:
                done.append(self._plain(text, units) if text else b"")
                continue
            parts = enumerate(self._special.split(text))
            done.append(b"".join([_packed([self.special[p]]) if i % 2 else self._plain(p) for i, p in parts if p]))
        return done

    def raw(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, packed: bytes) -> str:
        return self.raw(memoryview(packed).cast("I")).decode("utf-8", "replace")

    # Segments of long texts

    def encode_by_piece(self, text: str) -> list[list[int]]:
        """Ids of every piece and control string."""
        found = []
        for i, part in enumerate(self._parts(text)):
            if i % 2:
                found.append([self.special[part]])
            else:
                found += [self.encode_piece(p.encode()) for u in _CUT.split(part) for p in self.pieces(u)]
        return found

    def join_segments(self, left: list[list[int]], right: list[list[int]]) -> list[list[int]]:
        """Pieces of two segments cut inside a stretch without white space.

        The last pieces of the left side may change: a contraction or a blank looks two pieces ahead
        at most. The right side is followed until a piece begins where it began before.
        """
        head, b = left[-3:], 2
        while True:
            tail = right[:b]
            seam = self.raw(head[-1]) + self.raw(tail[0]) if head and tail else b""
            text = b"".join(map(self.raw, head + tail)).decode()
            window = []
            for i, part in enumerate(self._parts(text)):
                window += [part.encode()] if i % 2 else [p.encode() for p in self.pieces(part)]
            if b >= len(right) or (len(window) > 1 and window[-1] == self.raw(tail[-1])):
                ids = [self.join(head[-1], tail[0]) if p == seam else self._piece_or_control(p) for p in window]
                return left[: len(left) - len(head)] + ids + right[b:]
            b *= 2

    def _piece_or_control(self, raw: bytes) -> list[int]:
        control = self.special.get(raw.decode())
        return self.encode_piece(raw) if control is None else [control]


@functools.cache
def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path)


# Operators -----------------------------------------------------------------------------


def cut_text(text: str, size: int, control: list[str]) -> list[tuple[str, bool]]:
    """Segments of about `size` characters, each with whether its cut to the next one is unsafe.

    A safe cut is looked for in the second half of a segment; control strings stay whole.
    """
    segments, at = [], 0
    while len(text) - at > size:
        stop, seam = at + size, True
        for i in range(stop, at + size // 2, -1):
            if text[i] in " \t\n\r\f\v" and not text[i - 1].isspace():
                stop, seam = i, False
                break
        for c in control:
            inside = text.find(c, max(at, stop - len(c) + 1), stop + len(c) - 1) if seam else -1
            if 0 <= inside < stop:
                stop = inside if inside > at else inside + len(c)
        segments.append((text[at:stop], seam))
        at = stop
    return [*segments, (text[at:], False)]


ENCODED = "ids binary, decoded string"


def _encode_batch(path: str, decode: bool) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path)
        ids = own.encode_many([t.decode() for t in texts(batch.column("text"))])
        decoded = [own.decode(i) for i in ids] if decode else [None] * len(ids)
        columns = [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return run


def _cut_batch(path: str, size: int) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        control, rows = list(codec(path).special), []
        for number, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
            before = False
            for i, (part, after) in enumerate(cut_text(text, size, control)):
                rows.append((number, doc_id, i, before, after, part))
                before = after
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
        names = ["row", "doc_id", "segment", "seam_before", "seam_after", "text"]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names)

    return run


def _segment_batch(path: str) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Ids of every segment; where a seam touches it, also the number of ids of every piece."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, ids, counts = codec(path), [], []
        for text, before, after in zip(*(batch.column(c).to_pylist() for c in ("text", "seam_before", "seam_after"))):
            if before or after:
                pieces = own.encode_by_piece(text)
                ids.append(_packed([i for p in pieces for i in p]))
                counts.append([len(p) for p in pieces])
            else:
                ids.append(own.encode(text))
                counts.append([])
        kept = [batch.column(c) for c in ("row", "doc_id", "segment", "seam_after")]
        columns = [*kept, pa.array(ids, pa.binary()), pa.array(counts, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "segment", "seam_after", "ids", "counts"])

    return run


def _join_text(path: str, decode: bool) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        own = codec(path)
        out, open_pieces = [], []
        for row in group.sort_by("segment").to_pylist():
            if not open_pieces and not row["seam_after"] and not row["counts"]:
                out.append(row["ids"])
                continue
            ids, pieces, at = memoryview(row["ids"]).cast("I").tolist(), [], 0
            for n in row["counts"]:
                pieces.append(ids[at : at + n])
                at += n
            open_pieces.append(pieces)
            if not row["seam_after"]:
                out.append(_packed([i for p in _join_tree(own, open_pieces) for i in p]))
                open_pieces = []
        whole = b"".join(out)
        decoded = own.decode(whole) if decode else None
        names = ["doc_id", "ids", "decoded"]
        return pa.Table.from_arrays(
            [pa.array([group["doc_id"][0].as_py()], pa.int64()), pa.array([whole], pa.binary()), pa.array([decoded], pa.string())],
            names,
        )

    return run


def _join_tree(own: Codec, level: list[list[list[int]]]) -> list[list[int]]:
    """Join neighbours until one segment is left."""
    while len(level) > 1:
        pairs = [own.join_segments(a, b) for a, b in zip(level[::2], level[1::2])]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


def encode_texts(docs: DataFrame, path: str = VOCABULARY, decode: bool = False, long_text: int = LONG_TEXT) -> DataFrame:
    """doc_id, ids (little-endian 32-bit numbers) and, if asked for, the text decoded from them."""
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, " + ENCODED
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    is_long = F.coalesce(F.length("text") > long_text, F.lit(False))
    short = per_batch(rows.filter(~is_long), _encode_batch(path, decode), schema)
    long = rows.filter(is_long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    segments = per_batch(
        long,
        _cut_batch(path, long_text),
        "row long, doc_id long, segment int, seam_before boolean, seam_after boolean, text string",
    )
    encoded = per_batch(
        segments.repartition("row", "segment"),
        _segment_batch(path),
        "row long, doc_id long, segment int, seam_after boolean, ids binary, counts array<int>",
    )
    return short.unionByName(encoded.groupBy("row").applyInArrow(_join_text(path, decode), schema))


def decode_ids(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id and text of packed ids."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path)
        decoded = [own.decode(i or b"") for i in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded, pa.string())], ["doc_id", "text"])

    return per_batch(encoded.select("doc_id", "ids"), run, "doc_id long, text string")
