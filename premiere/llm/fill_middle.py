"""Fill-in-middle examples, cut by content-defined chunks whose summaries are remembered.

A text's tokens are `[A-Za-z]+|[^A-Za-z]`. Documents share passages, so token counts are kept per chunk, not
per document: a rolling hash over 16 bytes cuts every text where its low bits are zero, so equal passages
fall into equal chunks wherever they stand. A cache held by the task maps a chunk's whole bytes to its
summary: tokens, code points, and whether it begins and ends inside a run of letters. Counts of chunks add
up, less one where a run of letters goes on across the border; the sums tell the chunk that holds the
document's cut, and only that chunk is read again to place it.

Defined cases: a NULL text is empty, an empty text or one with a marker in it stays plain; a NULL id has no
digits in its hash; repeated rows give equal rows; a text of any length is one row's work, its chunks hold
256 bytes on average and 4,096 at most; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premiere.llm.common import bounded_batches, texts

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100

WINDOW = 16  # bytes, a power of two
MEAN_CHUNK, LEAST_CHUNK, MOST_CHUNK = 256, 64, 4096
CACHE_BYTES = 32 << 20  # of chunk bytes, per generation; there are two
_ENTRY = 200  # bytes an entry takes besides its chunk

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _gear() -> np.ndarray:
    """256 well mixed 64-bit numbers, one per byte."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_GEAR = _gear()
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123)]] = True


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Per byte a hash of the WINDOW bytes that end there (of fewer at the front)."""
    h, factor, span = _GEAR[data], 0x9E3779B97F4A7C15, 1
    while span < WINDOW:
        h[span:] = h[span:] + h[:-span] * np.uint64(factor)  # the right side is a copy
        factor, span = factor * factor % 2**64, span * 2
    return h


def chunk_borders(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Per text the borders of its chunks, first and last included, which hang on its own bytes alone."""
    cuts = np.flatnonzero(rolling_hash(data) >> np.uint64(64 - MEAN_CHUNK.bit_length() + 1) == 0) + 1
    low = np.searchsorted(cuts, starts + WINDOW)
    high = np.searchsorted(cuts, ends)
    cuts = cuts.tolist()
    borders = []
    for start, end, a, b in zip(starts.tolist(), ends.tolist(), low.tolist(), high.tolist()):
        own, last = [start], start
        for cut in [*cuts[a:b], end]:
            while cut - last > MOST_CHUNK:
                last += MOST_CHUNK
                own.append(last)
            if cut - last >= LEAST_CHUNK and cut < end:
                own.append(cut)
                last = cut
        if end > start:
            own.append(end)
        borders.append(own)
    return borders


def token_starts(data: np.ndarray, firsts: np.ndarray | None = None) -> np.ndarray:
    """Marks the bytes a token starts at: letters after no letter, and other bytes that begin a code point.

    At `firsts` a run of letters starts anew.
    """
    letter = _IS_LETTER[data]
    goes_on = np.zeros(len(data), bool)
    goes_on[1:] = letter[1:] & letter[:-1]
    if firsts is not None:
        goes_on[firsts] = False
    return ((data & 0xC0) != 0x80) & ~goes_on


class Summaries:
    """Summaries (tokens, code points, begins with a letter, ends with one) by the bytes of chunks.

    A lookup compares the whole chunk, so a hash's collision cannot mix two up. The cache has two
    generations; when the young one is full it becomes the old one, and what is used again moves up.
    """

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.held = most, 0
        self.young: dict[bytes, tuple[int, int, bool, bool]] = {}
        self.old: dict[bytes, tuple[int, int, bool, bool]] = {}

    def _keep(self, chunk: bytes, summary: tuple[int, int, bool, bool]) -> None:
        if self.held > self.most:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[chunk] = summary
        self.held += len(chunk) + _ENTRY

    def of(self, chunks: list[bytes]) -> list[tuple[int, int, bool, bool]]:
        """Summaries of chunks, none of them empty; new ones are counted together."""
        found, new = {}, {}
        for chunk in chunks:
            if chunk in found or chunk in new:
                continue
            known = self.young.get(chunk)
            if known is None and (known := self.old.get(chunk)) is not None:
                self._keep(chunk, known)
            if known is None:
                new[chunk] = None
            else:
                found[chunk] = known
        if new:
            fresh = list(new)
            data = np.frombuffer(b"".join(fresh), np.uint8)
            ends = np.cumsum([len(c) for c in fresh])
            firsts = np.concatenate([[0], ends[:-1]])
            tokens = np.add.reduceat(token_starts(data, firsts).astype(np.int64), firsts)
            points = np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int64), firsts)
            rows = zip(tokens.tolist(), points.tolist(), _IS_LETTER[data[firsts]].tolist(), _IS_LETTER[data[ends - 1]].tolist())
            for chunk, summary in zip(fresh, rows):
                found[chunk] = summary
                self._keep(chunk, summary)
        return [found[c] for c in chunks]


def _cut_in(chunk: bytes, unit: int, continues: bool) -> tuple[int, int]:
    """Bytes and code points of a chunk before its token number `unit`.

    Where the chunk goes on with a run of letters from before, its first token is not its own.
    """
    data = np.frombuffer(chunk, np.uint8)
    at = int(np.flatnonzero(token_starts(data, np.zeros(1, np.int64)))[unit + continues])
    return at, int(((data[:at] & 0xC0) != 0x80).sum())


def numbers_of(doc_id: int | None) -> list[int]:
    """h1 to h4 of an id."""
    digits = hashlib.sha256(b"1:%s" % (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def _example(doc_id: int | None, text: bytes, borders: list[int], chunks: list[bytes], summaries: list) -> tuple:
    """n, form, code points of prefix and middle, and output of one text."""
    before, points, last = [0], [0], False  # tokens and code points ahead of every chunk
    goes_on = []
    for tokens, chars, letter_first, letter_last in summaries:
        goes_on.append(last and letter_first)
        before.append(before[-1] + tokens - goes_on[-1])
        points.append(points[-1] + chars)
        last = letter_last
    n = before[-1]
    h1, h2, h3, h4 = numbers_of(doc_id)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= PLAIN_FROM:
        return n, "plain", None, None, text
    places = []
    for unit in sorted((h1 % (n + 1), h2 % (n + 1))):
        if unit == n:
            places.append((len(text), points[-1]))
            continue
        at = int(np.searchsorted(before, unit, "right")) - 1
        offset, chars = _cut_in(chunks[at], unit - before[at], goes_on[at])
        places.append((borders[at] - borders[0] + offset, points[at] + chars))
    (a, a_chars), (b, b_chars) = places
    head, middle, tail = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        form, parts = "spm", (SUFFIX, tail, PREFIX, head, MIDDLE, middle)
    else:
        form, parts = "psm", (PREFIX, head, SUFFIX, tail, MIDDLE, middle)
    return n, form, a_chars, b_chars - a_chars, b"".join(parts)


def _batch(batch: pa.RecordBatch, cache: Summaries) -> pa.RecordBatch:
    ids, whole = batch.column("doc_id").to_pylist(), texts(batch.column("text"))
    ends = np.cumsum([len(t) for t in whole], dtype=np.int64)
    starts = ends - np.array([len(t) for t in whole], np.int64)
    joined = b"".join(whole)
    borders = chunk_borders(np.frombuffer(joined, np.uint8), starts, ends)
    chunks = [[joined[a:b] for a, b in zip(own, own[1:])] for own in borders]
    known = iter(cache.of([c for own in chunks for c in own]))
    rows = [
        _example(i, t, own, parts, [next(known) for _ in parts]) for i, t, own, parts in zip(ids, whole, borders, chunks)
    ]
    n, form, prefix, middle, output = zip(*rows)
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    columns = [pa.array(v, k) for v, k in zip((ids, n, form, prefix, middle), kinds)]
    columns.append(pa.array(output, pa.binary()).cast(pa.string()))
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_middle(docs: DataFrame) -> DataFrame:
    """Every text as a fill-in-middle example or plain, with its number of tokens and its form."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Summaries()
        for batch in batches:
            if batch.num_rows:
                yield _batch(batch, cache)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def restored(form: Column, output: Column) -> Column:
    """The text of an example: its parts hold no marker, so the first marker after another ends a part."""

    def parts(second: bytes) -> tuple[Column, Column, Column]:
        inner = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
        one = F.substring_index(inner, second.decode(), 1)
        rest = F.substring(inner, F.length(one) + len(second) + 1, F.length(output))
        two = F.substring_index(rest, MIDDLE.decode(), 1)
        return one, two, F.substring(rest, F.length(two) + len(MIDDLE) + 1, F.length(output))

    head, tail, middle = parts(SUFFIX)
    s_tail, s_head, s_middle = parts(PREFIX)
    psm, spm = F.concat(head, middle, tail), F.concat(s_head, s_middle, s_tail)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
