"""What runs inside Python tasks: numpy and Arrow only, so workers import nothing else."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# Similarity ---------------------------------------------------------------------------

# Sort positions below every real similarity: no vector on one side, and no result yet.
UNKNOWN, NOTHING = -2.0, -3.0
SUB_ROWS = 128


def unit_rows(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows in double precision (zero vectors stay zero), and a mask of the missing vectors.

    A vector with a missing element counts as missing.
    """
    missing = vectors.is_null().to_numpy(zero_copy_only=False).copy()
    sizes = vectors.value_lengths().fill_null(0).to_numpy()
    if missing.all():
        return np.zeros((len(vectors), 0)), missing
    width = int(sizes.max())
    flat = vectors.flatten()
    if (sizes[~missing] != width).any():
        raise ValueError("vectors must have one length")
    rows = np.zeros((len(vectors), width))
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy().reshape(-1, width)
    broken = np.isnan(values).any(axis=1)
    rows[~missing] = np.where(broken[:, None], 0.0, values)
    missing[np.flatnonzero(~missing)[broken]] = True
    length = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.where(length == 0, 1.0, length)[:, None], missing


# Candidates whose greatest similarity is taken together, and pairs looked at again at a time.
GROUP, AGAIN = 64, 1 << 16


def _near_best(s: np.ndarray, k: int, off: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the entries within `off` of the row's k-th greatest, and some more.

    The bar is the k-th greatest of the maxima of groups of columns: at least k entries reach it. Only groups
    that reach it are looked into.
    """
    rows, width = s.shape
    group = GROUP if width >= 4 * k * GROUP else 1
    inside = s.reshape(rows, group, width // group)
    tops = inside.max(axis=1)
    place = tops.shape[1] - k
    bar = np.partition(tops, place, axis=1)[:, place] if place > 0 else UNKNOWN
    bar = np.maximum(bar, UNKNOWN) - off
    row, at = np.nonzero(tops >= np.reshape(bar, (-1, 1)))
    floor = np.broadcast_to(bar, rows)[row]
    hit, step = np.nonzero(inside[row, :, at] >= floor[:, None])
    return row[hit], step * (width // group) + at[hit]


def _ranked(k: int, digits: int, ours: tuple, our_row: np.ndarray, asked: np.ndarray, theirs: tuple, their_row: np.ndarray, days: np.ndarray, held: np.ndarray, ids: np.ndarray) -> Iterator[tuple]:
    """(query, id index, similarity) of the k best ids of every query, some queries at a time.

    `ours` and `theirs` are unit rows with their mask; a query is a row of ours and the day it asks on, a column a
    row of theirs, the day it opens and the number of ids it holds. Both are in day order, and `ids` in column order.
    All pairs are compared in single precision; the few near or above a query's bar again in double.
    """
    (ours, our_missing), (theirs, their_missing) = ours, theirs
    id_rank = np.empty(len(ids), dtype=np.int64)
    id_rank[np.argsort(ids)] = np.arange(len(ids))
    first = np.cumsum(held) - held
    comparable = ours.shape[1] == theirs.shape[1] > 0
    # Twice what a product of unit vectors in single precision can be off, and what may tie after rounding.
    off = (ours.shape[1] + 4) * 2.0**-23 + 2 * 10.0**-digits
    coarse = ours.astype(np.float32)
    # Filled up to whole groups with columns that never open.
    more = -len(days) % GROUP
    offered = np.zeros((len(days) + more, theirs.shape[1]), np.float32)
    offered[: len(days)] = theirs.astype(np.float32)[their_row]
    opens = np.concatenate([days, np.full(more, np.iinfo(np.int32).max, days.dtype)])
    unknown = np.flatnonzero(their_missing[their_row])
    for start in range(0, len(asked), SUB_ROWS):
        part = slice(start, start + SUB_ROWS)
        own = our_row[part]
        # Both sides are in day order: what opens after the last asked day is cut off, what opens by the first is open to all.
        width = int(np.searchsorted(days, asked[part][-1], side="right"))
        if not width:
            continue
        width = -(-width // GROUP) * GROUP
        open_to_all = int(np.searchsorted(days, asked[part][0], side="right"))
        s = coarse[own] @ offered[:width].T if comparable else np.zeros((len(own), width), np.float32)
        s[our_missing[own]] = UNKNOWN
        s[:, unknown[: np.searchsorted(unknown, width)]] = UNKNOWN
        late = s[:, open_to_all:]
        late[opens[None, open_to_all:width] > asked[part][:, None]] = NOTHING
        rows, columns = _near_best(s, k, off)
        # Whatever may tie after rounding stays in, then rounding and ids decide.
        values = s[rows, columns].astype(np.float64)
        real = np.flatnonzero(values > UNKNOWN)
        for at in range(0, len(real) if comparable else 0, AGAIN):
            some = real[at : at + AGAIN]
            values[some] = np.einsum("ij,ij->i", ours[own[rows[some]]], theirs[their_row[columns[some]]])
        values = np.round(values, digits) + 0.0
        # Every id of a column has its similarity.
        many = held[columns]
        rows, values = np.repeat(rows, many), np.repeat(values, many)
        found = np.repeat(first[columns] - (np.cumsum(many) - many), many) + np.arange(len(rows))
        order = np.lexsort((id_rank[found], -values, rows))
        rows, found, values = rows[order], found[order], values[order]
        kept = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
        yield rows[kept] + start, found[kept], values[kept]


def _names(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=object)


def search(k: int, digits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Kernel of plain rows: the k best candidates for every query."""
    names = ["point", "analog_id", "similarity"]
    kinds = pa.schema([("point", pa.int64()), ("analog_id", pa.string()), ("similarity", pa.float64())])

    def cell(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return kinds.empty_table()
        queries, candidates = queries.sort_by("day"), candidates.sort_by("day")
        points, ids = queries["point"].to_numpy(), _names(candidates["id"])
        ours, theirs = (unit_rows(t["vector"].combine_chunks()) for t in (queries, candidates))
        each, one = np.arange(len(ids)), np.ones(len(ids), np.int64)
        found = []
        for rows, at, values in _ranked(
            k, digits, ours, np.arange(len(points)), queries["day"].to_numpy(), theirs, each, candidates["day"].to_numpy(), one, ids
        ):
            best = [pa.array(points[rows], pa.int64()), pa.array(ids[at], pa.string()), pa.array(values)]
            found.append(pa.RecordBatch.from_arrays(best, names))
        return pa.Table.from_batches(found, kinds)

    return cell


CELL_ROW = "group long, day int, analog_id string, similarity double"
_CELL = pa.schema([("group", pa.int64()), ("day", pa.int32()), ("analog_id", pa.string()), ("similarity", pa.float64())])


def _flat(lists: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The elements of a column of lists, and the row of each."""
    whole = lists.combine_chunks()
    return whole.flatten(), np.repeat(np.arange(len(whole)), whole.value_lengths().to_numpy())


def search_cell(k: int, digits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Kernel of a grid cell: queries (group, vector, days) and candidates (vector, days, ids), a vector once a side.

    If every candidate opens by the first asked day, one list answers all days of a group (day is NULL);
    otherwise there is a list per group and day.
    """

    def cell(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return _CELL.empty_table()
        groups = queries["group"].to_numpy()
        asked, our_row = _flat(queries["days"])
        days, their_row = _flat(candidates["days"])
        asked, days, ids = asked.to_numpy(), days.to_numpy(), _names(_flat(candidates["ids"])[0])
        whole = bool(days.max() <= asked.min())
        if whole:
            asked, our_row, days = np.zeros(len(groups), np.int32), np.arange(len(groups)), np.zeros(len(days), np.int32)
        # By day, vector and id: a column is a vector and a day, and holds at most its k smallest ids.
        order = np.lexsort((ids, their_row, days))
        days, their_row, ids = days[order], their_row[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], (days[1:] != days[:-1]) | (their_row[1:] != their_row[:-1])]))
        many = np.diff(np.append(starts, len(ids)))
        kept = np.arange(len(ids)) - np.repeat(starts, many) < k
        order = np.argsort(asked, kind="stable")
        asked, our_row = asked[order], our_row[order]
        ours, theirs = (unit_rows(t["vector"].combine_chunks()) for t in (queries, candidates))
        ids, found = ids[kept], []
        for rows, at, values in _ranked(
            k, digits, ours, our_row, asked, theirs, their_row[starts], days[starts], np.minimum(many, k), ids
        ):
            on = pa.nulls(len(rows), pa.int32()) if whole else pa.array(asked[rows], pa.int32())
            best = [pa.array(groups[our_row[rows]], pa.int64()), on, pa.array(ids[at], pa.string()), pa.array(values)]
            found.append(pa.RecordBatch.from_arrays(best, schema=_CELL))
        return pa.Table.from_batches(found, _CELL)

    return cell
