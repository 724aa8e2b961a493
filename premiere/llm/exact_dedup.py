"""Exact dedup against a minimal perfect hash of the digests seen before.

The history's distinct digests are dealt into shards of bounded size. Each shard gets a minimal
perfect hash: a digest takes the first of a row of bit arrays in which it falls on a bit alone, and
the number of set bits before that bit is its slot. A slot holds the full digest, the place of the
document that stays (its id and length) and the group's size. New digests are grouped first, looked
up in the shard's index and compared with the slot's digest byte by byte: members are repeats and
may only change the slot's winner; the others form groups of their own.

Defined cases: a NULL text counts as empty; texts without any character other than white space are
equal to each other; NULL ids lose against all others. Rows that repeat one id with one text are one
group, of which a single row stays. An empty history or batch is allowed. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from premiere.llm.common import SPACE, join_spread
from premiere.session import materialise

SHARD_ROWS = 32_768
GAMMA = 2.0  # bits per digest left in a level
LEVELS = 64
DIGEST = 32

INDEX_SCHEMA = (
    "shard long, level_bits array<int>, bits binary, digests binary, sizes array<long>, "
    "keep_ids array<long>, keep_chars array<long>"
)
GROUP_SCHEMA = "digest binary, keep_id long, keep_chars long, group_size long, in_history boolean"


def text_digest(text: Column) -> Column:
    """SHA-256 (hex) of the text without white space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "").cast("binary"), 256)


def digested(docs: DataFrame, in_history: Column) -> DataFrame:
    """Id, code points and digest of every row, and whether it came before."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        F.length(text).cast("long").alias("n_chars"),
        F.unhex(text_digest(text)).alias("digest"),
        F.coalesce(in_history, F.lit(False)).alias("old"),
    )


def winners(rows: DataFrame) -> DataFrame:
    """One row per digest: the longest original, then the smallest id, and the number of rows."""
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("id")))
    return (
        rows.groupBy("digest")
        .agg(best.alias("b"), F.count(F.lit(1)).alias("size"))
        .select("digest", F.col("b.id").alias("keep_id"), (-F.col("b.n")).alias("keep_chars"), "size")
    )


# The perfect hash of one shard ---------------------------------------------------------


def _words(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words of every digest (n x 32 bytes)."""
    wide = np.ascontiguousarray(digests).view("<u8").reshape(len(digests), DIGEST // 8)
    return wide[:, 0], wide[:, 1]


def _place(a: np.ndarray, b: np.ndarray, level: int, bits: int) -> np.ndarray:
    mixed = (a + np.uint64(level + 1) * b) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(29)) % np.uint64(bits)).astype(np.int64)


def build_levels(digests: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels and all their bits in one boolean array; digests are distinct."""
    a, b = _words(digests)
    left, sizes, parts = np.arange(len(digests)), [], []
    while len(left):
        if len(sizes) == LEVELS:
            raise ValueError("two digests share 128 bits")
        bits = max(8, int(len(left) * GAMMA))
        at = _place(a[left], b[left], len(sizes), bits)
        alone = np.bincount(at, minlength=bits) == 1
        parts.append(alone)
        sizes.append(bits)
        left = left[~alone[at]]
    return sizes, np.concatenate(parts) if parts else np.zeros(0, bool)


def find_slots(digests: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot each digest would have, -1 where no level has a bit for it."""
    a, b = _words(digests)
    rank = np.cumsum(bits) - 1
    slots, left, start = np.full(len(digests), -1, np.int64), np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        at = start + _place(a[left], b[left], level, size)
        hit = bits[at]
        slots[left[hit]] = rank[at[hit]]
        left, start = left[~hit], start + size
    return slots


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, DIGEST)


def _long(column: pa.ChunkedArray) -> np.ndarray:
    """Longs; NULL as the largest, which loses every comparison of ids."""
    return column.fill_null(np.iinfo(np.int64).max).to_numpy().astype(np.int64)


def _index_shard(groups: pa.Table) -> pa.Table:
    digests = _matrix(groups["digest"])
    sizes, bits = build_levels(digests)
    order = np.empty(len(digests), np.int64)
    order[find_slots(digests, sizes, bits)] = np.arange(len(digests))
    row = {
        "shard": [groups["shard"][0].as_py()],
        "level_bits": [sizes],
        "bits": [np.packbits(bits).tobytes()],
        "digests": [digests[order].tobytes()],
        "sizes": [groups["size"].to_numpy()[order]],
        "keep_ids": [_long(groups["keep_id"])[order]],
        "keep_chars": [groups["keep_chars"].to_numpy()[order]],
    }
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.binary()] + [pa.list_(pa.int64())] * 3
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(row.items(), kinds)})


def _look_up(new: pa.Table, index: pa.Table) -> pa.Table:
    """Final groups of one shard: every slot after the new members, then the nonmembers."""
    digests = _matrix(new["digest"])
    ids, chars, sizes = _long(new["keep_id"]), new["keep_chars"].to_numpy(), new["size"].to_numpy()
    if index.num_rows:
        row = {k: v[0] for k, v in index.to_pydict().items()}
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["level_bits"])).astype(bool)
        held = np.frombuffer(row["digests"], np.uint8).reshape(-1, DIGEST)
        h_ids, h_chars, h_sizes = (np.array(row[k], np.int64) for k in ("keep_ids", "keep_chars", "sizes"))
        slots = find_slots(digests, row["level_bits"], bits)
        member = slots >= 0
        member[member] = (held[slots[member]] == digests[member]).all(axis=1)
        at = slots[member]
        better = (chars[member] > h_chars[at]) | ((chars[member] == h_chars[at]) & (ids[member] < h_ids[at]))
        h_sizes[at] += sizes[member]
        h_ids[at[better]], h_chars[at[better]] = ids[member][better], chars[member][better]
        digests = np.concatenate([held, digests[~member]])
        ids, chars = np.concatenate([h_ids, ids[~member]]), np.concatenate([h_chars, chars[~member]])
        sizes = np.concatenate([h_sizes, sizes[~member]])
        known = np.arange(len(digests)) < len(held)
    else:
        known = np.zeros(len(digests), bool)
    none = ids == np.iinfo(np.int64).max
    return pa.table(
        {
            "digest": pa.array([d.tobytes() for d in digests], pa.binary()),
            "keep_id": pa.array(ids, pa.int64(), mask=none),
            "keep_chars": pa.array(chars, pa.int64()),
            "group_size": pa.array(sizes, pa.int64()),
            "in_history": pa.array(known),
        }
    )


# Operators -----------------------------------------------------------------------------


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    return groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard with the perfect hash and slots of the history's digests (see winners)."""
    return _sharded(history, shards).groupBy("shard").applyInArrow(_index_shard, INDEX_SCHEMA)


def look_up(batch: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """One row per digest of history and batch: who stays, group size, whether history had it."""
    new = _sharded(batch, shards)
    return new.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_look_up, GROUP_SCHEMA)


def exact_dedup(docs: DataFrame, in_history: Column) -> DataFrame:
    """Every row with the row of its group that stays.

    `in_history` tells the rows that came before; all others are looked up in their index.
    Runs jobs when called: the digests, the index and the groups are written to the shared folder.
    """
    rows = materialise(digested(docs, in_history), "digests")
    history, batch = winners(rows.filter("old")), winners(rows.filter("NOT old"))
    shards = max(1, -(-rows.select(F.approx_count_distinct("digest")).first()[0] // SHARD_ROWS))
    index = materialise(build_index(history, shards), "digest-index")
    groups = materialise(look_up(batch, index, shards), "digest-groups")
    joined = join_spread(rows.select("digest", "doc_id", "n_chars"), groups, "digest", "group_size")
    same = Window.partitionBy("digest", "doc_id").orderBy(F.col("n_chars").desc())
    first = F.row_number().over(same) == 1
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "in_history",
    )
