"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprints that differ in at most `radius` bits are linked; documents of one connected component
form a group. Every bit position gets a nonzero vector of radius + 1 bits; for every nonzero vector v
a mask keeps the positions whose vector has odd product with v. The differing positions of a pair span
at most `radius` dimensions, so some v is orthogonal to all of them: its mask keeps none of them, and
the pair is equal under that mask. Every linked pair therefore meets in some table; none is missed.

Equal fingerprints are one row before they meet. A bucket is scanned as a sorted stream; its links are
a forest, not all pairs. A bucket over HOT_BUCKET rows is dealt again by a second covering of the
bits its mask leaves out; about a quarter of the 64 bits are then free, so a second bucket holds at most
2^16 fingerprints however many rows there are.

Defined cases: NULL and empty texts have no word and fingerprint zero, linked like any other; NULL ids
get a group, named by its smallest id that is not NULL; repeated rows are rows of one group; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiere.llm.common import bounded_batches, join_spread, per_batch, texts
from premiere.llm.components import components
from premiere.session import materialise

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
HOT_BUCKET = 1 << 15
SMALL_RUN = 16
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


# Fingerprints --------------------------------------------------------------------------


def shingle_hashes(raw: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 of every run of `size` words; of all words where there are fewer; none without words."""
    words = raw.lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(line, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())]


def fingerprints_of(raws: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints: a bit is set if it is set in over half of the hashes."""
    hashes = [shingle_hashes(r, size) for r in raws]
    n = np.array([len(h) for h in hashes], np.int64)
    flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(n.sum()))
    planes, doc = flat.astype("<u8").view(np.uint8).reshape(-1, 8), np.repeat(np.arange(len(n)) * 256, n)
    out = np.zeros(len(n), np.uint64)
    for byte in range(8):
        seen = np.bincount(doc + planes[:, byte], minlength=len(n) * 256).reshape(len(n), 256) @ _BYTE_BITS
        set_bits = np.packbits(2 * seen > n[:, None], axis=1, bitorder="little")[:, 0]
        out |= set_bits.astype(np.uint64) << np.uint64(8 * byte)
    return out


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = fingerprints_of(texts(batch.column("text")), size).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return per_batch(rows, run, "doc_id long, fp long")


# Covering ------------------------------------------------------------------------------


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """One mask per nonzero vector of radius + 1 bits, as signed 64-bit numbers."""
    top = 1 << (radius + 1)
    vector = {p: i % (top - 1) + 1 for i, p in enumerate(positions)}
    masks = []
    for v in range(1, top):
        mask = sum(1 << p for p in positions if (vector[p] & v).bit_count() % 2)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def _second_masks(first: int, radius: int) -> list[int]:
    """First mask with every mask of a covering of the positions it leaves out."""
    free = [p for p in range(BITS) if not (first >> p) & 1]
    return [first | m for m in covering_masks(free, radius)]


def _bucketed(fps: DataFrame, radius: int) -> DataFrame:
    masks = covering_masks(list(range(BITS)), radius)
    entries = [F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
    return fps.select("fp", F.explode(F.array(*entries)).alias("b")).select("b.mask", "b.key", "fp")


def _dealt_again(hot: DataFrame, radius: int) -> DataFrame:
    masks = covering_masks(list(range(BITS)), radius)
    second = F.array(*[F.array(*[F.lit(s) for s in _second_masks(m, radius)]) for m in masks])
    dealt = hot.select("mask", "fp", F.posexplode(second[F.col("mask")]).alias("sub", "second"))
    own = (F.lit(len(masks)) + F.col("mask") * len(masks) + F.col("sub")).cast("int")
    return dealt.select(own.alias("mask"), F.col("fp").bitwiseAND(F.col("second")).alias("key"), "fp")


def _within(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= radius


def _grow(fps: np.ndarray, radius: int) -> list[tuple[np.ndarray, int]]:
    """Components of one bucket: members but the first, and the first, for those of two or more."""
    left, found = fps, []
    while len(left):
        seed, left = left[0], left[1:]
        frontier, members = np.array([seed]), []
        while len(frontier) and len(left):
            near = np.zeros(len(left), bool)
            step = max(1, (1 << 20) // len(left))
            for i in range(0, len(frontier), step):
                near |= _within(frontier[i : i + step, None], left[None, :], radius).any(axis=0)
            frontier, left = left[near], left[~near]
            members.append(frontier)
        if members and sum(map(len, members)):
            found.append((np.concatenate(members), seed))
    return found


def bucket_links(run: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the complete buckets in sorted rows; `run` numbers the buckets."""
    sizes = np.bincount(run)
    size = sizes[run]
    us, vs = [], []
    small = np.flatnonzero((size > 1) & (size <= SMALL_RUN))
    r, f = run[small], fps[small]
    for lag in range(1, SMALL_RUN):
        if lag >= len(r):
            break
        at = np.flatnonzero(r[lag:] == r[:-lag])
        if not len(at):
            break
        near = at[_within(f[at], f[at + lag], radius)]
        us.append(f[near + lag])
        vs.append(f[near])
    starts = np.cumsum(sizes) - sizes
    for b in np.flatnonzero(sizes > SMALL_RUN):
        for members, seed in _grow(fps[starts[b] : starts[b] + sizes[b]], radius):
            us.append(members)
            vs.append(np.full(len(members), seed))
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(us or empty), np.concatenate(vs or empty)


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    held = [np.zeros(0, np.int64)] * 3

    def linked(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        run = np.concatenate([[0], np.cumsum((mask[1:] != mask[:-1]) | (key[1:] != key[:-1]))])
        u, v = bucket_links(run, fp, radius)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for batch in batches:
        new = [batch.column(c).to_numpy().astype(np.int64) for c in ("mask", "key", "fp")]
        held = [np.concatenate([h, n]) for h, n in zip(held, new)]
        if not len(held[0]):
            continue
        change = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]))
        if not len(change):
            continue
        stop = change[-1] + 1
        yield linked(*[h[:stop] for h in held])
        held = [h[stop:] for h in held]
    if len(held[0]):
        yield linked(*held)


def near_links(fps: DataFrame, radius: int = RADIUS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Links (u, v) between distinct fingerprints whose closure is that of all near pairs."""
    bounded_batches(fps.sparkSession)
    buckets = _bucketed(fps, radius)
    hot = buckets.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_bucket).drop("n")
    hot = materialise(hot, "hot-buckets")
    if hot.isEmpty():
        rows = buckets
    else:
        cool = buckets.join(hot, ["mask", "key"], "left_anti")
        rows = cool.unionByName(_dealt_again(buckets.join(hot, ["mask", "key"], "left_semi"), radius))
    sorted_rows = rows.repartition("mask", "key").sortWithinPartitions("mask", "key")
    return sorted_rows.mapInArrow(lambda it: _links(it, radius), "u long, v long")


# Operator ------------------------------------------------------------------------------


def near_groups(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, group_size of every row.

    Runs jobs when called: fingerprints, links and rounds of the components are written.
    """
    rows = materialise(fingerprints(docs, size), "fingerprints")
    groups = rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = materialise(groups, "fingerprint-groups")
    linked = components(near_links(groups.select("fp"), radius, hot_bucket))
    named = groups.join(linked, groups["fp"] == linked["node"], "left").select(
        "fp", "first", "n", F.coalesce("component", "fp").alias("component")
    )
    whole = named.groupBy("component").agg(
        F.min("first").alias("component_id"), F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("m")
    )
    placed = join_spread(named, materialise(whole, "components"), "component", "m").drop("m")
    placed = materialise(placed.select("fp", "n", "component_id", "group_size"), "fingerprint-components")
    return join_spread(rows, placed, "fp", "n").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group_size"
    )
