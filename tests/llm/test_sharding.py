"""The weighted hash tree against a plain descent, and what moves when it changes."""

import hashlib
import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from premiere.llm import sharding
from premiere.llm.sharding import Shard

from .helpers import awkward, empty


def plain_shard(key, tree):
    at, left = "", [s for s in tree if s.weight > 0]
    for level in range(3):
        draws = {}
        for s in left:
            path = "/".join(str(x) for x in s[: level + 1])
            draws.setdefault(path, []).append(s)

        def draw(path):
            u = (int(hashlib.md5(f"{key}|{path}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return -math.log(u) / sum(s.weight for s in draws[path])

        at = min(draws, key=draw)
        left = draws[at]
    return left[0].shard


def placed(spark, tree, n=20_000):
    return {r.id: r.s for r in spark.range(n).select("id", sharding.shard_of(F.col("id"), tree).alias("s")).collect()}


WEIGHTED = [Shard(0, 0, 0, 1.0), Shard(0, 0, 1, 2.0), Shard(0, 1, 2, 0.0), Shard(1, 2, 3, 3.0), Shard(1, 3, 4, 1.5), Shard(2, 4, 5, 0.5)]


def test_descent_equals_the_plain_one(spark):
    for tree in (sharding.even_tree(8), sharding.grown(sharding.even_tree(8)), WEIGHTED, sharding.even_tree(1)):
        assert placed(spark, tree, 1000) == {i: plain_shard(i, tree) for i in range(1000)}


def test_shares_follow_weights(spark):
    total = sum(s.weight for s in WEIGHTED)
    counts = Counter(placed(spark, WEIGHTED).values())
    assert counts[2] == 0
    for s in WEIGHTED:
        want = 20_000 * s.weight / total
        assert abs(counts[s.shard] - want) <= 5 * math.sqrt(want)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    tree = sharding.even_tree(8)
    for _ in range(3):
        more = sharding.grown(tree)
        before, after = placed(spark, tree), placed(spark, more)
        moved = [i for i in before if before[i] != after[i]]
        assert {after[i] for i in moved} == {more[-1].shard}
        assert abs(len(moved) - 20_000 / len(more)) < 5 * math.sqrt(20_000 / len(more))
        tree = more


def test_a_changed_weight_moves_only_its_subtree(spark):
    tree = sharding.even_tree(8)
    heavier = [s._replace(weight=2.0) if s.shard == 5 else s for s in tree]
    before, after = placed(spark, tree), placed(spark, heavier)
    moves = {(before[i], after[i]) for i in before if before[i] != after[i]}
    region, rack = {s.shard: s.region for s in tree}, {s.shard: s.rack for s in tree}
    assert moves and all(region[b] == 1 for _, b in moves)  # nothing moves into the other region
    inside = {(a, b) for a, b in moves if region[a] == 1}
    assert all(rack[b] == rack[5] for _, b in inside)  # nor, inside the region, into the other rack
    assert all(b == 5 for a, b in inside if rack[a] == rack[5])


def test_slots_are_gapless_over_awkward_rows(spark):
    docs = awkward(spark).withColumns({c: F.lit(1) for c in ("shard", "slot", "at", "slice", "size", "grown_shard")})
    tree = sharding.even_tree(8)
    rows = sharding.shard_documents(docs, tree, sharding.grown(tree)).collect()
    given = docs.collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in given)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    for r in rows:
        key = "" if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard) == (plain_shard(key, tree), plain_shard(key, sharding.grown(tree)))
    check_slots(rows)
    assert sharding.shard_documents(empty(spark), tree).count() == 0


def check_slots(rows):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append((r.slot, r.doc_id is not None, r.doc_id or 0))
    for own in by_shard.values():
        own.sort()
        assert [s for s, *_ in own] == list(range(len(own)))
        assert [x[1:] for x in own] == sorted(x[1:] for x in own)


def test_a_hot_id_is_dealt_over_many_slices(spark):
    ids = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id"))
    rows = sharding.shard_documents(spark.range(0, 9000, 1, 5).select(ids.alias("doc_id"), F.lit("same").alias("text")), sharding.even_tree(3))
    got = rows.collect()
    assert len(got) == 9000
    check_slots(got)
