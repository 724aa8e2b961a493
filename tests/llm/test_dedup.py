"""Exact, near and line dedup against brute force."""

import hashlib
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from premiere.llm import components, exact_dedup, line_dedup, simhash

from .helpers import awkward, empty, prose

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_perfect_hash_gives_every_digest_its_own_slot_and_rejects_by_digest():
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), np.uint8).reshape(-1, 32)
    sizes, bits = exact_dedup.build_levels(digests[:4000])
    slots = exact_dedup.find_slots(digests[:4000], sizes, bits)
    assert sorted(slots) == list(range(4000))
    assert exact_dedup.find_slots(digests[4000:], sizes, bits).max() < 4000


def expected_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(bare(t), []).append((-len(t or ""), i is None, i or 0))
    return {k: (None if min(v)[1] else min(v)[2], len(v)) for k, v in groups.items()}


def test_exact_dedup_over_awkward_rows_whatever_the_history(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected_groups(rows)
    for old in (F.lit(True), F.lit(False), F.col("doc_id") % 2 == 0):
        got = exact_dedup.exact_dedup(docs, old).collect()
        assert len(got) == len(rows)
        by_hash = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
        assert all((r.keep_id, r.group_size) == by_hash[r.text_sha256] for r in got)
        kept = [r.text_sha256 for r in got if r.kept]
        assert sorted(kept) == sorted(by_hash)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(empty(spark), F.lit(True)).count() == 0


def fingerprint(text):
    words = WORD.findall((text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_every_pair_within_the_radius_meets_under_a_mask():
    masks = [m % 2**64 for m in simhash.covering_masks(list(range(64)), 4)]
    rng = np.random.default_rng(1)
    for _ in range(2000):
        flip = sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False))
        assert any(not flip & m for m in masks)
    free = {bin(m).count("1") for first in masks for m in (x % 2**64 for x in simhash._second_masks(first, 4))}
    assert min(free) >= 48  # a second bucket holds at most 2^16 fingerprints


def brute_components(fps):
    label = np.arange(len(fps))
    for i, fp in enumerate(fps):
        near = np.bitwise_count(fps ^ fp) <= 4
        least = label[near].min()
        label[np.isin(label, label[near])] = least
    return label


def test_simhash_equals_brute_force_also_in_hot_buckets(spark):
    base = prose(5, 300).split()
    texts = []
    for i in range(150):
        words = list(base)
        words[i % 300] = f"new{i % 50}"
        texts.append(" ".join(words))
    docs = awkward(spark).select("doc_id", "text").unionByName(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    )
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = np.array([fingerprint(t) for _, t in rows], np.uint64)
    label = brute_components(fps)
    smallest = {g: min((rows[i][0] for i in np.flatnonzero(label == g) if rows[i][0] is not None), default=None) for g in set(label)}
    want = sorted(((i is None, i or 0), f"{int(f):016x}", smallest[g] or 0) for (i, _), f, g in zip(rows, fps, label))
    for hot in (simhash.HOT_BUCKET, 4):
        got = simhash.near_groups(docs, hot_bucket=hot).collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.fingerprint, r.component_id or 0) for r in got) == want


def test_simhash_of_nothing(spark):
    assert simhash.near_groups(empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.range(300).selectExpr("id u", "id + 1 v").unionByName(spark.sql("SELECT 1000L u, 1001L v"))
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def brute_lines(rows, min_words):
    """Delete every line inside a run of min_words words or more whose lines occur earlier; all runs are tried."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seqs = {i: [(p, x) for p, x in enumerate((rows[i][1] or "").split("\n")) if x.split()] for i in order}
    first, gone = {}, {i: set() for i in order}
    for i in order:
        lines = [x for _, x in seqs[i]]
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = tuple(lines[a:b])
                if sum(len(x.split()) for x in run) >= min_words and first.setdefault(run, (i, a)) != (i, a):
                    gone[i] |= set(range(a, b))
    out = []
    for i, (doc, text) in enumerate(rows):
        drop = {seqs[i][k][0] for k in gone[i]}
        left = None if text is None else "\n".join(x for p, x in enumerate(text.split("\n")) if p not in drop)
        out.append((doc, left if not drop or (left and left.split()) else "", len(drop)))
    return out


def sortable(rows):
    return sorted(rows, key=repr)


def test_line_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    pool = [prose(i, int(rng.integers(1, 9))) for i in range(12)] + [""]
    rows = [(int(i) if i % 7 else None, "\n".join(pool[int(k)] for k in rng.integers(0, 13, rng.integers(0, 14)))) for i in range(60)]
    rows += [(200, "a\n\na\na\n"), (200, "a\n\na\na\n"), (201, None), (202, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for least in (1, 5, 12):
        got = [(r.doc_id, r.text, r.deleted_lines) for r in line_dedup.line_dedup(docs, least).collect()]
        assert sortable(got) == sortable(brute_lines(rows, least))


def test_line_dedup_keeps_other_columns_and_takes_awkward_rows(spark):
    docs = awkward(spark)
    got = line_dedup.line_dedup(docs)
    assert got.columns == [*docs.columns, "deleted_lines"]
    assert {r.row for r in got.collect()} == {7}
    texts = [r.text for r in got.filter("doc_id < 3").collect()]
    assert sorted(map(len, texts))[:2] == [0, 0] and sum(map(len, texts)) == len(prose(1, 90))
    assert line_dedup.line_dedup(empty(spark)).count() == 0


def test_line_dedup_takes_a_short_boilerplate_line_and_leaves_chance_repeats(spark):
    notice, chance = "All rights reserved by the owners of this site", "see the next page"
    rows = [(i, "\n".join([prose(i, 30), notice, prose(100 + i, 30), chance])) for i in range(5)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if notice in r.text} == {0}
    assert all(chance in r.text and r.deleted_lines == (r.doc_id > 0) for r in got)
