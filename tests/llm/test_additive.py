"""The quality model's parts against plain Python: features, cuts, one boosting round, look-ups."""

import bisect
import math
from collections import Counter

import numpy as np
import pytest

from premiere.llm import quality_model as qm

from .helpers import prose


def plain_features(raw):
    if not raw:
        return [0.0] * len(qm.FEATURES)
    words, lines, counts = raw.split(), raw.split(b"\n"), Counter(raw)
    n = max(1, len(words))
    out = [math.log1p(len(raw))]
    out += [sum(counts[b] for b in set(group)) / len(raw) for group in qm._GROUPS.values()]
    out += [sum(len(w) for w in words) / n, len(set(words)) / n, n / len(lines), len(set(lines)) / len(lines)]
    return out + [max(len(x) for x in lines) / len(raw), max([counts[b] for b in range(33, 256)]) / len(raw)]


def test_features_equal_plain_counts():
    raws = [b"", b" ", b"\n\n", b"A b! b!\nA b! b!\n", "é中 1,2".encode(), prose(3, 400).encode(), b"x" * 5000, bytes(range(1, 256))]
    for row, raw in zip(qm.features_of(raws), raws):
        assert row.tolist() == pytest.approx(plain_features(raw))


def plain_cut(g, h, n):
    """Every cut tried."""
    best = (0.0, 0)
    for at in range(1, len(g)):
        if min(sum(n[:at]), sum(n[at:])) < qm.MIN_LEAF:
            continue
        sides = [(sum(g[s]), sum(h[s])) for s in (slice(None, at), slice(at, None))]
        gain = sum(a * a / (b + qm.RIDGE) for a, b in sides) - sum(g) ** 2 / (sum(h) + qm.RIDGE)
        if gain > best[0] + 1e-12:
            best = (gain, at)
    return best


def plain_tree(g, h, n, depth):
    at = plain_cut(g, h, n)[1] if depth else 0
    if not at:
        return [sum(g) / (sum(h) + qm.RIDGE)] * len(g)
    return plain_tree(g[:at], h[:at], n[:at], depth - 1) + plain_tree(g[at:], h[at:], n[at:], depth - 1)


def test_trees_equal_all_cuts_tried():
    rng = np.random.default_rng(2)
    for bins in (1, 2, 7, 32):
        for _ in range(20):
            g, h, n = rng.normal(size=bins) * 9, rng.random(bins) * 9, rng.integers(0, 30, bins)
            for depth in (0, 1, 2):
                got = qm._shallow_tree(g, h, n, depth)
                assert got.tolist() == pytest.approx(plain_tree(g.tolist(), h.tolist(), n.tolist(), depth))


def test_scores_equal_sums_of_looked_up_bins():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, len(qm.FEATURES)))
    x[:100] = np.round(x[:100])  # on borders
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = qm.fit(x, y)
    assert model.pairs
    for row, score in zip(x, model.score(x)):
        total = model.base + sum(t[bisect.bisect_right(e.tolist(), v)] for t, e, v in zip(model.tables, model.edges, row))
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[bisect.bisect_right(model.pair_edges[a].tolist(), row[a])][bisect.bisect_right(model.pair_edges[b].tolist(), row[b])]
        assert score == pytest.approx(1 / (1 + math.exp(-max(-30.0, min(30.0, total)))))


def test_the_first_round_takes_one_tree_per_feature(monkeypatch):
    monkeypatch.setattr(qm, "ROUNDS", 1)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    y = (x[:, 2] > 0.3).astype(float)
    model = qm.fit(x, y)
    share = y.mean()
    total = [math.log(share / (1 - share))] * len(y)
    for j in range(3):
        p = [1 / (1 + math.exp(-t)) for t in total]
        bins = [bisect.bisect_right(model.edges[j].tolist(), v) for v in x[:, j]]
        size = len(model.edges[j]) + 1
        g, h, n = [0.0] * size, [0.0] * size, [0] * size
        for i, b in enumerate(bins):
            g[b], h[b], n[b] = g[b] + y[i] - p[i], h[b] + p[i] * (1 - p[i]), n[b] + 1
        step = [qm.RATE * v for v in plain_tree(g, h, n, 2)]
        assert model.tables[j].tolist() == pytest.approx(step)
        total = [t + step[b] for t, b in zip(total, bins)]
