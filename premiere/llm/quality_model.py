"""Quality classifier: a generalised additive model with pairwise interactions.

Shape features of a text are cut into bins at quantiles. The model is one lookup table per feature and one
per chosen pair of features; a score is the logistic of the sum of the looked-up values. Tables are
learned by cyclic boosting: round after round every feature in turn gets a shallow tree on its
bins, fitted to the gradient and added with a small rate, so that no feature takes what another
explains as well. Pairs are then ranked by what one tree on both would gain and boosted likewise.

The fit sees at most TRAIN_ROWS labelled rows (those with the least hash of their id), whose
features reach the driver: some 2 MB. Scoring is a sum of table rows per batch, over all documents.

Defined cases: NULL texts are empty and are scored like any text; rows with a NULL id or label are never
learned from; without labels of both kinds every score is the share of label 1 (0.5 without any); of
two different labels of one id both count; repeated rows are scored row by row; a very long text is one row's
work; an empty table gives no rows. Other columns are kept, but for a `quality_score` of the caller's, which is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premiere.llm.common import per_batch, texts

TRAIN_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 6
RATE = 0.1
RIDGE = 1.0
MIN_LEAF = 10

_GROUPS = {
    "lower": bytes(range(97, 123)) + bytes(range(128, 256)),
    "upper": bytes(range(65, 91)),
    "digit": bytes(range(48, 58)),
    "space": b" \t\n\v\f\r",
    "stop": b".,;:?'\"()-",
    "shout": b"!",
    "symbol": b"#*$%&|<>{}[]^~=+_@\\/`",
}
FEATURES = (
    "log_bytes",
    *_GROUPS,
    "word_length",
    "distinct_words",
    "words_per_line",
    "distinct_lines",
    "longest_line",
    "commonest_byte",
)


# Features ------------------------------------------------------------------------------


def features_of(raws: list[bytes]) -> np.ndarray:
    """One row of FEATURES per text."""
    table = np.zeros((256, len(_GROUPS)))
    for i, group in enumerate(_GROUPS.values()):
        table[list(group), i] = 1
    out = np.zeros((len(raws), len(FEATURES)))
    for row, raw in zip(out, raws):
        if not raw:
            continue
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        words, lines = raw.split(), raw.split(b"\n")
        k = 1 + len(_GROUPS)
        row[0] = np.log1p(len(raw))
        row[1:k] = counts @ table / len(raw)
        n = max(1, len(words))
        row[k:] = (
            sum(map(len, words)) / n,
            len(set(words)) / n,
            n / len(lines),
            len(set(lines)) / len(lines),
            max(map(len, lines)) / len(raw),
            counts[33:].max() / len(raw),
        )
    return out


# Model ---------------------------------------------------------------------------------


@dataclass
class Additive:
    """Lookup tables of a fitted model."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            at = [np.searchsorted(self.pair_edges[j], x[:, j], side="right") for j in (a, b)]
            total += table[at[0], at[1]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins; place 0 when there is none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = gl * _leaf(gl, hl) + gr * _leaf(gr, hr) - g.sum() * _leaf(g.sum(), h.sum())
    gain = np.where((nl >= MIN_LEAF) & (nr >= MIN_LEAF), gain, 0)
    at = int(np.argmax(gain))
    return float(gain[at]), (at + 1 if gain[at] > 0 else 0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of every bin of a tree of the given depth."""
    _, at = _best_cut(g, h, n) if depth else (0.0, 0)
    if not at:
        return np.full(len(g), _leaf(g.sum(), h.sum()))
    parts = [_shallow_tree(g[s], h[s], n[s], depth - 1) for s in (slice(None, at), slice(at, None))]
    return np.concatenate(parts)


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree that cuts one feature, then each side by the other."""
    best = (0.0, np.full(g.shape, _leaf(g.sum(), h.sum())))
    whole = g.sum() * _leaf(g.sum(), h.sum())
    for turned in (False, True):
        a, b, c = (x.T if turned else x for x in (g, h, n))
        for at in range(1, len(a)):
            value, gain = np.zeros(a.shape), -whole
            for side in (slice(None, at), slice(at, None)):
                gs, hs, ns = a[side].sum(0), b[side].sum(0), c[side].sum(0)
                leaves = _shallow_tree(gs, hs, ns, 1)
                value[side] = leaves
                gain += float((gs * leaves).sum())
            if gain > best[0]:
                best = (gain, value.T if turned else value)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Boost the tables of single features, then those of the pairs that gain most."""
    share = float(y.mean()) if len(y) else 0.5
    if not len(y):
        return Additive(0.0)
    if not 0 < share < 1:
        return Additive(30.0 if share == 1 else -30.0)
    columns = range(x.shape[1])
    model = Additive(float(np.log(share / (1 - share))))
    model.edges = [_edges(x[:, j], BINS) for j in columns]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in columns]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]
    total = np.full(len(y), model.base)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in columns:
            g, h = gradient()
            size = len(model.tables[j])
            step = RATE * _shallow_tree(
                np.bincount(bins[j], g, size), np.bincount(bins[j], h, size), counts[j]
            )
            model.tables[j] += step
            total += step[bins[j]]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def cells(a: int, b: int, weights: np.ndarray | None) -> np.ndarray:
        at = coarse[a] * sizes[b] + coarse[b]
        return np.bincount(at, weights, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    g, h = gradient()
    gains = [(_pair_tree(cells(a, b, g), cells(a, b, h), cells(a, b, None))[0], a, b) for a in columns for b in columns if a < b]
    model.pairs = [(a, b) for gain, a, b in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            g, h = gradient()
            step = RATE * _pair_tree(cells(a, b, g), cells(a, b, h), cells(a, b, None))[1]
            model.pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return model


# Operators -----------------------------------------------------------------------------


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """Texts and labels of at most `rows` labels; `learn` is a condition on doc_id.

    Of several texts with one id the smallest is taken, so repeated rows do not add to the bound.
    """
    chosen = labels.filter(learn & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    chosen = chosen.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen.distinct()), "doc_id")
    return labelled.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).select("text", "quality")


def fit_on(rows: DataFrame) -> Additive:
    """Fit on text and quality of bounded rows (see training_rows)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features_of(texts(batch.column("text")))
        columns = [pa.array(list(x), pa.list_(pa.float64())), batch.column("quality")]
        return pa.RecordBatch.from_arrays(columns, ["x", "y"])

    got = per_batch(rows.withColumn("quality", F.col("quality").cast("double")), run, "x array<double>, y double")
    got = got.toPandas().sort_values("x", key=lambda c: c.map(tuple), ignore_index=True)
    x = np.array(got["x"].tolist()).reshape(-1, len(FEATURES))
    return fit(x, got["y"].to_numpy(float))


def scored(docs: DataFrame, model: Additive) -> DataFrame:
    """All rows of docs with `quality_score`, from 0 to 1."""
    names = [c for c in docs.columns if c != "quality_score"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = model.score(features_of(texts(batch.column("text"))))
        return pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(score)], [*names, "quality_score"])

    schema = docs.select(*names).schema.add("quality_score", "double")
    return per_batch(docs.select(*names), run, schema)

