"""Quality rules and model, language ID and PPM against brute force and held-out accuracy."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from premiere.llm import language_id, ppm, quality_model, quality_rules
from premiere.llm.common import id_remainder, table

from .helpers import awkward, empty, prose

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


def base_counts(text):
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = collections.Counter(runs)
    inside = {i + j for i, r in enumerate(runs) if often[r] > 1 for j in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def test_base_counts_equal_brute_force(spark):
    extra = [(50 + i, t, "en") for i, t in enumerate(["a b c d e f g h " * 3, "x " * 9, "p q r s t u v w p q r s t u v w", "é#|  中\v<b"])]
    docs = awkward(spark).select("doc_id", "text", "lang").unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"))
    want = collections.Counter((r.doc_id, *base_counts(r.text)) for r in docs.collect())
    got = quality_rules.quality_rules(docs).collect()
    assert want == collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept is not None and not (r.kept and r.base_failed)


def test_rules_take_awkward_rows_and_no_rows(spark):
    assert quality_rules.quality_rules(awkward(spark)).count() == 12
    assert quality_rules.quality_rules(empty(spark)).count() == 0


def test_jensen_shannon(spark):
    p, q = F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0))
    far, same = spark.range(1).select(quality_rules.jensen_shannon(p, q), quality_rules.jensen_shannon(p, p)).first()
    assert far == pytest.approx(1) and same == 0


def test_rules_drop_what_is_unlike_the_language(spark):
    good = [(i, prose(i, 200) + ".", "en") for i in range(60)]
    bad = [(100 + i, re.sub(r"(\w+)", r"\1%%%", prose(100 + i, 200)), "en") for i in range(3)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality_rules.quality_rules(docs).filter("kept").collect()}
    assert kept == set(range(60))


def test_rare_languages_have_references_of_their_own(spark):
    rows = [(i, "word of it " * 2, "en") for i in range(9_000)]

    def han(i):
        return re.sub(r"[a-z0-9 ]", lambda m: chr(0x4E00 + ord(m[0])), prose(i, 90))

    def russian(i):
        return re.sub(r"[a-z]", lambda m: chr(0x430 + ord(m[0]) - 97), prose(i, 90))

    rows += [(10_000 + i, " ".join(han(i)[k : k + 5] for k in range(0, 300, 5)), "zh") for i in range(8)]
    rows += [(11_000 + i, russian(i), "ru") for i in range(8)] + [(12_000, russian(9), None), (12_001, han(9)[:30], "ja")]
    rows += [(13_000, " ".join(f"{i}%" for i in range(100, 160)), "ru")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs).filter("doc_id >= 10000").collect()}
    assert len(got) == 19
    assert {i for i in got if got[i].kept} == {*range(10_000, 10_008), *range(11_000, 11_008), 12_000}
    assert got[12_000].class_distance is None and got[12_001].class_distance is None
    assert max(got[i].class_distance for i in range(10_000, 10_008)) < 0.05


# Quality model -------------------------------------------------------------------------


def test_model_learns_steps_and_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(quality_model.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality_model.fit(x[:3000], y[:3000])
    assert (0, 3) in model.pairs
    assert (((model.score(x[3000:]) >= 0.5) == y[3000:]).mean()) > 0.95


@pytest.mark.parametrize("y, share", [([], 0.5), ([1.0, 1.0], 1), ([0.0], 0)])
def test_model_without_both_labels(y, share):
    model = quality_model.fit(np.zeros((len(y), len(quality_model.FEATURES))), np.array(y))
    assert model.score(quality_model.features_of([b"", b"a b"])) == pytest.approx([share] * 2, abs=1e-6)


def test_model_held_out_accuracy(spark, folder):
    folder = folder.replace("0.001", "0.01")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rest = id_remainder(F.col("doc_id"), 3)
    model = quality_model.fit_on(quality_model.training_rows(docs, labels, rest != 1))
    held = quality_model.scored(docs, model).filter(rest == 1).join(labels, "doc_id")
    right = held.filter((F.col("quality_score") >= 0.5) == (F.col("quality") == 1)).count()
    assert right >= 0.95 * held.count()


def test_scored_takes_awkward_rows_and_no_rows(spark):
    model = quality_model.fit(np.zeros((0, len(quality_model.FEATURES))), np.zeros(0))
    docs = awkward(spark)
    got = quality_model.scored(docs, model)
    assert got.columns == [*docs.columns, "quality_score"] and got.count() == 12
    assert quality_model.scored(empty(spark), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_model.fit_on(quality_model.training_rows(docs, none, F.lit(True))).base == 0


# Language ID ---------------------------------------------------------------------------


def test_filter_returns_all_languages_of_a_trigram():
    grams, owner = np.arange(3000, dtype=np.uint64), np.arange(3000) % 70
    learned = language_id.build_filter([f"l{i}" for i in range(70)], grams, owner)
    found = learned.members(grams)
    assert all(found[g, o // 64] >> np.uint64(o % 64) & np.uint64(1) for g, o in zip(grams, owner))
    strange = learned.members(np.arange(10**6, 10**6 + 20_000, dtype=np.uint64))
    rate = np.mean([(strange[:, o // 64] >> np.uint64(o % 64) & np.uint64(1)).mean() for o in range(70)])
    assert rate == pytest.approx(learned.false_rate.mean(), abs=0.002)


def test_trigrams_are_those_of_single_texts():
    texts = ["Ab c", None, "", "é1é", "abc" * 5]
    codes, doc = language_id.trigrams(texts)
    alone = [language_id.trigrams([t])[0].tolist() for t in texts]
    assert [codes[doc == i].tolist() for i in range(len(texts))] == alone
    assert len(alone[0]) == 3 and not alone[1]


def test_language_held_out_accuracy(spark, folder):
    docs = table(spark, folder.replace("0.001", "0.01"), "documents")
    rest = id_remainder(F.col("doc_id"), 5)
    held = language_id.identified(docs, language_id.learn(docs, rest != 0)).filter(rest == 0)
    assert held.filter("lang_pred = lang").count() >= 0.97 * held.count()


def test_language_of_awkward_rows_and_no_rows(spark):
    docs = awkward(spark)
    learned = language_id.learn(docs, F.lit(True))
    got = language_id.identified(docs, learned).collect()
    assert len(got) == 12
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.lang_score <= 1
    nothing = language_id.learn(empty(spark), F.lit(True))
    assert {r.lang_pred for r in language_id.identified(docs, nothing).collect()} == {"und"}
    assert language_id.identified(empty(spark), learned).count() == 0


def spelled(seed, first):
    """Words of a text in letters from code point `first` on."""
    return re.sub(r"[a-z0-9]", lambda m: chr(first + int(m[0], 36)), prose(seed, 60))


def test_rare_languages_are_learned_beside_a_common_one(spark):
    rows = [(i, prose(i, 30), "en") for i in range(1200)]
    rows += [(2000 + 10 * k + i, spelled(i, 0x430 + 64 * k), f"rare{k}") for k in range(3) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = {i: lang for i, _, lang in rows}
    for bounds in ({}, {"slice_languages": 2}, {"slice_pairs": 200}):
        learned = language_id.learn(docs, F.lit(True), **bounds)
        assert len(learned.slices) == 1 if not bounds else len(learned.slices) > 1
        got = language_id.identified(docs, learned).collect()
        assert {r.doc_id: r.lang_pred for r in got} == want and len(got) == len(rows)
        assert all(r.lang_score > 0.8 * r.lang_known > 0 for r in got if r.doc_id >= 2000)


def test_slices_hold_their_bounds_and_every_language():
    names, grams = [f"l{i}" for i in range(600)], [90_000] + [700] * 598 + [0]
    slices = language_id.slices_of(names, grams, 256, 1 << 17, 100_000)
    assert [x for s in slices for x in s.languages if s.part == 0] == names
    assert max(len(s.languages) for s in slices) <= 256 and slices[0].parts > 1


# PPM -----------------------------------------------------------------------------------


class Trie:
    """Prediction by partial matching, symbol by symbol."""

    def __init__(self, raws, order):
        self.order, self.counts = order, collections.defaultdict(collections.Counter)
        for raw in raws:
            s = self.symbols(raw)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.counts[k, tuple(s[i - k : i])][s[i]] += 1

    def symbols(self, raw):
        return [257] * self.order + list(raw) + [256]

    def probability(self, context, symbol):
        excluded, p = set(), 1.0
        for k in range(self.order, -1, -1):
            seen = self.counts.get((k, tuple(context[len(context) - k :])), {})
            left = {x: n for x, n in seen.items() if x not in excluded}
            if not left:
                continue
            escape = 0 if k == 0 and len(seen) == 257 else len(left)
            total = sum(left.values()) + escape
            if symbol in left:
                return p * left[symbol] / total
            p *= escape / total
            excluded |= set(seen)
        return p / (257 - len(excluded))

    def score(self, raw):
        s, k = self.symbols(raw), self.order
        return sum(math.log10(self.probability(s[i - k : i], s[i])) for i in range(k, len(s)))


def lowered(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def test_ppm_equals_brute_force_over_blocks(spark):
    docs = awkward(spark).filter("doc_id IS NULL OR doc_id <> 8")
    rows = [(r.doc_id, lowered(r.text)) for r in docs.collect()]
    for order in (2, 4):
        train = [raw for i, raw in rows if i is not None and i % 3]
        trie, counts = Trie(train, order), collections.Counter()
        for raw in train:
            counts.update([*raw.split(), b""])
        n, v = sum(counts.values()), len(counts)
        want = []
        for i, raw in rows:
            tokens = [*raw.split(), b""]
            base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
            held = i is None or not i % 3
            want.append((i or -1, held, len(tokens), sum(counts[t] > 0 for t in tokens), n, base, trie.score(raw)))
        got = ppm.score_texts(docs, F.col("doc_id") % 3 != 0, order, block_bytes=700).collect()
        got = [(r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got]
        for a, b in zip(sorted(want), sorted(got), strict=True):
            assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_ppm_probabilities_sum_to_one():
    trie = Trie([b"abracadabra", b"abc"], 3)
    for context in ([97, 98, 114], [1, 2, 3], [257, 257, 97]):
        assert sum(trie.probability(context, s) for s in range(257)) == pytest.approx(1)


def test_ppm_without_training_and_without_rows(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in ppm.score_texts(docs, F.lit(False)).collect()}
    assert got == pytest.approx({1: -3 * math.log10(257), 2: -math.log10(257)})
    assert ppm.score_texts(empty(spark), F.lit(True)).count() == 0


def test_texts_are_split_and_stripped_once_for_the_quality_counts(spark):
    docs = spark.createDataFrame([(1, "Ab 12 #é."), (2, None)], "doc_id long, text string").selectExpr("*", "'x' AS language", "true AS frequent")
    common = spark.createDataFrame([("x", True, ["ab"])], "language string, frequent boolean, common array<string>")
    out = quality_rules.measured(docs, common, False)
    first = out.filter("doc_id = 1").first()
    assert (first.word_chars, first.class_counts, first.word_counts) == (7, [2.0, 1.0, 2.0, 1.0], [1.0, 2.0])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "split(lower(" not in plan and plan.count("split(coalesce(text") == 1 and plan.count("regexp_replace(") == 4
