"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from premiere.llm import phrases as mining

from .helpers import awkward, empty


def plain_phrases(rows, least, longest, top):
    """The contract over (lang, text), phrase by phrase."""
    counts = {}
    for lang, text in rows:
        own = counts.setdefault(lang or "und", Counter())
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            own.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        n = sum(a for p, a in own.items() if len(p) == 1)
        good = {p: a for p, a in own.items() if a >= least}
        found = []
        for p, a in good.items():
            if len(p) == 1:
                continue
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in good.items()
            )
            if not inside:
                score, k = min((1000 * a * n // (good[p[:k]] * good[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), good[p[:k]], good[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def some_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "THE", "of", "a", "New", "york", "city", "é", "中", "x1", "<b>", "\x1c", "ﬁ"]
    rows = []
    for _ in range(n):
        parts = [rng.choice([*words, "new york city", "as well as the", "in the long run we"]) + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for _ in range(rng.randint(0, 60))]
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), "".join(parts)))
    return rows + [("en", None), ("fr", ""), (None, " . "), ("zz", "..!"), ("en", "big apple " * 3000)]


@pytest.mark.parametrize("small", [False, True])
def test_phrases_equal_plain_counting(spark, monkeypatch, small):
    if small:  # many tries, several rounds, many ranges of counters and states
        for name, value in {"TRIE_PHRASES": 60, "TRIES_AT_ONCE": 2, "counter_bits": lambda n: 21, "KNOWN_PHRASES": 5, "STATE_BITS": 3}.items():
            monkeypatch.setattr(mining, name, value)
    rows = some_rows(5)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    least = 4 if small else 3
    found = mining.without_parts(mining.scored(*mining.frequent_phrases(docs, least)))
    for top in (2000, 9):
        assert sorted(tuple(r) for r in mining.ranked(found, top).collect()) == plain_phrases(rows, least, 5, top)


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = sorted(tuple(r) for r in mining.phrases(docs, least=2).collect())
    assert got == plain_phrases([(r.lang, r.text) for r in docs.collect()], 2, 5, 2000)
    assert mining.phrases(empty(spark)).count() == 0


def test_a_double_array_holds_its_paths_and_no_others():
    rng = np.random.default_rng(1)
    for n, symbols, k in ((1, 1, 1), (300, 4, 5), (2000, 50, 3), (3000, 4000, 2)):
        paths = np.unique(rng.integers(1, symbols + 1, (n, k)).astype(np.int32), axis=0)
        base, check, states = mining.double_array(paths)
        assert len(set(states.tolist())) == len(paths)

        def walk(path):
            s = 0
            for c in path:
                t = base[s] + c
                if not 0 <= t < len(check) or check[t] != s:
                    return None
                s = t
            return s

        assert [walk(p) for p in paths] == states.tolist()
        held = {tuple(p) for p in paths.tolist()}
        for p in rng.integers(1, symbols + 2, (500, k)).tolist():
            assert tuple(p) in held or walk(p) is None


def test_scores_are_exact_past_64_bits(spark):
    a, n, left, right = 10**12, 9 * 10**15 + 7, 10**13 + 1, 10**14 + 3
    rows = [("en", "x", 1, left), ("en", "y", 1, right), ("en", "x y", 2, a)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, k int, a long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    assert [r.score for r in mining.scored(frequent, totals).collect()] == [1000 * a * n // (left * right)]
