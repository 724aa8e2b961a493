"""Fill-in-middle examples against a plain tokenizer."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from premiere.llm import fill_middle as fim

from .helpers import awkward, empty, prose

PARTS = ["a", "Zz", "word ", " ", "\n", "é", "中", "😀", "1", "<P", ">", "<", "S>", "ﬁ", "K", "x" * 90, "\x00", "the same old line again. "]


def plain_example(doc_id, text):
    """The contract, token by token."""
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def some_texts(seed, n):
    rng = random.Random(seed)
    shared = prose(seed, 900)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 400))) for _ in range(n)]
    return texts + [t[:50] + shared + t[50:] for t in texts] + ["a" * 30_000, "é" * 9_000, " " * 5_000, shared * 3]


@pytest.mark.parametrize("most_bytes", [1 << 20, 500])
def test_examples_equal_the_plain_ones(spark, most_bytes, monkeypatch):
    monkeypatch.setattr(fim.Summaries.__init__, "__defaults__", (most_bytes,))
    texts = some_texts(most_bytes, 60)
    cache = fim.Summaries()
    for part in (texts[:40], texts[40:], texts):  # the third finds its chunks known
        whole = [t.encode() for t in part]
        ends = np.cumsum([len(t) for t in whole])
        joined = b"".join(whole)
        borders = fim.chunk_borders(np.frombuffer(joined, np.uint8), ends - [len(t) for t in whole], ends)
        for i, (t, own) in enumerate(zip(whole, borders)):
            assert not t or (own[-1] - own[0] == len(t) and max(np.diff(own)) <= fim.MOST_CHUNK)
            chunks = [joined[a:b] for a, b in zip(own, own[1:])]
            n, form, prefix, middle, output = fim._example(i, t, own, chunks, cache.of(chunks))
            assert (n, form, prefix, middle, output.decode()) == plain_example(i, part[i])


def test_shared_passages_fall_into_equal_chunks():
    passage = prose(7, 3000).encode()
    whole = [b"one " + passage, b"quite another front, " * 9 + passage]
    joined, ends = b"".join(whole), np.cumsum([len(t) for t in whole])
    borders = fim.chunk_borders(np.frombuffer(joined, np.uint8), ends - [len(t) for t in whole], ends)
    one, two = ({joined[a:b] for a, b in zip(own, own[1:])} for own in borders)
    assert len(one & two) > 0.8 * len(one)


def test_awkward_rows(spark):
    docs = awkward(spark).unionByName(
        spark.createDataFrame([(20, "a <M> b"), (21, "<P>"), (22, "< P> <S"), (23, "<S" * 40), (24, ">M>" * 40)], "doc_id long, text string"),
        allowMissingColumns=True,
    )
    made = fim.fill_middle(docs).withColumn("back", fim.restored(F.col("form"), F.col("output")))
    rows = made.collect()
    key = lambda r: tuple(map(str, r))
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in rows), key=key)
    want = sorted(((r.doc_id, *plain_example(r.doc_id, r.text), r.text or "") for r in docs.collect()), key=key)
    assert got == want
    assert fim.fill_middle(empty(spark)).count() == 0
    assert {"plain", "psm", "spm"} == {plain_example(i, "some text")[1] for i in range(50)}
