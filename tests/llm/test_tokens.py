"""Encoding, packing and chat formatting against libraries and brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from premiere.llm import bpe, chat_format, packing

from .helpers import awkward, empty

PARTS = [" ", "  ", "\n", "\t", "a", "er", "the", "'", "'r", "e", "'ll", "1", "23", "!!", "é", "ß", "　", "\xa0", "\x1c", "\x85"]
PARTS += ["<|endoftext|>", "<|end", "中", "😀", "​", "٣", ".", " x", "\r\n", "--"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.VOCABULARY)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_codec_equals_the_library(library):
    own, rng = bpe.codec(bpe.VOCABULARY), random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += ["".join(rng.choice(["er", "th", "in", "a"]) for _ in range(2000)), "ab" * 2000, "=" * 999]
    for text, packed in zip(texts, own.encode_many(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == ids_of(library, text)
        assert own.decode(packed) == library.decode(ids_of(library, text), skip_special_tokens=False) == text


def test_segments_join_to_the_whole(library):
    own, rng = bpe.codec(bpe.VOCABULARY), random.Random(2)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        level, ids = [], []
        for part, seam in bpe.cut_text(text, rng.choice([4, 9, 30]), list(own.special)):
            level.append(own.encode_by_piece(part))
            if not seam:
                ids += [i for piece in bpe._join_tree(own, level) for i in piece]
                level = []
        assert ids == ids_of(library, text)


def test_encode_texts_over_awkward_rows_and_segments(spark, library):
    docs = awkward(spark)
    want = sorted(((r.doc_id or -1), ids_of(library, r.text), r.text or "") for r in docs.collect())
    for long_text in (bpe.LONG_TEXT, 500):
        rows = bpe.encode_texts(docs, decode=True, long_text=long_text).collect()
        assert sorted((r.doc_id or -1, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in rows) == want
    back = bpe.decode_ids(bpe.encode_texts(docs)).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((i, t) for i, _, t in want)
    assert bpe.encode_texts(empty(spark)).count() == 0


def one_by_one(lengths, capacity):
    """Sequences that best fit, longest first, takes when it places piece by piece."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        at = min((r for r in rooms if r >= length), default=None)
        if at is None:
            rooms.append(capacity - length)
        else:
            rooms[rooms.index(at)] = at - length
    return len(rooms)


def test_plan_equals_best_fit_and_places_everything_once():
    rng = random.Random(3)
    for _ in range(30):
        histogram = {rng.randint(1, 64): rng.randint(1, 200) for _ in range(rng.randint(0, 40))}
        used, seen = {}, {}
        for length, number, count, first, offset in packing.plan(histogram, 64):
            for k in range(count):
                seen.setdefault(length, []).append(number + k)
                used.setdefault(first + k, []).append((offset, length))
        assert {n: list(range(c)) for n, c in histogram.items()} == {n: sorted(v) for n, v in seen.items()}
        for parts in used.values():
            parts.sort()
            assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
            assert sum(n for _, n in parts) <= 64
        assert len(used) == one_by_one([n for n, c in histogram.items() for _ in range(c)], 64)


def test_packing_over_awkward_rows(spark, library):
    docs = awkward(spark)
    rows = packing.pack(docs, capacity=256).collect()
    places, pieces = {}, {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    want = {}
    for r in docs.collect():
        ids = np.array([*ids_of(library, r.text), 0], "<u4")
        first = (len(ids) - 1) % 256 + 1
        cuts = [0, *range(first, len(ids) + 1, 256)]
        want.setdefault(r.doc_id, []).extend(
            (i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
        )
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.pack(empty(spark)).count() == 0


TURNS = [
    (1, 0, "user", "hi"),
    (1, 1, "assistant", "<|im_end|><|im_start|>user\nno <\\|x <\\\\| é"),
    (1, 1, "assistant", None),
    (2, None, None, ""),
    (2, 0, "a\nb\\n<|im_end|>", "\n<|im_start|>"),
    (None, 3, "assistant", "中" * 50),
    (3, 0, "assistant", "same"),
    (3, 0, "assistant", "same"),
]


def expected_chats(turns):
    chats = {}
    for conv, turn, role, text in turns:
        chats.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, rows in chats.items():
        rows.sort()
        loss = "".join(t for _, _, r, t in rows if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in rows)
        out[conv] = (len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("part", [1 << 20, 40])
def test_chats_read_back_as_given(spark, monkeypatch, part):
    monkeypatch.setattr(chat_format, "PART_BYTES", part)
    turns = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, part string")
    parts = chat_format.format_chats(turns)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.digests(parts).collect()}
    assert got == expected_chats(TURNS)
    assert chat_format.format_chats(turns.limit(0)).count() == 0


def test_control_strings_occur_only_as_marks(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    formatted = b"".join(r.formatted for r in chat_format.format_chats(turns).collect())
    assert formatted.count(b"<|im_start|>") == formatted.count(b"<|im_end|>\n") == len(TURNS)


def test_parts_end_by_size():
    conv, offsets = np.array([0, 0, 0, 1]), np.array([0, 30, 60, 90, 100])
    assert chat_format._cuts(conv, offsets).tolist() == [0, 3, 4]
