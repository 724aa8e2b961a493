"""Phrase collocations by Apriori levels, counted with broadcast double-array tries.

Every language (NULL: `und`) is mined on its own. Texts are read once and written as blocks: the distinct
words of some texts of one language and the texts as codes of these words, 0 where a piece ends. Words are
counted from the blocks. Then, for phrases of 2, 3, 4, 5 words:

1. A position is alive if the shorter phrases at it and at the next word are both frequent. Living positions
   are counted by hash in one counter per eight words of the corpus, which stop at the minimum. Counters
   travel as the few that a task met, packed by ranges of 2^16, and are summed range by range.
2. Living positions whose counter reaches the minimum give the candidates, as distinct phrases. Frequent
   phrases and full counters are looked up in Bloom filters of 2^25 bits, whatever their number. Filters and
   counters can only err towards more, so no frequent phrase is lost.
3. Candidates are dealt by hash into shards of about 2^16. Each becomes a double-array trie over its words:
   state s goes on with symbol c to t = base[s] + c if check[t] = s.
4. The tries of up to four shards are broadcast at a time (their number of phrases bounds them); over every
   block numpy moves the states of all positions one word on at a time and counts the states at the end.
   More shards take more rounds over the blocks. A task's counts travel as vectors over ranges of 2^12
   states and are summed range by range as they come, so no task holds more than the totals.

Scores, cuts and the dropping of parts are joins over the frequent phrases.

Defined cases: a NULL text is empty; empty texts add nothing; a very long text is one block of its own, so one
task holds its codes (4 bytes a word); repeated rows count again; ties are broken as ranked() says; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premiere.llm.common import bounded_batches, join_spread
from premiere.session import materialise

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
UNKNOWN_LANG = "und"

BLOCK_WORDS = 1 << 18
OPEN_WORDS = 1 << 19  # of all languages, in blocks not yet written
WORDS_A_COUNTER = 8
CHUNK_BITS = 16  # of the counters that are summed together
STATE_BITS = 12  # of the states that are summed together
OPEN_POSITIONS = 1 << 20  # counted together by a task
FILTER_BITS = 25
TRIE_PHRASES = 1 << 16
TRIES_AT_ONCE = 4
KNOWN_PHRASES = 1 << 17  # held by a task to send a candidate once

_BREAK = b"."
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + b"\t" + _BREAKS, bytes(range(97, 123)) + b" " + _BREAK * len(_BREAKS)
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# Odd multipliers, one per bit that the filter sets.
_FILTER_FACTORS = [np.uint64((2 * 0x632BE59BD9B4E019 * (i + 3) + 1) % 2**64) for i in range(4)]

# Of the parts that blocks were written in, this share tells its candidates first.
_FIRST_OF = 8

BLOCK_SCHEMA = "lang string, words array<string>, counts array<int>, hashes binary, width int, codes binary"
TRIE_SCHEMA = (
    "shard long, langs array<string>, words array<string>, base binary, `check` binary, "
    "phrase_langs array<string>, phrases array<string>, states array<int>"
)


# Blocks --------------------------------------------------------------------------------


def _lang_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = _lang_seed(lang)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


class _Block:
    """Texts of one language as codes; code 0 ends a piece."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {_BREAK: 0}
        self.codes: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        words = text.translate(_PLAIN).replace(_BREAK, b" . ").split()
        words.append(_BREAK)
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = len(known)
        self.codes.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self, lang: str) -> dict:
        words = list(self.known)[1:]
        codes = np.concatenate(self.codes)
        width = 2 if len(self.known) <= 1 << 16 else 4
        return {
            "lang": lang,
            "words": [w.decode() for w in words],
            "counts": np.bincount(codes, minlength=len(self.known))[1:],
            "hashes": _hashes(lang, words).tobytes(),
            "width": width,
            "codes": codes.astype(f"<u{width}").tobytes(),
        }


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary(), pa.int32(), pa.binary()]
    open_blocks: dict[str, _Block] = {}

    def closed(lang: str) -> Iterator[pa.RecordBatch]:
        row = open_blocks.pop(lang).row(lang)
        if row["words"]:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], list(row))

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lang, text in zip(langs, batch.column("text").cast(pa.binary())):
            if text.is_valid:
                block = open_blocks.setdefault(lang, _Block())
                block.add(text.as_py())
                if block.size >= BLOCK_WORDS:
                    yield from closed(lang)
        if sum(b.size for b in open_blocks.values()) >= OPEN_WORDS:
            for lang in list(open_blocks):
                yield from closed(lang)
    for lang in list(open_blocks):
        yield from closed(lang)


def word_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of at most BLOCK_WORDS words (or one text), of one language each."""
    bounded_batches(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang")
    made = docs.select(lang, "text").mapInArrow(_blocks_of, BLOCK_SCHEMA)
    return made.withColumn("part", F.spark_partition_id())


# Apriori-safe candidates ---------------------------------------------------------------


def _longer(h: np.ndarray, next_word: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(29))) * _FACTOR + next_word


def _phrase_hashes(lang: str, phrases: list[str]) -> np.ndarray:
    """Hashes of phrases of equal length, as _alive makes them."""
    words = [p.encode().split(b" ") for p in phrases]
    h = _hashes(lang, [w[0] for w in words])
    for j in range(1, len(words[0])):
        h = _longer(h, _hashes(lang, [w[j] for w in words]))
    return h


def _bits_of(h: np.ndarray, factor: np.uint64) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) * factor >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _in_filter(packed: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Marks the hashes whose bits are all set."""
    left = np.arange(len(h))
    for factor in _FILTER_FACTORS:
        place = _bits_of(h[left], factor)
        left = left[(packed[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
    found = np.zeros(len(h), bool)
    found[left] = True
    return found


def _places(h: np.ndarray) -> pa.RecordBatch:
    """The bits that hashes set."""
    return pa.RecordBatch.from_pydict({"place": np.concatenate([_bits_of(h, f) for f in _FILTER_FACTORS])})


def _filter_of(places: DataFrame) -> np.ndarray:
    """The packed filter of the bits in `place`: 2^FILTER_BITS bits, collected as rows of 32,768."""
    place = F.col("place") + 1
    rows = (
        places.groupBy(F.bitmap_bucket_number(place).alias("number"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    packed = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in rows:
        at = (r["number"] - 1) * 4096
        packed[at : at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return packed


def frequent_filter(frequent: DataFrame) -> np.ndarray:
    """The filter of frequent phrases, all of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                by_lang.setdefault(lang, []).append(phrase)
            for lang, phrases in by_lang.items():
                yield _places(_phrase_hashes(lang, phrases))

    return _filter_of(frequent.select("lang", "phrase").mapInArrow(run, "place long"))


def _alive(codes: np.ndarray, hashes: np.ndarray, k: int, frequent: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose k words end in no piece and whose shorter phrases may be frequent; counter of each."""
    at = np.flatnonzero(codes)  # starts of phrases of j words
    padded = np.concatenate([np.zeros(1, np.uint64), hashes])
    h = padded[codes[at]]
    for j in range(1, k - 1):
        go_on = codes[at + j] > 0  # the last code of a block is 0
        at, h = at[go_on], h[go_on]
        h = _longer(h, padded[codes[at + j]])
    good = _in_filter(frequent, h)
    both = np.zeros(len(codes) + 1, bool)
    both[at[good]] = True
    living = good & both[at + 1]
    at, h = at[living], h[living]
    h = _longer(h, padded[codes[at + k - 1]])
    return at, (h ^ (h >> np.uint64(32))) * _FACTOR >> np.uint64(64 - bits)


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row number, codes and word hashes of every block."""
    for i in range(batch.num_rows):
        yield i, _codes(batch, i), np.frombuffer(batch.column("hashes")[i].as_buffer(), np.uint64)


def _codes(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return np.frombuffer(batch.column("codes")[i].as_buffer(), f"<u{batch.column('width')[i].as_py()}").astype(np.int32)


def counter_bits(n_words: int) -> int:
    return max(CHUNK_BITS, (max(1, n_words) // WORDS_A_COUNTER).bit_length())


def _ranges(met: np.ndarray, n: np.ndarray, bits: int) -> dict[str, pa.Array]:
    """Numbers met, in order, and their counts as one row per range of 2^bits numbers."""
    met = met.astype(np.int64)
    chunk, low = met >> bits, (met & ((1 << bits) - 1)).astype(np.uint16)
    starts = np.flatnonzero(np.diff(chunk, prepend=-1))
    ends = np.append(starts[1:], len(met))
    return {
        "chunk": pa.array(chunk[starts]),
        "low": pa.array([low[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
        "n": pa.array([n[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
    }


def _counter_rows(counters: list[np.ndarray], least: int, kind: np.dtype) -> pa.RecordBatch:
    """Counters met and their counts, which stop at `least`."""
    met, n = np.unique(np.concatenate(counters), return_counts=True)
    return pa.RecordBatch.from_pydict(_ranges(met, np.minimum(n, least).astype(kind), CHUNK_BITS))


def full_counters(blocks: DataFrame, k: int, frequent: np.ndarray, least: int, bits: int) -> np.ndarray:
    """The filter of the counters that reach `least` at living positions of k words.

    Counters stop at `least`: a sum of stopped counters reaches it if and only if the whole sum does. A range's
    rows are about 2^16 times WORDS_A_COUNTER counts of 3 bytes, however large the corpus is.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(frequent)
    kind = np.min_scalar_type(least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held += [_alive(codes, hashes, k, shared.value, bits)[1] for _, codes, hashes in _arrays(batch)]
            if sum(map(len, held)) >= OPEN_POSITIONS:
                yield _counter_rows(held, least, kind)
                held = []
        if held:
            yield _counter_rows(held, least, kind)

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.zeros(1 << CHUNK_BITS, np.int64)
        for low, n in zip(rows["low"], rows["n"]):
            total[np.frombuffer(low.as_buffer(), np.uint16)] += np.frombuffer(n.as_buffer(), kind)
        full = np.flatnonzero(total >= least) + (key[0].as_py() << CHUNK_BITS)
        return pa.Table.from_batches([_places(full.astype(np.uint64))])

    parts = blocks.select("hashes", "width", "codes").mapInArrow(count, "chunk long, low binary, n binary")
    full = _filter_of(parts.groupBy("chunk").applyInArrow(add, "place long"))
    shared.destroy()
    return full


def _told(blocks: DataFrame, k: int, filters: tuple[np.ndarray, np.ndarray], bits: int, known: dict[str, set[str]]) -> DataFrame:
    """Phrases of k words at living positions whose counter is full, each once per task, but for the known."""
    shared = blocks.sparkSession.sparkContext.broadcast((*filters, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[str, set[str]] = {}
        for batch in batches:
            frequent, full, known = shared.value
            for i, codes, hashes in _arrays(batch):
                at, counter = _alive(codes, hashes, k, frequent, bits)
                at = at[_in_filter(full, counter)]
                n_words, number = len(hashes) + 1, codes[at].astype(np.int64)
                first = np.arange(len(at))
                for j in range(1, k):  # equal numbers for equal words so far
                    _, first, number = np.unique(number * n_words + codes[at + j], return_index=True, return_inverse=True)
                if not len(at):
                    continue
                rows = codes[at[first][:, None] + np.arange(k)] - 1
                used, inside = np.unique(rows, return_inverse=True)
                lang, words = batch.column("lang")[i].as_py(), batch.column("words")[i].values.take(pa.array(used)).to_pylist()
                phrases = [" ".join([words[w] for w in row]) for row in inside.reshape(rows.shape).tolist()]
                if sum(map(len, sent.values())) > KNOWN_PHRASES:
                    sent.clear()
                own, others = sent.setdefault(lang, set()), known.get(lang, ())
                fresh = [p for p in phrases if p not in own and p not in others]
                own.update(fresh)
                columns = [pa.array([lang] * len(fresh), pa.string()), pa.array(fresh, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase"])

    found = blocks.select("lang", "words", "hashes", "width", "codes").mapInArrow(run, "lang string, phrase string")
    found = materialise(found.distinct(), "candidates")
    shared.destroy()
    return found


def candidates(blocks: DataFrame, k: int, frequent: np.ndarray, full: np.ndarray, bits: int) -> DataFrame:
    """Distinct phrases of k words at living positions whose counter reaches the minimum; written.

    An eighth of the parts tells its phrases first. Up to KNOWN_PHRASES of them go to all others, which tell
    only what is not among them: a frequent phrase, which most parts have, is not sent by each.
    """
    filters, early = (frequent, full), F.col("part") % _FIRST_OF == 0
    first = _told(blocks.filter(early), k, filters, bits, {})
    known: dict[str, set[str]] = {}
    for r in first.limit(KNOWN_PHRASES).collect():
        known.setdefault(r["lang"], set()).add(r["phrase"])
    rest = _told(blocks.filter(~early), k, filters, bits, known)
    return materialise(first.unionByName(rest).distinct(), "candidates")


# Double-array tries --------------------------------------------------------------------

_SEARCH = 1 << 12  # cells looked through at once for a node's place


class _Cells:
    """Free cells of a double array that grows."""

    def __init__(self, size: int):
        self.free = np.ones(size, bool)
        self.free[0] = False  # the root
        self.low = 1  # where the search starts

    def _reach(self, size: int) -> None:
        if size > len(self.free):
            self.free = np.concatenate([self.free, np.ones(max(size - len(self.free), len(self.free) // 2), bool)])

    def place(self, symbols: np.ndarray) -> int:
        """A base that puts every symbol on a free cell; the cells are taken.

        Cells for the first symbol are struck out by one further symbol after the other, so that little is
        left to compare after a few. Behind the last taken cell any node fits. A half full start is left to
        nodes with a single symbol, which come last and fill every hole.
        """
        steps, low = (symbols - symbols[0])[1:], self.low
        while True:
            self._reach(low + _SEARCH + int(steps[-1]) + 1)
            cells = low + np.flatnonzero(self.free[low : low + _SEARCH])
            if low == self.low and len(cells) < _SEARCH // 2:
                self.low += _SEARCH
            for step in steps:
                cells = cells[self.free[cells + step]]
                if not len(cells):
                    break
            else:
                if len(cells):
                    return self._take(int(cells[0] - symbols[0]), symbols)
            low += _SEARCH

    def _take(self, base: int, symbols: np.ndarray) -> int:
        self.free[base + symbols] = False
        return base

    def singles(self, n: int) -> np.ndarray:
        """n free cells, which are taken."""
        self._reach(len(self.free) + n)
        cells = np.flatnonzero(self.free)[:n]
        self.free[cells] = False
        return cells


def double_array(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and the last state of every path; paths are distinct rows of symbols from 1, in order."""
    cells = _Cells(int(paths.max()) + 2 * len(paths) + 2)
    base_of, check_of = [], []  # (state, base) and (cell, state) arrays
    state = np.zeros(len(paths), np.int64)  # of the path so far
    fresh_parent = np.zeros(len(paths), bool)
    fresh_parent[0] = True
    for j in range(paths.shape[1]):
        fresh = fresh_parent.copy()
        fresh[1:] |= paths[1:, j] != paths[:-1, j]
        child = np.flatnonzero(fresh)  # first path of every child
        symbols, parents = paths[child, j].astype(np.int64), state[child]
        node = np.flatnonzero(fresh_parent[child])  # first child of every parent
        sizes = np.diff(np.append(node, len(child)))
        placed = np.empty(len(child), np.int64)
        for i in np.argsort(-sizes, kind="stable"):
            if sizes[i] == 1:
                break
            own = slice(node[i], node[i] + sizes[i])
            placed[own] = cells.place(symbols[own]) + symbols[own]
        alone = node[sizes == 1]
        placed[alone] = cells.singles(len(alone))
        base_of.append((parents[node], placed[node] - symbols[node]))
        check_of.append((placed, parents))
        state = placed[np.cumsum(fresh) - 1]
        fresh_parent = fresh
    size = max(int(c.max()) for c, _ in check_of) + 1
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    for nodes, bases in base_of:
        base[nodes] = bases
    for at, parents in check_of:
        check[at] = parents
    return base, check, state


def _trie(rows: pa.Table) -> pa.Table:
    """One shard's candidates as a trie over words; a word's symbol also tells its language."""
    langs, phrases = rows["lang"].to_pylist(), rows["phrase"].to_pylist()
    split = [[(lang, w) for w in phrase.split(" ")] for lang, phrase in zip(langs, phrases)]
    vocabulary = sorted({w for words in split for w in words})
    symbol = {w: i + 1 for i, w in enumerate(vocabulary)}
    paths = np.array([[symbol[w] for w in words] for words in split], np.int32)
    order = np.lexsort(paths.T[::-1])
    base, check, states = double_array(paths[order])
    out = {
        "shard": [rows["shard"][0].as_py()],
        "langs": [[lang for lang, _ in vocabulary]],
        "words": [[w for _, w in vocabulary]],
        "base": [base.tobytes()],
        "check": [check.tobytes()],
        "phrase_langs": [[langs[i] for i in order]],
        "phrases": [[phrases[i] for i in order]],
        "states": [states],
    }
    strings = pa.list_(pa.string())
    kinds = [pa.int64(), strings, strings, pa.binary(), pa.binary(), strings, strings, pa.list_(pa.int32())]
    return pa.table({name: pa.array(v, t) for (name, v), t in zip(out.items(), kinds)})


def build_tries(found: DataFrame, n_phrases: int) -> DataFrame:
    """One row per shard of candidates, about TRIE_PHRASES each; written."""
    shards = -(-n_phrases // TRIE_PHRASES)
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("phrase", "lang"), F.lit(shards)))
    return materialise(dealt.groupBy("shard").applyInArrow(_trie, TRIE_SCHEMA), "tries")


class Trie:
    """A trie as tasks use it."""

    def __init__(self, shard: int, langs: list[str], words: list[str], base: bytes, check: bytes):
        self.shard = shard
        self.base, self.check = np.frombuffer(base, np.int32), np.frombuffer(check, np.int32)
        self.symbols: dict[str, dict[str, int]] = {}
        for i, (lang, word) in enumerate(zip(langs, words)):
            self.symbols.setdefault(lang, {})[word] = i + 1

    def states(self, lang: str, words: list[str], codes: np.ndarray, k: int) -> np.ndarray:
        """The states all positions reach with k words; the block's last code is 0."""
        own = self.symbols.get(lang)
        if not own:
            return np.zeros(0, np.int64)
        symbols = np.fromiter((own.get(w, 0) for w in words), np.int32, len(words))
        symbols = np.concatenate([np.zeros(1, np.int32), symbols])[codes]
        at = np.flatnonzero(symbols)
        state = np.zeros(len(at), np.int32)
        for j in range(k):
            symbol = symbols[at + j]
            to = self.base[state] + symbol
            goes = (symbol > 0) & (to >= 0) & (to < len(self.check))
            goes[goes] = self.check[to[goes]] == state[goes]
            at, state = at[goes], to[goes]
        return state


def _summed(vectors: DataFrame, bits: int) -> DataFrame:
    """Sums of the tasks' vectors, all of a range's in one task; totals of whole ranges are all it holds."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for shard, chunk, low, n in zip(*(batch.column(c) for c in ("shard", "chunk", "low", "n"))):
                total = totals.setdefault((shard.as_py(), chunk.as_py()), np.zeros(1 << bits, np.int64))
                total[np.frombuffer(low.as_buffer(), np.uint16)] += np.frombuffer(n.as_buffer(), np.int64)
        for (shard, chunk), total in totals.items():
            seen = np.flatnonzero(total)
            columns = [np.full(len(seen), shard), seen + (chunk << bits), total[seen]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["shard", "state", "n"])

    return vectors.repartition("shard", "chunk").mapInArrow(add, "shard long, state long, n long")


def trie_counts(blocks: DataFrame, tries: DataFrame, k: int) -> DataFrame:
    """(shard, state, n): how often every state at the end of a phrase is reached in the blocks; written."""
    spark, bits = blocks.sparkSession, STATE_BITS
    shards = sorted(r.shard for r in tries.select("shard").collect())
    counted = None
    for i in range(0, len(shards), TRIES_AT_ONCE):
        chosen = tries.filter(F.col("shard").isin(shards[i : i + TRIES_AT_ONCE]))
        rows = [tuple(r) for r in chosen.select("shard", "langs", "words", "base", "check").collect()]
        shared = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            loaded, totals = None, []
            for batch in batches:
                if loaded is None:
                    loaded = [Trie(*row) for row in shared.value]
                    totals = [np.zeros(len(t.check), np.int64) for t in loaded]
                for b in range(batch.num_rows):
                    lang, words = batch.column("lang")[b].as_py(), batch.column("words")[b].as_py()
                    codes = _codes(batch, b)
                    for trie, total in zip(loaded, totals):
                        total += np.bincount(trie.states(lang, words, codes, k), minlength=len(total))
            for trie, total in zip(loaded or (), totals):
                seen = np.flatnonzero(total)
                rows = _ranges(seen, total[seen], bits)
                shard = pa.array(np.full(len(rows["chunk"]), trie.shard, np.int64))
                yield pa.RecordBatch.from_pydict({"shard": shard, **rows})

        vectors = blocks.select("lang", "words", "width", "codes").mapInArrow(run, "shard long, chunk long, low binary, n binary")
        part = materialise(_summed(vectors, bits), "state-counts")
        shared.destroy()
        counted = part if counted is None else counted.unionByName(part)
    return counted


# The phrases ---------------------------------------------------------------------------


def frequent_phrases(docs: DataFrame, least: int = MIN_COUNT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, a) of all phrases of 1 to `longest` words found `least` times, and (lang, n) of words.

    Runs jobs when called; blocks, candidates, tries and counts are written to the shared folder.
    """
    bounded_batches(docs.sparkSession)
    blocks = materialise(word_blocks(docs), "word-blocks")
    words = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    counts = materialise(words.groupBy("lang", F.col("w.words").alias("phrase")).agg(F.sum("w.counts").alias("a")), "words")
    totals = materialise(counts.groupBy("lang").agg(F.sum("a").alias("n")), "word-totals")
    level = materialise(counts.filter(F.col("a") >= least).select("lang", "phrase", F.lit(1).alias("k"), "a"), "frequent")
    frequent, bits = level, counter_bits(totals.agg(F.sum("n")).first()[0] or 0)
    for k in range(2, longest + 1):
        shorter = frequent_filter(level)
        found = candidates(blocks, k, shorter, full_counters(blocks, k, shorter, least, bits), bits)
        n_found = found.count()
        if not n_found:
            break
        tries = build_tries(found, n_found)
        named = tries.select("shard", F.explode(F.arrays_zip("phrase_langs", "phrases", "states")).alias("p"))
        named = named.select("shard", F.col("p.states").cast("long").alias("state"), F.col("p.phrase_langs").alias("lang"), F.col("p.phrases").alias("phrase"))
        often = trie_counts(blocks, tries, k).filter(F.col("n") >= least)
        level = named.join(often, ["shard", "state"]).select("lang", "phrase", F.lit(k).alias("k"), F.col("n").alias("a"))
        level = materialise(level, "frequent")
        frequent = frequent.unionByName(level)
    return frequent, totals


def _looked_up(rows: DataFrame, frequent: DataFrame, part: str, out: str) -> DataFrame:
    """Rows with the count of the phrase in `part`; parts that many phrases share are spread."""
    uses = rows.groupBy("lang", part).agg(F.count(F.lit(1)).alias("uses"))
    known = uses.join(frequent.select("lang", F.col("phrase").alias(part), F.col("a").alias(out)), ["lang", part])
    return join_spread(rows, materialise(known, "parts"), ["lang", part], "uses").drop("uses")


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates (phrases of two words or more) with the cut of the lowest score; written.

    The score floor(1000 a n / (l r)) is computed in whole numbers of 38 digits; of equal scores the cut after
    the fewest words counts.
    """
    whole = "decimal(38,0)"
    words = F.split("phrase", " ")
    long_ones = frequent.filter("k > 1").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = long_ones.select(
        "lang",
        "phrase",
        "k",
        "a",
        "cut",
        F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rest"),
    )
    cuts = _looked_up(materialise(cuts, "cuts"), frequent, "head", "l")
    cuts = _looked_up(materialise(cuts, "cuts"), frequent, "rest", "r").join(totals, "lang")
    score = F.expr(f"cast(1000 as {whole}) * cast(a as {whole}) * cast(n as {whole}) div (cast(l as {whole}) * cast(r as {whole}))")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("c")
    best = cuts.groupBy("lang", "phrase", "k", "a", "n").agg(lowest)
    return materialise(best.select("lang", "phrase", "k", "a", "n", "c.l", "c.r", "c.score"), "scored")


def without_parts(rows: DataFrame) -> DataFrame:
    """Candidates but those inside a longer one found as often.

    A phrase inside a longer one is also inside the one of a word more between the two, whose count lies
    between theirs, so phrases of one word more tell all.
    """
    words, k = F.split("phrase", " "), F.col("k")
    inner = F.array(F.slice(words, F.lit(1), k - 1), F.slice(words, F.lit(2), k - 1))
    parts = rows.filter("k > 2").select("lang", "a", F.explode(inner).alias("part"))
    most = parts.groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("a").alias("most"))
    return rows.join(most, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (F.col("most") < F.col("a"))).drop("most")


def ranked(rows: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first `top` by score and count, both descending, then phrase in order of its bytes.

    A language's phrases are first cut to `top` in each of 64 parts, so one task sorts 64 times `top` at most.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parted = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    few = parted.withColumn("place", first).filter(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    best = few.withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrases(docs: DataFrame, least: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The strongest collocations of every language. Runs jobs when called."""
    return ranked(without_parts(scored(*frequent_phrases(docs, least, longest))), top)
