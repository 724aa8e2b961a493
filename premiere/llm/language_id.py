"""Language identification by bit-sliced Bloom filters of character trigrams.

A language's trigrams are those seen in two or more of its training documents (in one, if it has no more)
and not much commoner in another language. The languages of a slice share one Bloom filter whose slots hold a bit per
language: the AND of a trigram's slots is the set of all its languages that contain it, in one look-up. A
text's trigrams are counted per language, less the false positives that the filter's fill predicts; the
language with the most wins, and its share of the text's trigrams is the score. What share its own training
text reaches goes along: as each such trigram is in another document too, it is what a clean text not learned
from can expect, and it is low where letters are many.

Every language of the training documents is learned. A slice holds up to SLICE_LANGUAGES languages, the
commonest first, and ends earlier where its filter would pass SLICE_WORDS or its pairs SLICE_PAIRS; a
language beyond that alone is cut by trigram into several slices. One slice judges each batch as it comes. Of
several, one at a time is built, sent and run over all texts, and their counts meet by row; the names and
sizes of the languages are all that the driver holds of every one. A trigram that another language has over
MAX_RATIO times as often leaves a language's set; of the other's share so much counts as its documents
vouch for (two standard errors below), so that a handful of documents takes nothing from a common language.

Defined cases: NULL texts and texts without a letter are `und` with score 0, as is every text when
nothing was learned; a text none of whose trigrams is known gets the commonest language and score 0;
ties go to the language with more training documents, then by name; rows with a NULL id or language are
never learned from; repeated rows are judged row by row; a very long text is judged in chunks by one task; an
empty table gives no rows. Other columns are kept, whatever their names, but for the three that are added.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premiere.llm.common import bounded_batches, carried, per_batch, unpacked
from premiere.session import materialise

SLICE_LANGUAGES = 256
SLICE_WORDS = 1 << 24  # 64-bit words of a filter
SLICE_PAIRS = 1 << 23  # (trigram, language) pairs
MIN_DOCS = 2
MAX_RATIO = 4.0
SLOTS_PER_GRAM = 16
HASHES = 3
UNKNOWN = "und"
CHUNK_CHARS = 1 << 19
_HELD = 1_000_000  # distinct trigrams a task holds before it hands them on


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all trigrams of letters, with word borders, and the number of the text of each."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    doc = np.repeat(np.arange(len(lowered)), [len(t) + 1 for t in lowered])
    letter = _letters()[points]
    kept = letter | np.concatenate([[False], letter[:-1]])
    x = np.concatenate([[0], np.where(letter, points, 0)[kept]]).astype(np.uint64)
    if len(x) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = (x[:-2] << np.uint64(42)) | (x[1:-1] << np.uint64(21)) | x[2:]
    inside = x[1:-1] != 0
    return codes[inside], doc[kept][:-1][inside]


def _chunks(texts: list[str | None]) -> Iterator[slice]:
    """Slices of texts with CHUNK_CHARS characters, or a single longer text."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > CHUNK_CHARS:
            yield slice(start, i)
            start, size = i, 0
        size += len(t or "")
    yield slice(start, len(texts))


# Learning ------------------------------------------------------------------------------


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams per language of a task's rows: how often they occur, and in how many documents."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def emitted() -> Iterator[pa.RecordBatch]:
        for lang, (codes, n) in held.items():
            columns = [pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), *map(pa.array, n)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n", "docs"])
        held.clear()

    for batch in batches:
        texts: dict[str, list[str | None]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            texts.setdefault(lang, []).append(text)
        for lang, part in ((lang, own[part]) for lang, own in texts.items() for part in _chunks(own)):
            codes, doc = trigrams(part)
            codes, inverse, n = np.unique(codes, return_inverse=True, return_counts=True)
            pairs = np.unique(inverse * len(part) + doc)
            n = np.stack([n, np.bincount(pairs // len(part), minlength=len(codes))]).astype(np.int64)
            if lang in held:
                codes, inverse = np.unique(np.concatenate([held[lang][0], codes]), return_inverse=True)
                both = np.concatenate([held[lang][1], n], axis=1)
                n = np.stack([np.bincount(inverse, x, minlength=len(codes)) for x in both]).astype(np.int64)
            held[lang] = (codes, n)
        if sum(len(c) for c, _ in held.values()) > _HELD:
            yield from emitted()
    yield from emitted()


@dataclass
class Filter:
    """The learned languages, commonest first, and the bit-sliced filter."""

    languages: list[str]
    slots: np.ndarray  # slots x words of 64 languages
    false_rate: np.ndarray

    def members(self, codes: np.ndarray) -> np.ndarray:
        """Bit sets of the languages that contain each trigram."""
        found = self.slots[_slot(codes, 0, len(self.slots))]
        for k in range(1, HASHES):
            found &= self.slots[_slot(codes, k, len(self.slots))]
        return found

    def counts(self, texts: list[str | None], part: int = 0, parts: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every text: its best language's number, how many trigrams that knows, and how many there are.

        Only codes whose remainder by `parts` is `part` are looked up.
        """
        if not self.languages:
            return np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts))
        each = [self._counts(texts[x], part, parts) for x in _chunks(texts)]
        return tuple(np.concatenate(x) for x in zip(*each))

    def _counts(self, texts: list[str | None], part: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, doc = trigrams(texts)
        total = np.bincount(doc, minlength=len(texts)).astype(float)
        if parts > 1:
            own = codes % np.uint64(parts) == part
            codes, doc = codes[own], doc[own]
        n = np.bincount(doc, minlength=len(texts)).astype(float)
        found = self.members(codes)
        best, most = np.zeros(len(texts), np.int64), np.full(len(texts), -1.0)
        for i, rate in enumerate(self.false_rate):
            bit = (found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            hits = np.bincount(doc, bit, minlength=len(texts))
            hits = np.maximum(0, (hits - n * rate) / (1 - rate)) if rate < 1 else np.zeros(len(texts))
            best, most = np.where(hits > most, i, best), np.maximum(hits, most)
        return best, most, total


def _slot(codes: np.ndarray, k: int, slots: int) -> np.ndarray:
    mixed = (codes + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) & np.uint64(slots - 1)).astype(np.int64)


def _slots_for(grams: int) -> int:
    """Slots, a power of two, for so many trigrams of the language with the most."""
    return 1 << max(10, int(grams * SLOTS_PER_GRAM - 1).bit_length())


def build_filter(languages: list[str], grams: np.ndarray, owner: np.ndarray) -> Filter:
    """Filter of (trigram, number of its language) pairs. Its slots follow the language with the most."""
    size = _slots_for(np.bincount(owner).max() if len(owner) else 0)
    slots = np.zeros((size, -(-len(languages) // 64) or 1), np.uint64)
    for k in range(HASHES):
        bit = np.uint64(1) << (owner % 64).astype(np.uint64)
        np.bitwise_or.at(slots, (_slot(grams, k, size), owner // 64), bit)
    fill = [((slots[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))]
    return Filter(languages, slots, np.array(fill) ** HASHES)


@dataclass
class Slice:
    """Languages from `first` on, or the trigrams of one whose remainder by `parts` is `part`."""

    first: int
    languages: list[str]
    part: int = 0
    parts: int = 1


@dataclass
class Learned:
    """All languages, commonest first, the share of their training text they know, slices, and written (lang, gram) pairs."""

    languages: list[str]
    known: list[float]
    slices: list[Slice]
    pairs: DataFrame | None

    def filter_of(self, s: Slice) -> Filter:
        """The filter of one slice. Runs a job."""
        if self.pairs is None or not s.languages:
            return build_filter([], np.zeros(0, np.uint64), np.zeros(0, np.int64))
        number = self.pairs.sparkSession.createDataFrame(list(enumerate(s.languages)), "owner int, lang string")
        pairs = self.pairs.filter(F.col("gram") % s.parts == s.part).join(F.broadcast(number), "lang")
        rows = pairs.select("owner", "gram").toPandas()
        return build_filter(s.languages, rows["gram"].to_numpy(np.int64).view(np.uint64), rows["owner"].to_numpy(np.int64))


def slices_of(languages: list[str], grams: list[int], most_languages: int, words: int, pairs: int) -> list[Slice]:
    """Slices of languages in order, each within the bounds; a language beyond them alone is cut into parts."""
    out: list[Slice] = []
    held: list[int] = []

    def fits(x: list[int]) -> bool:
        return len(x) <= most_languages and sum(x) <= pairs and _slots_for(max(x)) * -(-len(x) // 64) <= words

    for i, n in enumerate(grams):
        if held and fits([*held, n]):
            held.append(n)
            out[-1].languages.append(languages[i])
        elif fits([n]):
            held = [n]
            out.append(Slice(i, [languages[i]]))
        else:
            held, bound = [], max(1, min(pairs, words // SLOTS_PER_GRAM) * 7 // 8)
            parts = -(-n // bound)
            out += [Slice(i, [languages[i]], p, parts) for p in range(parts)]
    return out


def learn(
    docs: DataFrame, condition: Column, slice_languages: int = SLICE_LANGUAGES, slice_pairs: int = SLICE_PAIRS
) -> Learned:
    """Learn from text and lang of the documents for which the condition holds. Runs jobs."""
    bounded_batches(docs.sparkSession)
    known = docs.filter(condition & F.col("lang").isNotNull()).select("lang", "text")
    sizes = materialise(known.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")), "language-sizes")
    counted = known.mapInArrow(_counts, "lang string, gram long, n long, docs long")
    summed = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = materialise(summed, "trigrams")
    sums = counts.groupBy("lang").agg(F.sum("n").alias("all")).join(sizes.withColumnRenamed("docs", "of"), "lang")
    shares = counts.join(F.broadcast(sums), "lang").withColumn("share", F.col("n") / F.col("all"))
    vouched = F.col("share") * F.greatest(F.lit(0.0), 1 - 2 / F.sqrt("docs"))
    highest = F.max(vouched).over(Window.partitionBy("gram"))
    own = shares.filter(F.col("docs") >= F.least(F.lit(MIN_DOCS), "of")).withColumn("highest", highest)
    kept = own.filter(F.col("share") * MAX_RATIO >= F.col("highest")).select("lang", "gram", "share")
    kept = materialise(kept, "language-trigrams")
    sums = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("grams"), F.sum("share").alias("known"))
    rows = sizes.join(sums, "lang", "left").orderBy(F.col("docs").desc(), "lang").collect()
    names, known_shares = [r["lang"] for r in rows], [r["known"] or 0.0 for r in rows]
    slices = slices_of(names, [r["grams"] or 0 for r in rows], slice_languages, SLICE_WORDS, slice_pairs)
    return Learned(names, known_shares, slices, kept)


def _judged(docs: DataFrame, learned: Learned) -> DataFrame:
    """All rows with `number` of their language, `hits` and `total`, by the only slice there is."""
    one = learned.slices[0] if learned.slices else Slice(0, [])
    shared = docs.sparkSession.sparkContext.broadcast(learned.filter_of(one))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        best, hits, total = shared.value.counts(batch.column("text").to_pylist())
        columns = [*batch.columns, pa.array(best), pa.array(hits), pa.array(total)]
        return pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_number", "_hits", "_total"])

    schema = docs.select("*").schema  # add() changes a schema in place
    return per_batch(docs, run, schema.add("_number", "long").add("_hits", "double").add("_total", "double"))


def _judged_by_slices(docs: DataFrame, learned: Learned) -> DataFrame:
    """As _judged, slice after slice; a row's counts of all slices meet by its number."""
    context = docs.sparkSession.sparkContext
    numbered = materialise(docs.withColumn("_language_row", F.monotonically_increasing_id()), "documents")

    def judge(s: Slice) -> DataFrame:
        shared = context.broadcast(learned.filter_of(s))
        first, part, parts = s.first, s.part, s.parts

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            best, hits, total = shared.value.counts(batch.column("text").to_pylist(), part, parts)
            columns = [batch.column("_language_row"), pa.array(best + first), pa.array(hits), pa.array(total)]
            return pa.RecordBatch.from_arrays(columns, ["_language_row", "_number", "_hits", "_total"])

        schema = "_language_row long, _number long, _hits double, _total double"
        found = materialise(per_batch(numbered.select("_language_row", "text"), run, schema), "slice-counts")
        shared.destroy()
        return found

    found = functools.reduce(DataFrame.unionByName, map(judge, learned.slices))
    # Parts of one language add up; of several languages the most hits win, then the commonest.
    added = found.groupBy("_language_row", "_number").agg(F.sum("_hits").alias("_hits"), F.max("_total").alias("_total"))
    best = F.max(F.struct("_hits", (-F.col("_number")).alias("back"), "_total")).alias("x")
    won = added.groupBy("_language_row").agg(best)
    won = won.select("_language_row", (-F.col("x.back")).alias("_number"), "x._hits", "x._total")
    # The same plan at every size, as in line dedup.
    return numbered.join(won.hint("shuffle_hash"), "_language_row").drop("_language_row")


def identified(docs: DataFrame, learned: Learned) -> DataFrame:
    """All rows of docs with `lang_pred`, `lang_score`, and in `lang_known` the score that training text of lang_pred has.

    Runs a job; with several slices one per slice.
    """
    rows = carried(docs, "text")
    judged = _judged(rows, learned) if len(learned.slices) < 2 else _judged_by_slices(rows, learned)
    listed = [(i, *x) for i, x in enumerate(zip(learned.languages, learned.known))]
    table = docs.sparkSession.createDataFrame(listed, "_number long, _lang string, _known double")
    judged = judged.join(F.broadcast(table), "_number", "left")
    pred = F.when(F.col("_total") > 0, F.col("_lang")).otherwise(UNKNOWN)
    score = F.when(F.col("_total") > 0, F.least(F.lit(1.0), F.col("_hits") / F.col("_total"))).otherwise(0.0)
    known = F.coalesce("_known", F.lit(0.0)).alias("lang_known")
    found = {"lang_pred": F.coalesce(pred, F.lit(UNKNOWN)).alias("lang_pred"), "lang_score": score.alias("lang_score"), "lang_known": known}
    return judged.select(*[c for name, c in unpacked(docs, "text").items() if name not in found], *found.values())
