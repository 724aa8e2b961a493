"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts of up to ORDER symbols, as counts of (context, symbol). A symbol
is predicted from the longest context the training texts have; a context with total T and D distinct
symbols gives a seen symbol n / (T + D) and keeps D / (T + D) for the escape to the context without
its oldest byte. Symbols of the longer context are excluded there, since they would have been coded
above: what a context's symbols weigh in the shorter one is summed beforehand (column `e`), so every
probability is a row of a table. Below the empty context all symbols never seen are equally likely.
A text is its lower-cased bytes (A-Z only) and one end; its code length is the sum over them.

The tables are Spark tables and may be of any size. Documents are dealt into blocks of BLOCK_BYTES by
hash. Each block names its distinct words and its distinct (context, symbol) grams with their training
counts; totals and probabilities are looked up by joins, and a block gets back what it asked for (words
of one block only are counted there). No task holds more than a block and its look-ups.

Defined cases: NULL texts are empty: one end; rows with a NULL id are never learned from; repeated rows
count and are scored row by row; a text longer than a block is one block's work, in one chunk; without training texts every symbol has probability 1/257; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premiere.llm.common import bounded_batches, texts
from premiere.session import materialise

ORDER = 4
END, START = 256, 257
ALPHABET = 257  # bytes and the end
SYMBOL_BITS = 9
BLOCK_BYTES = 16 << 20
CHUNK_BYTES = 4 << 20
SMOOTHING = 0.1
KEY_SCHEMA = "block int, gram long, word binary, n long"
SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, weight double, score double"


# Symbols of texts ----------------------------------------------------------------------


def gram_codes(raws: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (context, symbol) at every symbol of every text, end included, and each text's number of codes.

    A code holds order + 1 symbols of 9 bits, the oldest on top; contexts before a text's first byte
    are filled with START.
    """
    n = np.array([len(r) for r in raws], np.int64)
    if not len(n):
        return np.zeros(0, np.int64), n
    gap = bytes(order + 1)  # a text's end and the next one's starts
    symbols = np.frombuffer(bytes(order) + gap.join(raws) + b"\0", np.uint8).astype(np.int64)
    ends = np.cumsum(n + 1 + order) - 1
    symbols[ends] = END
    symbols[:order] = START
    for i in range(1, order + 1):
        symbols[ends[:-1] + i] = START
    codes = symbols[: len(symbols) - order].copy()
    for i in range(1, order + 1):
        codes <<= SYMBOL_BITS
        codes |= symbols[i : i + len(codes)]
    return codes[symbols[order:] != START], n + 1


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of an ordered array begins."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def _gram_counts(raws: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of the texts, and their counts: every chunk is sorted, then the chunks' codes are."""
    grams, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for part in _chunks(raws):
        codes, _ = gram_codes(raws[part], order)
        codes.sort()
        starts = _runs(codes)
        grams.append(codes[starts])
        counts.append(np.diff(np.append(starts, len(codes))))
    return _merged(np.concatenate(grams), np.concatenate(counts))


def _merged(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by_gram = np.argsort(grams, kind="stable")
    grams, counts = grams[by_gram], counts[by_gram]
    starts = _runs(grams)
    return grams[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _chunks(raws: list[bytes]) -> Iterator[slice]:
    """Slices of texts with CHUNK_BYTES, or a single longer text."""
    start, size = 0, 0
    for i, r in enumerate(raws):
        if size and size + len(r) > CHUNK_BYTES:
            yield slice(start, i)
            start, size = i, 0
        size += len(r)
    if start < len(raws):
        yield slice(start, len(raws))


# Blocks --------------------------------------------------------------------------------


def _block_texts(docs: pa.Table) -> tuple[list[bytes], list[bool]]:
    raws = [r.lower() for chunk in docs["text"].chunks for r in texts(chunk)]
    return raws, docs["learned"].to_pylist()


def _word_counts(raws: list[bytes], learned: list[bool]) -> tuple[Counter, set]:
    """Training counts of words, and words of the other texts. The end is the empty word."""
    counts, others = Counter(), set()
    for raw, own in zip(raws, learned):
        (counts if own else others).update(raw.split())
    counts[b""] += sum(learned)
    return counts, others


def _keys(order: int):
    def run(docs: pa.Table) -> pa.Table:
        block = docs["block"][0].as_py()
        raws, learned = _block_texts(docs)
        counts, others = _word_counts(raws, learned)
        words = [*counts, *others.difference(counts)]
        n = np.zeros(len(words), np.int64)
        n[: len(counts)] = list(counts.values())
        own, weights = _gram_counts([r for r, known in zip(raws, learned) if known], order)
        new, _ = _gram_counts([r for r, known in zip(raws, learned) if not known], order)
        grams, weights = _merged(np.concatenate([own, new]), np.concatenate([weights, np.zeros(len(new), np.int64)]))
        size = len(grams) + len(words)
        return pa.table(
            {
                "block": pa.array(np.full(size, block), pa.int32()),
                "gram": pa.concat_arrays([pa.array(grams, pa.int64()), pa.nulls(len(words), pa.int64())]),
                "word": pa.concat_arrays([pa.nulls(len(grams), pa.binary()), pa.array(words, pa.binary())]),
                "n": pa.array(np.concatenate([weights, n])),
            }
        )

    return run


def _looked_up(grams: np.ndarray, logs: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The log of every code. Codes are searched in their own order, so that neighbours lie near each other."""
    by_code = np.argsort(codes)
    ordered = codes[by_code]
    at = np.searchsorted(grams, ordered)
    if len(codes) and (at[-1] >= len(grams) or (grams[at] != ordered).any()):
        raise RuntimeError("a block's documents changed between two passes")
    out = np.empty(len(codes))
    out[by_code] = logs[at]
    return out


def _word_numbers(raws: list[bytes]) -> tuple[dict[bytes, int], list[np.ndarray]]:
    """A number per distinct word of the block, and every text as numbers."""
    known: dict[bytes, int] = {b"": 0}
    texts_of: list[np.ndarray] = []
    for raw in raws:
        words = raw.split()
        for w in set(words):
            if w not in known:
                known[w] = len(known)
        texts_of.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
    return known, texts_of


def _score_block(order: int):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        raws, learned = _block_texts(docs)
        of_grams = found.filter(found["gram"].is_valid())
        grams, logs = of_grams["gram"].to_numpy(), of_grams["value"].to_numpy()
        by_gram = np.argsort(grams)
        grams, logs = grams[by_gram], logs[by_gram]
        known, numbers = _word_numbers(raws)
        counts = np.zeros(len(known), np.int64)
        counts[0] = sum(learned)
        training = [x for own, x in zip(learned, numbers) if own]
        if training:
            counts += np.bincount(np.concatenate(training), minlength=len(counts))
        values = np.log10(counts + SMOOTHING)
        of_words = found.filter(found["word"].is_valid())
        for word, value in zip(of_words["word"].to_pylist(), of_words["value"].to_pylist()):
            values[known[word]] = value
        end = values[0]
        score = []
        for part in _chunks(raws):
            codes, size = gram_codes(raws[part], order)
            score += np.add.reduceat(_looked_up(grams, logs, codes), np.cumsum(size) - size).tolist()
        logs_of = [values[x] for x in numbers]
        return pa.table(
            {
                "doc_id": docs["doc_id"],
                "held_out": docs["held_out"],
                "n_tokens": pa.array([len(x) + 1 for x in numbers], pa.int64()),
                "n_known": pa.array([int((x > 0).sum()) + int(end > 0) for x in logs_of], pa.int64()),
                "weight": pa.array([float(x.sum() + end) for x in logs_of], pa.float64()),
                "score": pa.array(score, pa.float64()),
            }
        )

    return run


# The trie ------------------------------------------------------------------------------


def _low(symbols: int) -> int:
    return (1 << (SYMBOL_BITS * symbols)) - 1


def trie(grams: DataFrame, order: int = ORDER) -> tuple[list[DataFrame], list[DataFrame]]:
    """Per order k: (gram, n) of symbols after contexts of k symbols, and their contexts (context, t, d, e).

    `e` is what the context's symbols weigh in the context without its oldest symbol.
    """
    counts = [materialise(grams.filter("n > 0").select("gram", "n"), f"grams-{order}")]
    for k in range(order - 1, -1, -1):
        shorter = counts[0].groupBy(F.col("gram").bitwiseAND(F.lit(_low(k + 1))).alias("gram"))
        counts.insert(0, materialise(shorter.agg(F.sum("n").alias("n")), f"grams-{k}"))
    contexts = []
    for k, own in enumerate(counts):
        context = F.shiftright("gram", SYMBOL_BITS).alias("context")
        if k:
            parent = counts[k - 1].select(F.col("gram").alias("parent"), F.col("n").alias("m"))
            own = own.withColumn("parent", F.col("gram").bitwiseAND(F.lit(_low(k)))).join(_small(parent, k - 1), "parent")
        else:
            own = own.withColumn("m", F.lit(0).cast("long"))
        sums = own.groupBy(context).agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("d"), F.sum("m").alias("e"))
        contexts.append(materialise(sums, f"contexts-{k}"))
    return counts, contexts


def _small(df: DataFrame, order: int) -> DataFrame:
    """Tables of order 0 and 1 have at most 258 * 258 rows, about 2 MB."""
    return F.broadcast(df) if order <= 1 else df


def probabilities(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, value): log10 probability of the last symbol after the others, for all given grams."""
    counts, contexts = trie(grams, order)
    top = contexts[order].select("context", "t", "d")
    seen = counts[order].withColumn("context", F.shiftright("gram", SYMBOL_BITS)).join(top, "context")
    seen = seen.select("gram", F.log10(F.col("n") / (F.col("t") + F.col("d"))).alias("value"))
    zero = F.lit(0.0)
    left = grams.filter("n = 0").select("gram", zero.alias("value"), zero.alias("ex"), zero.alias("ed"), F.lit(False).alias("done"))
    for k in range(order, -1, -1):
        gram = F.col("gram").bitwiseAND(F.lit(_low(k + 1)))
        left = left.withColumn("own", gram).withColumn("context", F.shiftright("own", SYMBOL_BITS))
        left = left.join(_small(contexts[k], k), "context", "left")
        left = left.join(_small(counts[k].withColumnRenamed("gram", "own"), k), "own", "left")
        free = F.col("d") - F.col("ed")
        escape = F.when(F.lit(k == 0) & (F.col("d") == ALPHABET), 0).otherwise(free)
        room = F.col("t") - F.col("ex") + escape
        usable = ~F.col("done") & F.col("t").isNotNull() & (free > 0)
        found = usable & F.col("n").isNotNull()
        step = F.when(found, F.log10(F.col("n") / room)).when(usable, F.log10(escape / room)).otherwise(0.0)
        left = left.select(
            "gram",
            (F.col("value") + step).alias("value"),
            F.when(F.col("t").isNotNull(), F.col("e")).otherwise(0).cast("double").alias("ex"),
            F.when(F.col("t").isNotNull(), F.col("d")).otherwise(0).cast("double").alias("ed"),
            (F.col("done") | found).alias("done"),
        )
    rest = F.when(F.col("done"), 0.0).otherwise(-F.log10(ALPHABET - F.col("ed")))
    return seen.unionByName(left.select("gram", (F.col("value") + rest).alias("value")))


# Operator ------------------------------------------------------------------------------


def score_texts(docs: DataFrame, learned: Column, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row's tokens, base score and model score; the rows for which `learned` holds are the training texts.

    Runs jobs when called; tables of keys and counts go to the shared folder. The input must give the
    same rows per task when read again, as files do.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    # A job's shuffle files go when it ends: its result is a written table.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    own = F.coalesce(learned, F.lit(False))
    # Repeated rows draw different blocks, whatever their number.
    dealt = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", own.alias("learned"), (~own).alias("held_out"), dealt.alias("block")
    )
    keys = materialise(rows.groupBy("block").applyInArrow(_keys(order), KEY_SCHEMA), "block-keys")

    words = keys.filter("word IS NOT NULL")
    totals = words.groupBy("word").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("blocks"))
    totals = materialise(totals, "word-counts")
    n, v = totals.agg(F.sum("total"), F.count(F.when(F.col("total") > 0, 1))).first()
    n, v = n or 0, v or 0
    shared = totals.filter("blocks > 1").select("word", F.log10(F.col("total") + SMOOTHING).alias("value"))
    of_words = words.join(shared, "word").select("block", F.lit(None).cast("long").alias("gram"), "word", "value")

    asked = keys.filter("gram IS NOT NULL")
    grams = materialise(asked.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    logs = materialise(probabilities(grams, order), "gram-probabilities")
    of_grams = asked.join(logs, "gram").select("block", "gram", F.lit(None).cast("binary").alias("word"), "value")

    found = of_words.unionByName(of_grams)
    scored = rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_score_block(order), SCORE_SCHEMA)
    base = F.col("weight") - F.col("n_tokens") * F.log10(F.lit(n + SMOOTHING * (v + 1)))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score"
    )
