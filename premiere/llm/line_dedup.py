"""Line dedup: repeated runs of lines by a distributed suffix array over line ids.

Lines with a word form each document's sequence; blank lines are passed over. Prefix doubling ranks the
suffixes: at level j two positions have one rank when their next 2^j lines are equal, and ranks keep
the order of (rank, rank 2^j lines on) of the level before. Positions whose run occurs once leave the
array, so later levels are small.

Suffixes that share their first L lines are an interval of the array, found by the two ranks that cover
L lines. For every position the least L with MIN_WORDS words is looked up, read forwards and
backwards; all starts and ends together cover each maximal repeated run of that many words and nothing
else. The first run of an interval (smallest id, then row, then line) stays, the lines of all later ones
go. A line has a word, so no L exceeds MIN_WORDS and the number of levels is fixed.

Defined cases: a NULL text has no lines and stays NULL; NULL ids come after all others; repeated rows
are separate documents, the later loses what it shares; a run that overlaps its own copy loses the later
lines; a text that loses every line with a word becomes empty; a very long text's lines are rows of their own
until its left lines are put together in one row; an empty table gives no rows. Other columns are kept as they
are, whatever their names, but for a `deleted_lines` of the caller's, which is replaced.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premiere.llm.common import WORD, carried, join_spread, let, unpacked
from premiere.session import materialise

#: Chance repeats are shorter runs; a licence, header or footer line has so many words alone.
MIN_WORDS = 8
_ROW = "_line_dedup_row"


def word_lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: id, row, line (its number among them), pos (in the text), words, h."""
    split = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("pos"), x.alias("text")))
    lines = F.filter(split, lambda x: x["text"].rlike(WORD))
    each = docs.select("doc_id", F.col(_ROW).alias("row"), F.posexplode(lines).alias("line", "x"))
    return each.select(
        "doc_id",
        "row",
        "line",
        F.col("x.pos").alias("pos"),
        F.regexp_count("x.text", F.lit(WORD)).alias("words"),
        F.unhex(F.md5(F.col("x.text").cast("binary"))).alias("h"),
    )


def _ranked(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Rows whose keys occur twice or more, with the rank of their keys; ranks keep the keys' order."""
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy(*keys)
    groups = materialise(groups.withColumn("rank", F.monotonically_increasing_id()), f"{label}-ranks")
    return materialise(join_spread(rows, groups, keys, "n").drop("n", *keys), label)


def suffix_ranks(lines: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """The repeated lines, and (level, row, line, rank) of all repeated runs of 2^level lines."""
    first = _ranked(lines, ["h"], "repeated-lines")
    found, at = [first.select("row", "line", "rank")], first.select("row", "line", "rank")
    for level in range(1, levels):
        ahead = at.select("row", (F.col("line") - (1 << (level - 1))).alias("line"), F.col("rank").alias("rank2"))
        pairs = at.withColumnRenamed("rank", "rank1").join(ahead, ["row", "line"])
        at = _ranked(pairs, ["rank1", "rank2"], "repeated-runs")
        found.append(at)
        if at.isEmpty():
            break
    ranks = [f.select(F.lit(i).alias("level"), "row", "line", "rank") for i, f in enumerate(found)]
    return first, functools.reduce(DataFrame.unionByName, ranks)


def _least_lines(words: Column, at: Column, min_words: int) -> Column:
    """Lines from `at` (from 1) on until min_words words are reached; 0 if they never are."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
    total = F.aggregate(
        F.slice(words, at, min_words),
        start,
        lambda a, w: F.when(a["sum"] >= min_words, a).otherwise(
            F.struct((a["sum"] + w).alias("sum"), (a["n"] + 1).alias("n"))
        ),
    )
    return F.when(total["sum"] >= min_words, total["n"]).otherwise(0)


def windows(repeated: DataFrame, min_words: int) -> DataFrame:
    """(row, line, size): least runs of repeated lines with min_words words, by start and by end."""
    in_row = Window.partitionBy("row").orderBy("line")
    stretch = repeated.select("row", "line", "words", (F.col("line") - F.row_number().over(in_row)).alias("stretch"))
    listed = stretch.groupBy("row", "stretch").agg(F.sort_array(F.collect_list(F.struct("line", "words"))).alias("x"))

    def runs(x: Column) -> Column:
        n, first = F.size(x["words"]), x["first"]
        numbers = F.sequence(F.lit(1), n)

        def forward(i: Column) -> Column:
            size = _least_lines(x["words"], i, min_words)
            return F.struct((first + i - 1).alias("line"), size.alias("size"))

        def backward(i: Column) -> Column:
            size = _least_lines(x["backwards"], i, min_words)
            return F.struct((first + n - i + 1 - size).alias("line"), size.alias("size"))

        both = F.concat(F.transform(numbers, forward), F.transform(numbers, backward))
        return F.array_distinct(F.filter(both, lambda w: w["size"] > 0))

    lists = F.struct(F.col("x")[0]["line"].alias("first"), F.col("x.words").alias("words"), F.reverse("x.words").alias("backwards"))
    return listed.select("row", F.explode(let(lists, runs)).alias("w")).select("row", "w.line", "w.size")


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, positions): lines of each text that a run with an earlier copy covers."""
    lines = materialise(word_lines(docs), "lines")
    repeated, ranks = suffix_ranks(lines, min_words.bit_length())
    runs = windows(repeated, min_words).withColumn("level", F.floor(F.log2("size")).cast("int"))
    back = F.col("line") + F.col("size") - F.expr("shiftleft(1, level)")
    head = ranks.withColumnRenamed("rank", "head")
    tail = ranks.select("level", "row", F.col("line").alias("back"), F.col("rank").alias("tail"))
    placed = runs.withColumn("back", back).join(head, ["level", "row", "line"]).join(tail, ["level", "row", "back"])
    ids = repeated.select("row", "line", "doc_id")
    placed = materialise(placed.join(ids, ["row", "line"]).select("doc_id", "row", "line", "size", "head", "tail"), "runs")
    order = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row", "line")
    intervals = placed.groupBy("size", "head", "tail").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    intervals = materialise(intervals.filter("n > 1"), "intervals")
    copies = join_spread(placed, intervals, ["size", "head", "tail"], "n").filter(
        ~((F.col("row") == F.col("first.row")) & (F.col("line") == F.col("first.line")))
    )
    covered = copies.select(
        "row", F.explode(F.sequence(F.col("line"), F.col("line") + F.col("size") - 1)).alias("line")
    ).distinct()
    gone = covered.join(repeated.select("row", "line", "pos"), ["row", "line"])
    return gone.groupBy("row").agg(F.collect_set("pos").alias("positions"))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows with the lines of later copies taken out of `text`, and how many in `deleted_lines`.

    Runs jobs when called; the input is written once, so that its rows have fixed numbers.
    """
    rows = carried(docs, "doc_id", "text")
    numbered = materialise(rows.withColumn(_ROW, F.monotonically_increasing_id()), "documents")
    gone = materialise(later_copies(numbered.select("doc_id", _ROW, "text"), min_words), "later-copies")
    # The same plan at every size: texts are dealt once and meet the few positions in a hash table, unsorted.
    joined = numbered.join(gone.withColumnRenamed("row", _ROW).hint("shuffle_hash"), _ROW, "left")
    split = F.split("text", "\n", -1)
    borders = F.sort_array(F.concat(F.array(F.lit(-1)), F.col("positions"), F.array(F.size(split))))

    def rest(x: Column) -> Column:
        def between(j: Column) -> Column:
            return F.slice(x["lines"], x["at"][j - 1] + 2, x["at"][j] - x["at"][j - 1] - 1)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(1), F.size(x["at"]) - 1), between)), "\n")

    left = let(F.struct(split.alias("lines"), borders.alias("at")), rest)
    text = F.when(F.col("positions").isNull(), F.col("text")).when(left.rlike(WORD), left).otherwise("")
    counted = joined.withColumn("deleted_lines", F.coalesce(F.size("positions"), F.lit(0)))
    counted = counted.withColumn("deleted_lines", F.greatest("deleted_lines", F.lit(0)))
    columns = unpacked(docs, "doc_id", "text") | {"deleted_lines": F.col("deleted_lines")}
    return counted.withColumn("text", text).select(*columns.values())
