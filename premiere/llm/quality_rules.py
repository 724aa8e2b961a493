"""Quality rules: base counts and distribution divergence from the document's language.

A document's character classes and its language's commonest words are counted into two histograms and
compared with references by Jensen-Shannon distance (base 2, 0 to 1). References are the summed
histograms of all documents of a language that pass the base rules. A text with too few words or
characters gives a noisy histogram and is not judged by it.

Every language has its own reference. Those with a thousandth of all documents, at most 1,000, meet their
rows by broadcast, the others in a shuffle join, where none of them is hot. A language whose sound documents
have too few characters or words has no reference for that histogram, and a document without a language
(NULL or '') has none at all: the distance is NULL then and not judged.

Defined cases: a NULL text has no words, symbols or lines and fails the base rules; repeated rows and
NULL ids are judged row by row; a very long text is one row's work in array functions; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premiere.llm.common import SPACE, WORD, let
from premiere.session import materialise

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"

CLASSES = {"lower": r"\p{Ll}+", "upper": r"\p{Lu}+", "digit": r"\p{N}+", "stop": r"[.,;:?'\"()\-]+"}
COMMON_WORDS = 24
LANGUAGE_SHARE = 1000
MIN_JUDGED_WORDS = 60
MIN_JUDGED_CHARS = 200
MIN_REFERENCE_WORDS = 10 * MIN_JUDGED_WORDS
MIN_REFERENCE_CHARS = 10 * MIN_JUDGED_CHARS
MAX_WORD_DISTANCE = 0.4
MAX_CLASS_DISTANCE = 0.25


# Base counts ---------------------------------------------------------------------------


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more in the text.

    Windows are compared by 64-bit hash within one text. Only a text with equal hashes has its
    windows sorted: every position whose hash is not alone covers `window` words, less what it shares
    with the position before.
    """

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, i: F.when(i == 0, window).otherwise(F.least(F.lit(window), p - at[i - 1])))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def positions(s: Column) -> Column:
        def alone(i: Column) -> Column:
            above = (i > 0) & (s[F.greatest(i - 1, F.lit(0))]["h"] == s[i]["h"])
            below = (i < F.size(s) - 1) & (s[F.least(i + 1, F.size(s) - 1)]["h"] == s[i]["h"])
            return ~(above | below)

        return F.sort_array(F.transform(F.filter(s, lambda x, i: ~alone(i)), lambda x: x["p"]))

    def counted(h: Column) -> Column:
        sorted_ = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(let(sorted_, positions), covered)
        )

    def hashed(w: Column) -> Column:
        # By doubling: a run of words is known by the hashes of its two halves, or of two runs that cover it.
        hashes, reach = F.transform(w, lambda x: F.xxhash64(x)), 1
        while reach < window:
            step = min(reach, window - reach)
            hashes, reach = let(hashes, joined(step)), reach + step
        return hashes

    def joined(step: int) -> Callable[[Column], Column]:
        def pairs(h: Column) -> Column:
            n = F.size(h) - step
            return F.zip_with(F.slice(h, 1, n), F.slice(h, step + 1, n), lambda a, b: F.xxhash64(a, b))

        return pairs

    return let(
        words, lambda w: F.when(F.size(w) < window + 1, F.lit(0).cast("long")).otherwise(let(hashed(w), counted))
    )


# Histograms ----------------------------------------------------------------------------


def common_words(docs: DataFrame) -> DataFrame:
    """The commonest words of every language."""
    words = F.explode(words_of(F.lower(F.coalesce("text", F.lit("")))))
    counted = docs.filter("language IS NOT NULL").select("language", "frequent", words.alias("word"))
    counted = counted.groupBy("language", "frequent", "word").agg(F.count(F.lit(1)).alias("n"))
    # A language's k commonest words are found per slice of the vocabulary first: no window holds it all.
    counted = counted.filter("n > 1").withColumn("part", F.pmod(F.xxhash64("word"), F.lit(64)))
    order = [F.col("n").desc(), F.col("word")]
    near = F.row_number().over(Window.partitionBy("language", "part").orderBy(*order))
    some = counted.withColumn("k", near).filter(F.col("k") <= COMMON_WORDS)
    first = F.row_number().over(Window.partitionBy("language").orderBy(*order))
    top = some.withColumn("k", first).filter(F.col("k") <= COMMON_WORDS)
    return top.groupBy("language", "frequent").agg(F.sort_array(F.collect_list("word")).alias("common"))


def with_language(docs: DataFrame) -> tuple[DataFrame, bool]:
    """doc_id, text, language (NULL for none) and whether it is frequent; and whether there is a language that is not."""
    sizes = materialise(docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    frequent = F.col("n") * LANGUAGE_SHARE >= total
    own = sizes.filter(F.col("lang").isNotNull() & (F.col("lang") != ""))
    known = own.filter(frequent).select(F.col("lang").alias("language"), F.lit(True).alias("known"))
    rows = docs.select("doc_id", "text", F.when(F.col("lang") != "", F.col("lang")).alias("language"))
    rows = rows.join(F.broadcast(known), "language", "left").withColumn("frequent", F.coalesce("known", F.lit(False)))
    return rows.select("doc_id", "text", "language", "frequent"), not own.filter(~frequent).isEmpty()


def join_language(rows: DataFrame, per_language: DataFrame, rare: bool) -> DataFrame:
    """Left join with one row per language; `rare` says whether there are languages that are not frequent.

    Rows without a language are not shuffled: their one key would be one task's.
    """
    frequent = rows.filter("frequent OR language IS NULL")
    joined = frequent.join(F.broadcast(per_language.filter("frequent").drop("frequent")), "language", "left")
    if not rare:
        return joined
    others = rows.filter("NOT frequent AND language IS NOT NULL")
    return joined.unionByName(others.join(per_language.filter("NOT frequent").drop("frequent"), "language", "left"))


def measured(docs: DataFrame, common: DataFrame, rare: bool) -> DataFrame:
    """Base counts and both histograms of every row."""
    rows = join_language(docs, common, rare).withColumn("common", F.coalesce("common", F.array().cast("array<string>")))
    text = F.coalesce("text", F.lit(""))
    rows = rows.select("doc_id", "language", "frequent", "common", text.alias("text"), words_of(text).alias("words"))

    # No character is in two classes, so each is taken from what the ones before it leave, mostly little.
    left = ["text", *[f"without_{c}" for c in CLASSES]]
    for before, after, pattern in zip(left, left[1:], CLASSES.values()):
        rows = rows.withColumn(after, F.regexp_replace(before, pattern, ""))
    classes = [(F.length(a) - F.length(b)).cast("double") for a, b in zip(left, left[1:])]

    def word_counts(x: Column) -> Column:
        hits = F.filter(x["lowered"], lambda w: F.array_contains(x["common"], w))
        counts = let(
            F.struct(hits.alias("hits"), x["common"].alias("common")),
            lambda y: F.transform(
                y["common"], lambda c: (F.size(y["hits"]) - F.size(F.array_remove(y["hits"], c))).cast("double")
            ),
        )
        total = F.size(x["lowered"]).cast("double")
        return let(counts, lambda c: F.concat(c, F.array(total - F.aggregate(c, F.lit(0.0), lambda a, b: a + b))))

    lowered = F.struct(F.transform("words", lambda w: F.lower(w)).alias("lowered"), "common")
    return rows.select(
        "doc_id",
        "language",
        "frequent",
        F.size("words").cast("long").alias("n_words"),
        F.length("text").cast("long").alias("n_chars"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.array(*classes).alias("class_counts"),
        let(lowered, word_counts).alias("word_counts"),
    )


def _with_rest(counts: Column, total: Column) -> Column:
    """A histogram whose last bin is what the others leave of the total."""
    return let(counts, lambda c: F.concat(c, F.array(total - F.aggregate(c, F.lit(0.0), lambda a, b: a + b))))


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return let(
        F.struct(counts.alias("c"), total.alias("t")),
        lambda x: F.transform(x["c"], lambda v: F.when(x["t"] > 0, v / x["t"]).otherwise(0.0)),
    )


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (root of the divergence in bits) of two histograms of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    both = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.aggregate(both, F.lit(0.0), lambda a, b: a + b) / 2, F.lit(0.0)))


def quality_rules(
    docs: DataFrame, max_word_distance: float = MAX_WORD_DISTANCE, max_class_distance: float = MAX_CLASS_DISTANCE
) -> DataFrame:
    """Base counts, distances and verdict of every row.

    Runs jobs when called: common words, counts and references are written to the shared folder.
    """
    rows, rare = with_language(docs)
    common = materialise(common_words(rows), "common-words")
    counts = materialise(measured(rows, common, rare), "text-counts")

    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    space = (F.col("n_chars") - F.col("word_chars")).cast("double")
    class_counts = _with_rest(F.concat("class_counts", F.array(space)), F.col("n_chars").cast("double"))
    counts = counts.withColumn("base_failed", failed).withColumn("class_counts", class_counts)

    sound = counts.filter("NOT base_failed AND language IS NOT NULL")
    bins = len(CLASSES) + 2
    sums = [F.sum(F.col("class_counts")[i]).alias(f"c{i}") for i in range(bins)]
    # A language with fewer common words than the rest has NULL in the bins it lacks.
    sums += [F.sum(F.try_element_at("word_counts", F.lit(i + 1))).alias(f"w{i}") for i in range(COMMON_WORDS + 1)]
    totals = sound.groupBy("language", "frequent").agg(*sums, F.sum("n_chars").alias("chars"), F.sum("n_words").alias("words"))
    class_reference = shares(F.array(*[f"c{i}" for i in range(bins)]))
    word_reference = shares(F.filter(F.array(*[f"w{i}" for i in range(COMMON_WORDS + 1)]), lambda x: x.isNotNull()))
    class_reference = F.when(F.col("chars") >= MIN_REFERENCE_CHARS, class_reference)
    word_reference = F.when(F.col("words") >= MIN_REFERENCE_WORDS, word_reference)
    references = totals.select("language", "frequent", class_reference.alias("class_ref"), word_reference.alias("word_ref"))
    judged = join_language(counts, materialise(references, "references"), rare)
    by_class = jensen_shannon(shares(F.col("class_counts")), F.col("class_ref"))
    by_word = jensen_shannon(shares(F.col("word_counts")), F.col("word_ref"))
    by_class, by_word = F.when(F.col("class_ref").isNotNull(), by_class), F.when(F.col("word_ref").isNotNull(), by_word)
    judged = judged.withColumns({"class_distance": by_class, "word_distance": by_word})
    far_class = (F.col("n_chars") >= MIN_JUDGED_CHARS) & (F.col("class_distance") > max_class_distance)
    far_words = (F.col("n_words") >= MIN_JUDGED_WORDS) & (F.col("word_distance") > max_word_distance)
    bad = F.coalesce(far_class, F.lit(False)) | F.coalesce(far_words, F.lit(False))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~bad).alias("kept"),
        "class_distance",
        "word_distance",
    )
