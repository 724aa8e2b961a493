"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
as the next stage's docs. All but the last return the columns they were given. The stages need
`doc_id`, `text` and, for language, `lang`; other columns go along unchanged, whatever their names, but for
`n_chars`, which follows the text. Labels come from `labels` in sf_dir.

Defined cases, for all stages: an empty table gives an empty one; rows with a NULL id are judged like others and
never learned from; a repeated row is a document of its own until near-dedup, which keeps one of a group. A NULL
or empty text has the score of a text without words, is `und` and so goes at the language stage; a very long
text is judged whole by one task, its lines, shingles and ids in parts where the operator says so. Ties in
near-dedup fall to the smallest id, then the first row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premiere.llm import language_id, line_dedup, packing, quality_model, simhash
from premiere.llm.common import carried, table, unpacked
from premiere.session import materialise, scratch_dir, scratch_scope

MIN_QUALITY = 0.5
MIN_LANGUAGE_SCORE = 0.25  # of what training text of the language reaches


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality model, fitted on all labels, takes for label 1."""
    rows = quality_model.training_rows(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), F.lit(True))
    scored = quality_model.scored(carried(docs, "doc_id", "text"), quality_model.fit_on(rows))
    return scored.filter(F.col("quality_score") >= MIN_QUALITY).select(*unpacked(docs, "doc_id", "text").values())


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: neither without letters nor foreign to every language's trigrams."""
    learned = language_id.learn(docs.select("doc_id", "text", "lang"), F.lit(True))
    judged = language_id.identified(carried(docs, "text"), learned)
    enough = F.col("lang_score") >= MIN_LANGUAGE_SCORE * F.col("lang_known")
    known = (F.col("lang_pred") != language_id.UNKNOWN) & enough
    return judged.filter(known).select(*unpacked(docs, "text").values())


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; a document of which nothing is left goes."""
    left = line_dedup.line_dedup(carried(docs, "doc_id", "text"))
    left = left.filter((F.col("deleted_lines") == 0) | (F.col("text") != ""))
    columns = unpacked(docs, "doc_id", "text")
    if "n_chars" in columns:
        changed = F.when(F.col("deleted_lines") > 0, F.length("text")).otherwise(columns["n_chars"])
        columns["n_chars"] = changed.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return left.select(*columns.values())


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the smallest id, then the first row.

    Rows are told apart by their place in the input, which must be the same when read again, as files are.
    """
    row = F.monotonically_increasing_id().alias("_near_row")
    numbered = carried(docs, "doc_id", "text").select("*", row)
    groups = simhash.near_groups(numbered.select(F.col("_near_row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_near_row"), "component_id")
    ids = numbered.select("_near_row", "doc_id").join(groups, "_near_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_near_row")).alias("first")
    kept = materialise(ids.groupBy("component_id").agg(first).select(F.col("first._near_row").alias("_near_row")), "kept")
    # The same plan at every size, as in line dedup: texts are dealt once and meet the row numbers unsorted.
    left = numbered.join(kept.hint("shuffle_hash"), "_near_row", "left_semi")
    return left.select(*unpacked(docs, "doc_id", "text").values())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2,048 ids."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("language ID", keep_known_languages),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("best-fit packing", pack),
]

#: Models, fingerprints and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. What a stage writes on its way goes once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{scratch_dir(spark)}/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        with scratch_scope(spark):
            built = stage(spark, docs, sf_dir)
            built.write.parquet(path)
        docs = spark.read.schema(built.schema).parquet(path)
    return docs
