"""Vector expressions and title embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm(v: Column) -> Column:
    return F.sqrt(_dot(v, v))


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double arithmetic: NULL when a side is NULL, 0 when a side has no length."""
    length = norm(a) * norm(b)
    return F.when(length == 0, F.lit(0.0)).otherwise(F.try_divide(_dot(a, b), length))


def unit(v: Column) -> Column:
    """The vector scaled to length one; a zero vector stays as it is."""

    def scaled(s: Column) -> Column:
        return F.transform(s["v"], lambda x: F.coalesce(F.try_divide(x.cast("double"), s["length"]), F.lit(0.0)))

    # Named inside lambdas, the vector and its length are computed once, not once per element.
    held = F.transform(F.array(v), lambda w: F.struct(w.alias("v"), norm(w).alias("length")))
    return F.transform(held, scaled)[0]


def as_ml_vector(v: Column) -> Column:
    return array_to_vector(v)


def hashed_title_vectors(
    df: DataFrame, text: str = "product_name", dimensions: int = 64, out: str = "product_embedding"
) -> DataFrame:
    """Unit-length hashed bag of words. Stateless, so training and scoring agree."""
    filled = df.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    words = RegexTokenizer(inputCol="__text", outputCol="__words", pattern=r"\W+")
    counts = HashingTF(inputCol="__words", outputCol="__counts", numFeatures=dimensions)
    unit_length = Normalizer(inputCol="__counts", outputCol="__unit", p=2.0)
    vectors = unit_length.transform(counts.transform(words.transform(filled)))
    return vectors.withColumn(out, vector_to_array("__unit", "float32")).drop(
        "__text", "__words", "__counts", "__unit"
    )


def word_buckets(text: Column, dimensions: int) -> Column:
    """The bucket of every word (letters and digits, lower case) of a title, by hash."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))
    digits = F.transform(words, lambda w: F.substring(F.md5(w.cast("binary")), 1, 8))
    return F.transform(digits, lambda d: (F.conv(d, 16, 10).cast("bigint") % dimensions).cast("int"))


def document_frequencies(df: DataFrame, text: str = "product_name", dimensions: int = 64) -> DataFrame:
    """(bucket, titles, weight) of all buckets: weight = ln((1 + all titles) / (1 + titles with the bucket)).

    Counted once, on the history, and saved; training and announcements are weighted by the same table.
    """
    held = df.select(F.array_distinct(word_buckets(F.col(text), dimensions)).alias("held"))
    counts = held.select(F.explode("held").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("titles"))
    every = df.sparkSession.range(dimensions).select(F.col("id").cast("int").alias("bucket"))
    titles = F.coalesce("titles", F.lit(0))
    weight = F.log((F.lit(1.0) + F.col("all_titles")) / (F.lit(1.0) + titles))
    known = every.join(counts, "bucket", "left").join(held.agg(F.count(F.lit(1)).alias("all_titles")))
    return known.select("bucket", titles.alias("titles"), weight.alias("weight"))


def weighted_title_vectors(
    df: DataFrame, frequencies: DataFrame, text: str = "product_name", out: str = "product_embedding"
) -> DataFrame:
    """Unit-length bag of word buckets, weighted by inverse document frequency. The weights, one per bucket, reach the driver."""
    weights = [r["weight"] for r in frequencies.orderBy("bucket").collect()]

    def weighted(held: Column) -> Column:
        every = F.array(*[F.lit(float(w)) for w in weights])
        return F.transform(every, lambda w, i: w * F.size(F.filter(held, lambda b: b == i)))

    # Named inside one lambda, a title's buckets are computed once, not once per dimension.
    vector = F.transform(F.array(word_buckets(F.col(text), len(weights))), weighted)[0]
    return df.withColumn(out, unit(vector).cast("array<float>"))


def encoded_title_vectors(
    df: DataFrame,
    make_encoder: Callable[[], Callable[[list[str]], list]],
    text: str = "product_name",
    out: str = "product_embedding",
) -> DataFrame:
    """Vectors from a user's encoder, loaded once per task and fed Arrow batches."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for titles in batches:
            yield pd.Series([list(map(float, v)) for v in encoder(titles.fillna("").tolist())])

    return df.withColumn(out, encode(F.col(text)))
