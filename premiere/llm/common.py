"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: blank and \t \n \v \f \r. Python's bytes.split() splits at the same six.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end by size, so that batches of very long texts fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def per_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, also where it is used inside a lambda."""
    return F.transform(F.array(value), use)[0]


def id_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text, NULL as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


CARRIED = "_carried"


def carried(docs: DataFrame, *used: str) -> DataFrame:
    """The used columns, and all others as one struct: no name that an operator works with can meet theirs."""
    rest = [docs[f"`{c}`"] for c in docs.columns if c not in used]
    held = F.struct(*rest) if rest else F.lit(None).cast("int")
    return docs.select(*[c for c in used if c in docs.columns], held.alias(CARRIED))


def unpacked(docs: DataFrame, *used: str) -> dict[str, Column]:
    """The columns of docs by name, as they are found in rows of carried(docs, *used)."""
    return {c: (F.col(c) if c in used else F.col(CARRIED).getField(c)).alias(c) for c in docs.columns}


HOT_SHARE = 1000


def join_spread(
    rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, salts: int = 64
) -> DataFrame:
    """Inner equi-join of many rows with one row per key, hot keys spread over salts.

    `size` is the column of `groups` that counts a key's rows. Keys with over a thousandth of all
    rows (and over 10,000) are repeated once per salt; there are at most 1,000 of them, so their list
    is broadcast. Their rows draw a salt from all their columns: the answer does not depend on the
    order of tasks. `groups` should be a written table, it is read three times.
    """
    keys = [key] if isinstance(key, str) else key
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) > max(10_000, total // HOT_SHARE)
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    spread = groups.withColumn("_salt", F.explode(F.when(hot, every).otherwise(F.array(F.lit(0)))))
    heavy = groups.filter(hot).select(*keys, F.lit(True).alias("_hot"))
    own = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    drawn = rows.join(F.broadcast(heavy), keys, "left").withColumn("_salt", F.when(F.col("_hot"), own).otherwise(0))
    return drawn.drop("_hot").join(spread, [*keys, "_salt"]).drop("_salt")
