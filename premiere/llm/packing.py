"""Best-fit packing planned on the histogram of piece lengths.

A document is its ids and one end id; only documents over the capacity are cut, so that all pieces but
the first are full. The counts per length (at most `capacity` of them) reach the driver, which places
lengths from long to short: as many pieces as possible at once go into the sequences with the least
room that still suffices, held as runs of sequence numbers. Every step of the plan says: pieces number
r..r+k of this length go to sequences s..s+k at this offset. Pieces are numbered within their length by
bucket and offset, and find their step by that number.

Defined cases: a NULL text is empty and gives one piece, the end id; repeated rows and NULL ids are
packed row by row; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premiere.llm import bpe
from premiere.session import materialise

CAPACITY = 2048
BUCKET_ROWS = 20_000
LEAST_BUCKETS = 256
BROADCAST_STEPS = 100_000  # about 4 MB


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str = bpe.VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length and CRC-32 of the ids of every piece."""
    n = F.octet_length("ids") / 4
    first = (n - 1) % capacity + 1

    def piece(p):
        start = F.when(p == 0, 0).otherwise(F.col("first") + (p - 1) * capacity).cast("long")
        length = F.when(p == 0, F.col("first")).otherwise(capacity).cast("long")
        ids = F.substring("ids", (start * 4 + 1).cast("int"), (length * 4).cast("int"))
        return F.struct(p.alias("piece"), start.alias("start"), length.alias("length"), F.crc32(ids).alias("ids_crc32"))

    whole = bpe.encode_texts(docs, path).select("doc_id", F.concat("ids", F.lit(bytes(4))).alias("ids"))
    counted = whole.select("doc_id", "ids", first.cast("long").alias("first"), F.ceil(n / capacity).cast("int").alias("pieces"))
    cut = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), piece)
    return counted.select("doc_id", F.explode(cut).alias("p")).select("doc_id", "p.*")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Steps (length, first number, count, first sequence, offset) of best fit, longest first."""
    runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, count)
    rooms: list[int] = []
    steps, sequences = [], 0

    def leave(room: int, first: int, count: int) -> None:
        if not room or not count:
            return
        if not runs.get(room):
            bisect.insort(rooms, room)
            runs[room] = []
        runs[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, number = histogram[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                break
            room = rooms[at]
            first, count = runs[room].pop()
            if not runs[room]:
                rooms.pop(at)
            k = min(left, count)
            steps.append((length, number, k, first, capacity - room))
            leave(room, first + k, count - k)
            leave(room - length, first, k)
            left, number = left - k, number + k
        each = capacity // length
        for bins, inside in ((left // each, each), (1, left % each)):
            if bins and inside:
                steps += [(length, number + j * bins, bins, sequences, j * length) for j in range(inside)]
                leave(capacity - inside * length, sequences, bins)
                sequences, number = sequences + bins, number + inside * bins
    return steps


def numbered(pieces: DataFrame, rows: int) -> DataFrame:
    """Pieces with their number within their length, from 0; no task sorts more than a bucket."""
    buckets = max(LEAST_BUCKETS, rows // BUCKET_ROWS)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    joined = dealt.withColumn("within", within).join(offsets, ["length", "bucket"])
    return joined.withColumn("number", F.col("before") + F.col("within")).drop("bucket", "before", "within")


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str = bpe.VOCABULARY) -> DataFrame:
    """Every piece with its sequence and offset. Runs jobs when called; the pieces are written."""
    spark = docs.sparkSession
    pieces = token_pieces(docs, capacity, path).withColumn("row", F.monotonically_increasing_id())
    pieces = materialise(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    steps = plan(histogram, capacity)
    by_length: dict[int, list[tuple[int, int, int]]] = {}
    for length, number, _, first, offset in sorted(steps):
        by_length.setdefault(length, []).append((number, first, offset))
    rows = [(length, *map(list, zip(*s))) for length, s in by_length.items()]
    slots = spark.createDataFrame(rows, "length long, numbers array<long>, firsts array<long>, offsets array<long>")
    if len(steps) <= BROADCAST_STEPS:
        slots = F.broadcast(slots)
    placed = numbered(pieces, sum(histogram.values())).join(slots, "length")
    at = F.size(F.filter("numbers", lambda x: x <= F.col("number"))) - 1
    placed = placed.withColumn("at", at)
    sequence = F.col("firsts")[F.col("at")] + F.col("number") - F.col("numbers")[F.col("at")]
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        sequence.alias("sequence_id"),
        F.col("offsets")[F.col("at")].alias("offset"),
    )
