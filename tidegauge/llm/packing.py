"""Packing by shortest-pack-first over the histogram of lengths."""

from __future__ import annotations

import heapq
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, id_and_text, slices

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def plan_packs(histogram: dict[int, int], size: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Placements (length, first rank, count, first sequence, offset) and the number of sequences.

    Lengths go longest first.  Each goes to the packs that are filled least so far (the shortest), as many at
    once as share a pattern; if it fits none of them, it opens packs and fills them.  Packs of one pattern have
    consecutive numbers, so a placement is a range of ranks laid on a range of sequences.
    """
    placements, packs, sequences = [], [], 0  # packs: heap of (used, first sequence, count)
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if packs and packs[0][0] + length <= size:
                used, first, count = heapq.heappop(packs)
                n = min(left, count)
                if n < count:
                    heapq.heappush(packs, (used, first + n, count - n))
                placements.append((length, rank, n, first, used))
                rank, left, used = rank + n, left - n, used + length
            else:  # nothing fits: a pack that is opened is the shortest, so it takes as many of this length as fit
                fits = min(size // length, left)
                first, n, used = sequences, left // fits, fits * length
                sequences += n
                for k in range(fits):
                    placements.append((length, rank + k * n, n, first, k * length))
                rank, left = rank + fits * n, left - fits * n
            if used < size:
                heapq.heappush(packs, (used, first, n))
    return placements, sequences


def token_pieces(docs: DataFrame, vocabulary: str, size: int, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``size`` ids of each document's ids and end id; with their ids if asked."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from .encoding import encoder

        e, end = encoder(vocabulary), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for part in slices(batch, rows=4000, size=4 << 20):
                out = [[] for _ in range(6)]
                for doc_id, blob in zip(part.column("doc_id").to_pylist(), e.encode(part.column("text").to_pylist(), end)):
                    n = len(blob) // 4
                    for at in range(0, n, size):
                        piece = blob[4 * at : 4 * (at + size)]
                        for c, v in zip(out, (doc_id, at, len(piece) // 4, zlib.crc32(piece), n, piece)):
                            c.append(v)
                arrays = [pa.array(c, pa.int64()) for c in out[:5]] + ([pa.array(out[5], pa.binary())] if with_ids else [])
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(arrays)])

    return id_and_text(docs).mapInArrow(run, PIECE + (", ids binary" if with_ids else ""))


def _slots(placements: list[tuple], histogram: dict[int, int]) -> tuple[list[tuple], dict[int, int]]:
    """Placements with a bucket of ranks each, and the number of buckets by length.

    A length has as many buckets of equal width as placements; a placement is repeated for each bucket that it
    overlaps, so that ranks find their placement by equality and meet about two on average.
    """
    buckets: dict[int, int] = {}
    for length, *_ in placements:
        buckets[length] = buckets.get(length, 0) + 1
    out = []
    for length, first, n, sequence, offset in placements:
        g, of = buckets[length], histogram[length]
        out += [(length, b, first, n, sequence, offset) for b in range(first * g // of, (first + n - 1) * g // of + 1)]
    return out, buckets


def pack(docs: DataFrame, vocabulary: str, size: int = 4096, end_id: int = 2, with_ids: bool = False, rows_a_salt: int = 5_000) -> DataFrame:
    """Every piece with its sequence_id and offset.

    Null texts count as empty (one piece, the end id); doc_ids may be null or repeated; an empty table
    gives no rows.  Only the histogram, at most ``size`` rows, comes to the driver.  Ranks within a
    length are counted by salt, the number of the part of the table that holds the row, so a length that a third of the pieces
    share, or one row repeated, takes many tasks.
    """
    spark = docs.sparkSession
    pieces = cut(token_pieces(docs, vocabulary, size, end_id, with_ids))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, buckets = _slots(plan_packs(histogram, size)[0], histogram)
    lengths = spark.createDataFrame([(k, n, buckets[k], -(-n // rows_a_salt)) for k, n in histogram.items()], "length long, of long, buckets long, salts long")
    salted = pieces.withColumn("part", F.spark_partition_id()).join(F.broadcast(lengths), "length").withColumn("salt", F.pmod("part", "salts"))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = salted.withColumn("own", F.row_number().over(own) - 1).join(bases, ["length", "salt"]).withColumn("rank", F.col("own") + F.col("base"))
    placed = spark.createDataFrame(slots, "length long, bucket long, first_rank long, n long, first_sequence long, offset long")
    if len(slots) <= 200_000:
        placed = F.broadcast(placed)
    inside = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n"))
    found = ranked.withColumn("bucket", F.expr("(rank * buckets) div of")).join(placed, ["length", "bucket"]).where(inside)
    return found.select(*pieces.columns, (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")
