"""SimHash near-duplicates by covering locality-sensitive hashing.

For radius r each of the 64 bit places gets a vector of r + 1 bits; for every nonzero vector v the mask of
table v keeps the places whose vector has an odd product with v.  The places in which two fingerprints
differ span at most r dimensions if there are at most r of them, so some nonzero v is orthogonal to all of
them and its mask hides every difference: each pair within the radius meets in at least one of the
2**(r + 1) - 1 tables, for certain.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, id_and_text, runs, slices
from .components import components, forest


def masks(radius: int) -> np.ndarray:
    """The bit masks of all tables, from a fixed spread of the vectors over the bit places."""
    n = 1 << (radius + 1)
    place = np.random.default_rng(64).permutation(64)
    vectors = 1 + place % (n - 1)
    out = []
    for v in range(1, n):
        odd = np.bitwise_count(vectors & v) & 1
        out.append(sum(1 << i for i in range(64) if odd[i]))
    return np.array(out, dtype=np.uint64)


def _word_windows(blob: bytes, words: int, size: int):
    """Lists of words, some at a time; each begins with the last ``words`` - 1 of the one before, so that every shingle lies in just one."""
    import re

    end, tail = 0, []
    while end < len(blob):
        start, end = end, min(len(blob), end + size)
        if end < len(blob):
            space = re.compile(rb"[\x20\x09-\x0D]").search(blob, end)
            end = space.start() if space else len(blob)
        w = tail + blob[start:end].lower().split()
        yield w
        tail = w[len(w) - words + 1 :] if len(w) >= words else w


def fingerprint(text: str | None, words: int = 3, size: int = 1 << 20) -> int:
    """64-bit SimHash of the shingles of ``words`` words, repeats included; about ``size`` bytes of text are words at a time."""
    import xxhash

    h, ones, n, w = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64), 0, []
    for w in _word_windows((text or "").encode("utf-8", "surrogatepass"), words, size):
        hashes = [h(b" ".join(s), 42) for s in zip(*(w[i:] for i in range(words)))] if len(w) >= words else []
        a = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        for lo in range(0, len(a), 65536):
            ones += np.unpackbits(a[lo : lo + 65536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    if not n and w:  # fewer words than a shingle has: the whole sequence
        return h(b" ".join(w), 42)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a long) of every row."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                fp = np.array([fingerprint(t, words) for t in part.column("text").to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, fp long")


def links_within(fps: DataFrame, radius: int, block: int = 2048) -> DataFrame:
    """A spanning set of the links between distinct fingerprints (column fp) at most ``radius`` bits apart.

    Tables' buckets are dealt by (table, key).  A bucket of more than ``block`` fingerprints is cut into
    blocks by hash and each pair of blocks becomes a task's work, so no bucket is ever too large and none is
    dropped.  Within a piece of work every pair is compared, and as many links leave it as it has nodes.
    """
    table_masks = masks(radius)

    def keys(batches):
        import pyarrow as pa

        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for t, mask in enumerate(table_masks):
                # one number for table and key: equal only if both are (the mixing steps are one-to-one), up to 64-bit chance, and all pairs are compared in full
                key = (fp & mask) * np.uint64(0x9E3779B97F4A7C15)
                key ^= (key >> np.uint64(32)) ^ np.uint64((t * 0xD1B54A32D192ED03) & (2**64 - 1))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("fp")], ["key", "fp"])

    def compare(batches):
        import pyarrow as pa

        a_out, b_out, held = [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], ["a", "b"])

        for _, group in runs(batches, "work"):
            if group.num_rows < 2:
                continue
            fp = group.column("fp").to_numpy().view(np.uint64)
            found = []
            for lo in range(0, len(fp), 1024):
                near = np.bitwise_count(fp[lo : lo + 1024, None] ^ fp[None, :]) <= radius
                x, y = np.nonzero(near)
                x += lo
                ok = x < y
                if ok.any():
                    found.append(forest(fp.view(np.int64)[x[ok]], fp.view(np.int64)[y[ok]]))
            for a, b in found:
                a_out.append(a[a != b])
                b_out.append(b[a != b])
                held += len(a)
            if held > 20_000:
                yield flush()
                a_out, b_out, held = [], [], 0
        if a_out:
            yield flush()

    spread = fps.mapInArrow(keys, "key long, fp long")
    spread = cut(spread)
    large = spread.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block).select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    flagged = spread.join(large, "key", "left")
    small = flagged.where("blocks is null").select(F.col("key").alias("work"), "fp")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    split = flagged.where("blocks is not null").select("key", "fp", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    split = split.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("work"), "fp")
    work = small.union(split)
    return work.repartition("work").sortWithinPartitions("work").mapInArrow(compare, "a long, b long").distinct()


def groups(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fp and component_id of every row.

    Rows of equal fingerprint form one class; links are sought between distinct fingerprints only, so any
    number of copies costs one entry.  Null or empty texts have fingerprint zero and are linked like any
    other.  component_id is the smallest non-null doc_id of the group (null if it has none); repeated rows
    are kept as they are; an empty table gives no rows.
    """
    fps = cut(fingerprints(docs, words))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    comp = components(links_within(distinct.select("fp"), radius))
    classed = distinct.join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = classed.join(classed.groupBy("component").agg(F.min("first_id").alias("component_id")), "component").select("fp", "component_id")
    return fps.join(named, "fp")
