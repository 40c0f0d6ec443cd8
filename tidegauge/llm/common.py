"""Shared helpers: the shared folder, cutting lineage, batch streams and column-safe selection."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only on one machine (tests), where the session names none, is a fresh local folder set; on a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            return jvm_dir.get()
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-shared-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Computes ``df`` once into the shared folder; later reads survive the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like ``cut`` but as compressed Parquet, for wide rows."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


#: Spark's setting for the bytes of a batch that goes to a Python worker.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder.

    Its texts may be long, so unless the session's configuration names another size, batches to Python workers
    are held to 8 MB, on both sides of the pipe.
    """
    if not spark.sparkContext.getConf().contains(_BATCH_BYTES):
        spark.conf.set(_BATCH_BYTES, "8m")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty) and nothing else, so that other columns can't clash."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def drawn(rows: DataFrame, most: int) -> DataFrame:
    """The rows of ``most`` doc_ids drawn by hash (null ids aren't).

    The ids are drawn alone and sent to all tasks (at most ``most`` longs), so that texts neither move nor meet in one task.
    """
    ids = rows.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return rows.join(F.broadcast(ids), "doc_id", "left_semi")


def row_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds a 128-bit content key of the row as ``__k1``, ``__k2`` (equal for identical rows)."""
    marked = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return df.withColumn("__k1", F.xxhash64(F.lit(1), *marked)).withColumn("__k2", F.xxhash64(F.lit(2), *marked[::-1]))


def runs(batches, key: str):
    """Streams (key value, table) of consecutive equal keys out of sorted Arrow batches."""
    import numpy as np
    import pyarrow as pa

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        cuts = [0, *edges.tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and held[-1].column(key)[0].as_py() != keys[lo]:
                yield held[0].column(key)[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield held[0].column(key)[0].as_py(), pa.Table.from_batches(held)


def streamed(holds: DataFrame, asks: DataFrame, shards: int, blocks: int, open_, answer, schema: str) -> DataFrame:
    """What ``answer(held, ask)`` yields, with each block of ``asks`` (shard, block, ...) streamed past the shard that it asks.

    A shard (a row of ``holds``) moves to one task, or to a few lanes where there are fewer shards than cores; ``open_`` turns its row into
    what is held, once.  A block moves once for each shard that it asks; a task holds one shard and one block.  Rows come as dictionaries.
    """
    from pyspark.sql import functions as F

    cores = holds.sparkSession.sparkContext.defaultParallelism
    lanes = max(1, min(blocks, -(-2 * cores // shards)))
    own = [c for c in holds.columns if c != "shard"]
    more = [c for c in asks.columns if c not in ("shard", "block")]
    kinds = dict(holds.dtypes) | dict(asks.dtypes)
    told = lambda rows, names: [F.col(c) if c in names else F.lit(None).cast(kinds[c]).alias(c) for c in dict.fromkeys([*own, *more])]
    held = holds.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).select("shard", "lane", F.lit(-1).alias("block"), *told(holds, own))
    sent = asks.withColumn("lane", F.pmod(F.col("block"), F.lit(lanes))).select("shard", "lane", "block", *told(asks, more))
    both = held.unionByName(sent).repartition(max(1, shards * lanes), "shard", "lane").sortWithinPartitions("shard", "lane", "block")

    def meet(batches):
        at, one = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["block"] < 0:
                    at, one = (row["shard"], row["lane"]), open_(row)
                elif at == (row["shard"], row["lane"]):
                    yield from answer(one, row)
        release()

    return both.mapInArrow(meet, schema)


def release() -> None:
    """Gives memory that the worker has freed back to the system, since workers stay between tasks and stages."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def slices(batch, text="text", rows: int = 200, size: int = 1 << 20):
    """Parts of an Arrow batch of at most ``rows`` rows and about ``size`` bytes of text (a longer text alone), so that a part's memory is bounded."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = before = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, min(lo + rows, int(np.searchsorted(ends, before + size, side="right"))))
        yield batch.slice(lo, hi - lo)
        lo, before = hi, int(ends[hi - 1])
    release()
