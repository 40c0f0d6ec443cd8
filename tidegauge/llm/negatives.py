"""Hard negatives by slots: a positive's upper limit is the upper end of a slot of scores, and a window is a run of slots.

Rows lie in shards of bounded size, each of which goes once to one task; blocks of anchors are streamed past it.  First each shard gives
its best positives of every anchor.  Their upper limits part the scores of an anchor's other rows into disjoint slots, of which
each shard keeps the best of each; the window of a positive is answered by its own slot and those below, read downwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, streamed

_PACKED = ["uid", "vec_id", "label", "x"]


def whole_vectors(vectors: DataFrame, label: Column, scale: float) -> DataFrame:
    """uid, vec_id, label and v (floor(scale * x) as doubles) of rows with an id, a label and only finite components."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    return rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("double")).alias("v"))


def packed(rows: DataFrame, key: str, dim: int, *more: str) -> DataFrame:
    """A row a value of ``key``: its rows by vec_id as binaries (vectors end in zeros up to ``dim``), and more columns of long lists alike."""
    fields = [*_PACKED, *more]

    def pack(table):
        import pyarrow as pa

        table = table.sort_by([("vec_id", "ascending"), ("uid", "ascending")])
        lists = table.column("v").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        x = np.zeros((table.num_rows, dim))
        x[np.arange(dim)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
        flat = lambda c: table.column(c).combine_chunks().flatten() if c in more else table.column(c)
        held = [x.tobytes() if c == "x" else flat(c).to_numpy().astype("<i8").tobytes() for c in fields]
        return pa.table({key: pa.array([table.column(key)[0].as_py()], pa.int32()), **{c: [b] for c, b in zip(fields, held)}})

    return rows.groupBy(key).applyInArrow(pack, f"{key} int, " + ", ".join(f"{c} binary" for c in fields))


def first_places(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, downwards, equal ones by place."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, ties = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        some = np.concatenate([above, ties[: k - len(above)]])
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((some, -scores[some]))]


def past_shards(holds: DataFrame, asks: DataFrame, shards: int, blocks: int, dim: int, whole: bool, answer) -> DataFrame:
    """anchor, slot, vec_id, score: what ``answer(shard, block, anchor's place, its scores)`` finds, with every block of ``asks`` streamed past every shard.

    ``whole``: products are exact in doubles, else they're taken in 64-bit integers.
    """

    def opened(row):
        one = {c: np.frombuffer(v, "<f8" if c == "x" else "<i8") for c, v in row.items() if isinstance(v, bytes)}
        one["x"] = one["x"].reshape(len(one["uid"]), dim)
        return one if whole else one | {"x": one["x"].astype(np.int64)}

    def answered(hold, row):
        import pyarrow as pa

        ask = opened(row)
        scores = ask["x"] @ hold["x"].T
        found = [(a, s, hold["vec_id"][rows], scores[a, rows]) for a in range(len(scores)) for s, rows in answer(hold, ask, a, scores[a])]
        n = [len(f[2]) for f in found]
        all_of = lambda k: np.concatenate([f[k] for f in found]).astype(np.int64) if found else np.empty(0, np.int64)
        anchor, slot = ask["uid"][np.repeat([f[0] for f in found], n).astype(np.int64)], np.repeat([f[1] for f in found], n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (anchor, slot, all_of(2), all_of(3))], ["anchor", "slot", "vec_id", "score"])

    sent = asks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return streamed(holds, sent, shards, blocks, opened, answered, "anchor long, slot long, vec_id long, score long")


def hard_negatives(vectors: DataFrame, label: Column, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0, rows_a_shard: int = 8192, rows_a_block: int = 512) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id ``every`` divides; an anchor's positives are the best ``positives`` other rows of its label, a positive's
    negatives the best ``negatives`` rows of other labels with low * p <= 100 * n <= high * p.  Scores are integer inner products of
    floor(scale * x), exact below 2**63 (an error if they may pass that); ties go to the smaller vec_id; ranks count from 1.  Rows without a vec_id, label or vector, or with a null
    or non-finite component, take no part; shorter vectors end in zeros; rows of a repeated vec_id all count, an
    anchor's twin too.  No rows: no result.
    """
    rows = cut(whole_vectors(vectors, label, scale))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"), F.count(F.when(F.pmod("vec_id", F.lit(every)) == 0, 1)).alias("q"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))).alias("top")).first()
    dim, shards, blocks = max(1, size["d"] or 1), max(1, -(-size["n"] // rows_a_shard)), max(1, -(-size["q"] // rows_a_block))
    whole = dim * (size["top"] or 0) ** 2 < 2**53
    if dim * (size["top"] or 0) ** 2 >= 2**63:
        raise ValueError("scores may pass 64 bits")
    holds = cut(packed(rows.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int")), "shard", dim))
    anchors = rows.where(F.pmod("vec_id", F.lit(every)) == 0).withColumn("block", F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(blocks)).cast("int"))

    def of_label(hold, ask, a, scores):
        rows = np.flatnonzero((hold["label"] == ask["label"][a]) & (hold["uid"] != ask["uid"][a]))
        yield 0, rows[first_places(scores[rows], positives)]

    found = past_shards(holds, packed(anchors, "block", dim), shards, blocks, dim, whole, of_label)
    place = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("n", F.row_number().over(place)).where(F.col("n") <= positives)
    # a score s is within the window if ceil(low * p / 100) <= s <= floor(high * p / 100); none is for a negative p
    upper = F.floor(F.expr(f"(cast(score as decimal(38,0)) * {high}) / 100")).cast("long")
    lower = F.ceil(F.expr(f"(cast(score as decimal(38,0)) * {low}) / 100")).cast("long")
    limits = cut(best.where("score >= 0").select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("n").alias("slot"), upper.alias("upper"), lower.alias("lower")))
    slots = limits.groupBy("anchor").agg(F.sort_array(F.collect_list("upper"), asc=False).alias("uppers"), F.min("lower").alias("lowest"))
    asked = anchors.join(slots, F.col("anchor") == F.col("uid"))
    pad = F.array_repeat(F.element_at("uppers", -1), positives - F.size("uppers"))  # slots that hold nothing
    asked = asked.select("uid", "vec_id", "label", "v", "block", F.concat("uppers", pad, F.array("lowest")).alias("limits"))

    def by_slot(hold, ask, a, scores):
        limits = ask["limits"].reshape(-1, positives + 1)[a]
        rows = np.flatnonzero((hold["label"] != ask["label"][a]) & (scores <= limits[0]) & (scores >= limits[-1]))
        some = scores[rows]
        for s in range(positives):
            low_end = limits[s + 1] if s + 1 < positives else None
            inside = rows[(some <= limits[s]) & (some > low_end)] if low_end is not None else rows[some <= limits[s]]
            if len(inside):
                yield s + 1, inside[first_places(scores[inside], negatives)]

    held = past_shards(holds, packed(asked, "block", dim, "limits"), shards, blocks, dim, whole, by_slot)
    place = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    held = held.withColumn("n", F.row_number().over(place)).where(F.col("n") <= negatives)
    down = held.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id", "slot"))).alias("down"))
    inside = F.filter("down", lambda r: (r.slot >= F.col("slot")) & (-r.minus >= F.col("lower")))
    taken = limits.join(down, "anchor").select("anchor", "positive_id", "positive_score", F.posexplode(F.slice(inside, 1, negatives)).alias("i", "r"))
    ids = anchors.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return taken.join(ids, "anchor").select("anchor_id", "positive_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("r.vec_id").alias("negative_id"), "positive_score", (-F.col("r.minus")).alias("negative_score"))
