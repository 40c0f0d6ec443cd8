"""Connected components: stretches of links become forests in tasks, alternating large-star and small-star rounds unite those."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _star(links: DataFrame) -> DataFrame:
    """Links each node's partners above it (and itself) to the least node that it touches.

    ``links``: (u, v), each link once for the end that acts.  The minimum is pre-aggregated before the
    shuffle, and a node with very many links is split by the skewed join.
    """
    least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = links.join(least, "u")
    out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _forests(links: DataFrame, stretch: int) -> DataFrame:
    """(a, b): every node of each ``stretch`` links of a partition, and the least node that those links join it to (maybe itself)."""

    def run(batches):
        import pyarrow as pa

        held, n = [], 0

        def flush():
            told = forest(*(np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("a", "b")))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in told], ["a", "b"])

        for batch in batches:
            while batch.num_rows:
                take = min(stretch - n, batch.num_rows)
                held.append(batch.slice(0, take))
                batch = batch.slice(take)
                n += take
                if n == stretch:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    return links.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, rounds: int = 60, stretch: int = 1 << 18) -> DataFrame:
    """(node, component) for every node that has a link; component: the smallest node reachable.

    ``edges``: two long columns.  Loops, null ends and repeated links are ignored; no links give no rows.  Each ``stretch`` of links becomes
    a forest in a task.  Where there is more than one, rounds unite them: each costs the driver and the disk some ten stages,
    however few its links.  After each round the links are cut into the shared folder; only their number and hash come to the driver.
    The number of rounds grows with the logarithm of the longest path; it is an error if ``rounds`` don't suffice.
    """
    a, b = edges.columns
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(f"`{a}` is not null and `{b}` is not null and `{a}` <> `{b}`").distinct()
    links, last = cut(links), None
    stretches = -(-links.count() // stretch)
    if not stretches:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    forests = _forests(links.coalesce(stretches), stretch)
    if stretches == 1:
        return cut(forests).select(F.col("a").alias("node"), F.col("b").alias("component"))
    links = cut(forests.where("a <> b").distinct())
    for _ in range(rounds):
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        upper = both.join(large, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        links = cut(_star(upper.select(F.col("a").alias("u"), F.col("b").alias("v"))))
        mark = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == last:
            break
        last = mark
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node it reaches) for the nodes of local links: as many rows as nodes, not as links."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new
