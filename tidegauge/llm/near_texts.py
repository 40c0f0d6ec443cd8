"""Near-duplicate texts by an exact candidate rule and exact shingle similarity.

Two texts are linked if the Jaccard similarity of their sets of five-word shingles is 0.8 or more.  Sets that
similar share a shingle among the first ``n - ceil(0.8 n) + 1`` of each in any common order (rarest first here),
so every link meets in some prefix shingle.  What meets is cut only by bounds that no link can break, and what
is linked is verified on whole texts before anything is thinned.

SimHash fingerprints come first: texts whose fingerprints are near are verified and grouped, and the prefix rule looks only for
links between texts that this has not brought together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, id_and_text, row_keys, slices, stored
from .components import components
from .simhash import fingerprints, links_within

def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(w: list[bytes], words: int) -> np.ndarray:
    """Distinct hashes of the shingles of ``words`` words (fewer words: of the whole sequence; none: no hash)."""
    import xxhash

    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    if not len(h):
        return h
    width = min(words, len(h))
    z = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        z = (z ^ h[k : len(h) - width + 1 + k]) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(32)
    return np.unique(z)


def _small_side(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """``df`` (a few longs a row) cut, and broadcast only if it has at most ``rows`` rows."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= rows else df


def _alike(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sets (sorted, distinct) have the Jaccard similarity; two empty ones do."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= similarity * (len(x) + len(y) - common) - 1e-9


def plausible(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that the wide parity bits (node, n, wide) don't rule out: no pair of the similarity is."""
    apart = (1 - similarity) / (1 + similarity)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sizes = zip(batch.column("na").to_pylist(), batch.column("nb").to_pylist())
            keep = []
            for (n, m), x, y in zip(sizes, batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                small = min(len(x), len(y))
                odd = np.bitwise_xor.reduce(x.reshape(-1, small)) ^ np.bitwise_xor.reduce(y.reshape(-1, small))
                keep.append(int(np.bitwise_count(odd).sum()) <= (n + m) * apart + 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda k, v: sketches.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("wide").alias(v))
    return pairs.join(side("b", "y"), "b").join(side("a", "x"), "a").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose whole texts (node, text) have the similarity.

    Texts move, not their shingles, as they are shorter; the text of ``a``, which many pairs share, moves once.
    """

    def run(batches):
        import pyarrow as pa

        last, held = None, None
        for batch in batches:
            for part in slices(batch, "y"):
                keep = []
                for a, x, y in zip(part.column("a").to_pylist(), part.column("x").to_pylist(), part.column("y").to_pylist()):
                    if a != last or held is None:
                        last, held = a, shingles(_words(x), words)
                    keep.append(_alike(held, shingles(_words(y), words), similarity))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = cut(pairs)
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    some = texts.join(_small_side(ends), "node", "left_semi")
    side = lambda k, v: some.select(F.col("node").alias(k), F.col("text").alias(v))
    return pairs.join(side("b", "y"), "b").join(side("a", "x"), "a").mapInArrow(run, "a long, b long")


def by_fingerprint(texts: DataFrame, words: int, similarity: float, radius: int = 3) -> DataFrame:
    """(a, b): verified links of the texts (node, text) whose SimHash fingerprints differ in at most ``radius`` bits.

    A fingerprint stands by its least node: its other texts are held against that one, and near fingerprints' least nodes against each other.
    A pair that isn't similar is dropped here; what its texts are linked to otherwise is for the prefix rule to find.
    """
    fps = cut(fingerprints(texts.select(F.col("node").alias("doc_id"), "text")).select(F.col("doc_id").alias("node"), "fp"))
    least = cut(fps.groupBy("fp").agg(F.min("node").alias("first")))
    alike = fps.join(least, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    end = lambda k: least.select(F.col("fp").alias(k), F.col("first").alias(f"first_{k}"))
    near = links_within(least.select("fp"), radius).join(end("a"), "a").join(end("b"), "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    pairs = alike.union(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    return verified(pairs, texts, words, similarity)


def _frequent(texts: DataFrame, words: int, least: int = 4, most: int = 200_000) -> np.ndarray:
    """Shingles that at least ``least`` texts of every sixteenth have, the most frequent last.

    They only settle the order of shingles, and so the work, not what is found.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                for t in part.column("text").to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array(shingles(_words(t), words).view(np.int64))], ["key"])

    counted = texts.where(F.pmod("node", F.lit(16)) == 0).mapInArrow(run, "key long").groupBy("key").agg(F.count("*").alias("n"))
    top = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "key").limit(most).select("key").toArrow()
    return top.column("key").to_numpy()[::-1].copy()


#: Longs of the parity bits of a text's shingles.
PARITY = 8


def _parity(z: np.ndarray) -> np.ndarray:
    """Bit k: whether an odd number of the shingles falls to it.  Two sets differ in at least as many shingles as in bits."""
    odd = np.bincount((z % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def _wide_parity(z: np.ndarray) -> bytes:
    """Parity bits, at least twice as many as shingles; halves folded onto each other give those of half as many."""
    width = 64 * PARITY
    while width < 2 * len(z):
        width *= 2
    odd = np.bincount((z & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def prefixes(texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """key, node, salt, n: the prefix shingles of every text (node, text) that more than one may have, and a row of salt -1 a text with its number of shingles, its parity bits and the wide ones."""
    frequent = _frequent(texts, words).view(np.uint64)
    place = np.argsort(frequent)
    known = frequent[place]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                keys, salts, nodes, sizes, bits, wide = [], [], [], [], [], []
                for node, text in zip(part.column("node").to_pylist(), part.column("text").to_pylist()):
                    z = shingles(_words(text), words)
                    n = len(z)
                    rank = np.zeros(n, np.int64)
                    if n and len(known):
                        at = np.minimum(np.searchsorted(known, z), len(known) - 1)
                        rank = np.where(known[at] == z, place[at] + 1, 0)
                    first = np.argsort(rank, kind="stable")[: n - int(np.ceil(similarity * n - 1e-9)) + 1]
                    keys += [z[first].view(np.int64) if n else np.zeros(1, np.int64), [node]]
                    salts += [np.where(rank[first] > 0, node % 64, 64) if n else [64], [-1]]
                    nodes.append(np.full(len(keys[-2]) + 1, node))
                    sizes.append(np.full(len(keys[-2]) + 1, n, np.int32))
                    bits += [None] * len(keys[-2]) + [_parity(z).tobytes()]
                    wide += [None] * len(keys[-2]) + [_wide_parity(z)]
                columns = [np.concatenate(keys), np.concatenate(nodes), np.concatenate(salts).astype(np.int32), np.concatenate(sizes)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(bits, pa.binary()), pa.array(wide, pa.binary())], ["key", "node", "salt", "n", "bits", "wide"])

    def shared(batches):
        """Without the shingles that one text only has (those known as frequent, dealt out by salt, all stay) and repeated rows."""
        import pyarrow as pa

        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            key = rows.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            held = rows.slice(last).combine_chunks().to_batches()[0] if len(key) else held
            if last:
                yield from kept(rows.slice(0, last))
        if held is not None and held.num_rows:
            yield from kept(pa.Table.from_batches([held]))

    def kept(rows):
        key, node, salt = (rows.column(c).to_numpy() for c in ("key", "node", "salt"))
        order = np.lexsort((node, salt, key))
        key, node, salt = key[order], node[order], salt[order]
        again = np.concatenate([[False], (key[1:] == key[:-1]) & (node[1:] == node[:-1]) & (salt[1:] == salt[:-1])])
        order, key, salt = order[~again], key[~again], salt[~again]
        alike = (key[1:] == key[:-1]) & (salt[1:] == 64) & (salt[:-1] == 64)
        stays = np.concatenate([[False], alike]) | np.concatenate([alike, [False]]) | (salt < 64)
        return rows.take(order[stays]).combine_chunks().to_batches()

    fields = "key long, node long, salt int, n int, bits binary, wide binary"
    return texts.mapInArrow(run, fields).repartition("key", "salt").sortWithinPartitions("key").mapInArrow(shared, fields)


def _meeting(similarity: float, few: int, labelled: bool):
    """Task function over rows sorted by ``work``: pairs of each run of equal ``work`` that no bound rules out.

    Without labels, a run of more than ``few`` gives links that span what may be similar, and its ``work`` is
    told; with labels, every pair of unlike labels.
    """
    apart = (1 - similarity) / (1 + similarity)

    def may(n, bits, i, j):
        a, b = n[i], n[j]
        fits = np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-9
        return fits & (np.bitwise_count(bits[i] ^ bits[j]).sum(axis=-1, dtype=np.int64) <= (a + b) * apart + 1e-9)

    def spanned(n, bits):
        left, queue, a, b = np.arange(len(n)), [], [], []
        while len(left):
            if not queue:
                queue, left = [int(left[0])], left[1:]
            at = queue.pop()
            near = may(n, bits, at, left)
            new = left[near]
            a.append(np.full(len(new), at))
            b.append(new)
            queue += new.tolist()
            left = left[~near]
        return np.concatenate(a), np.concatenate(b)

    def found(work, node, n, bits, label):
        import pyarrow as pa

        def out(i, j, told=None):
            told = np.zeros(len(i), np.int64) if told is None else told
            a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(told)], ["a", "b", "work"])

        starts = np.flatnonzero(np.concatenate([[True], work[1:] != work[:-1]]))
        sizes = np.diff(np.append(starts, len(work)))
        if labelled:
            for lo, size in zip(starts.tolist(), sizes.tolist()):
                for i in range(lo, lo + size - 1):
                    j = i + 1 + np.flatnonzero(label[i + 1 : lo + size] != label[i])
                    j = j[may(n, bits, i, j)] if len(j) else j
                    if len(j):
                        yield out(np.full(len(j), i), j)
            return
        for size in range(2, few + 1):
            of = starts[sizes == size]
            for x, y in zip(*np.triu_indices(size, 1)):
                near = of[may(n, bits, of + x, of + y)] if len(of) else of
                if len(near):
                    yield out(near + x, near + y)
        for lo, size in zip(starts[sizes > few].tolist(), sizes[sizes > few].tolist()):
            a, b = spanned(n[lo : lo + size], bits[lo : lo + size])
            if len(a):
                yield out(lo + a, lo + b, np.full(len(a), work[lo]))

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("work", "node", "n")]
            rows[2] = rows[2].astype(np.int64)
            rows.append(np.frombuffer(b"".join(batch.column("bits").to_pylist()), "<u8").reshape(-1, PARITY))
            rows.append(batch.column("label").to_numpy() if labelled else rows[1])
            rows = [np.concatenate(x) for x in zip(held, rows)] if held else rows
            last = int(np.searchsorted(rows[0], rows[0][-1]))  # the last run may go on in the next batch
            held = [x[last:] for x in rows]
            if last:
                yield from found(*[x[:last] for x in rows])
        if held:
            yield from found(*held)

    return run


def linked(texts: DataFrame, words: int, similarity: float, block: int = 2048, few: int = 16, known: DataFrame | None = None) -> DataFrame:
    """(a, b): verified links of the texts (node, text) that leave the same groups as all links do.

    A shingle of more than ``block`` prefixes is cut into blocks by hash, and each pair of blocks is a piece of
    work.  Pieces of more than ``few`` texts are spanned first; once that is verified, every pair in them that
    it has not brought together is compared too, so nothing is lost to the thinning.  Links ``known`` (a, b; verified)
    are part of what is returned, and pairs within their groups aren't verified again.
    """
    laid = stored(prefixes(texts, words, similarity), "prefixes")
    info = _small_side(laid.where("salt < 0").select("node", "n", "bits").dropDuplicates(["node"]), 100_000)
    meets = laid.where("salt >= 0").select("key", "node")
    large = laid.where("salt >= 0").groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > block)
    large = _small_side(large.select("key", F.ceil(F.col("rows") / block).cast("int").alias("blocks")))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.when(F.col("blocks") > 1, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(-1)))
    work = F.when(F.col("other") < 0, F.col("key")).otherwise(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")))
    pieces = meets.join(large, "key", "left").select("key", "node", mine.alias("mine"), F.explode(other).alias("other")).select(work.alias("work"), "node")
    fields = "a long, b long, work long"
    first = cut(pieces.join(info, "node").repartition("work").sortWithinPartitions("work", "node").mapInArrow(_meeting(similarity, few, False), fields).distinct())
    sketches = laid.where("salt < 0").select("node", "n", "wide").dropDuplicates(["node"])
    checked = lambda pairs: verified(plausible(pairs, sketches, similarity), texts, words, similarity)
    asked = first.select("a", "b").distinct()
    if known is not None:
        known = cut(known)
        group = _small_side(components(known).select("node", F.col("component").alias("group")))
        of = lambda k: group.select(F.col("node").alias(k), F.col("group").alias(f"of_{k}"))
        asked = asked.join(of("a"), "a", "left").join(of("b"), "b", "left").where("of_a is null or of_b is null or of_a <> of_b").select("a", "b")
    sure = checked(asked)
    sure = cut(sure if known is None else sure.union(known))
    thinned = _small_side(first.where("work <> 0").select("work").distinct())
    named = _small_side(components(sure).select("node", F.col("component").alias("label")))
    rest = pieces.join(thinned, "work", "left_semi").join(info, "node").join(named, "node", "left").withColumn("label", F.coalesce("label", "node"))
    second = cut(rest.repartition("work").sortWithinPartitions("work", "node").mapInArrow(_meeting(similarity, few, True), fields).select("a", "b").distinct())
    return sure.union(checked(second))


def groups(keyed: DataFrame, words: int = 5, similarity: float = 0.8, block: int = 2048, few: int = 16) -> DataFrame:
    """doc_id, __k1, __k2 and component_id of every row of ``keyed`` (see ``common.row_keys``).

    Equal texts (null: empty) are one node, told apart by 128 bits of hash, so any number of copies costs one entry; texts without
    words, whatever their white space, are linked.  component_id is the smallest non-null doc_id of the group
    (null if it has none); an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = cut(keyed.select("doc_id", "__k1", "__k2", F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")))
    once = rows.groupBy("h1", "h2", "__k1", "__k2").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("times"))
    distinct = once.groupBy("h1", "h2").agg(F.min("first_id").alias("first_id"), F.min(F.struct("__k1", "__k2", "times")).alias("k"))
    again = F.row_number().over(Window.partitionBy("h1").orderBy("h2")) > 1  # unlike texts of one first hash
    distinct = cut(distinct.withColumn("node", F.when(again, F.xxhash64("h1", "h2")).otherwise(F.col("h1"))))
    texts = keyed.select("text", "__k1", "__k2").join(_small_side(distinct.select("node", "k.*")), ["__k1", "__k2"]).select("node", "text", "times")
    texts = texts.where("times = 1").union(texts.where("times > 1").dropDuplicates(["node"])).drop("times")  # a repeated row once
    comp = components(linked(texts, words, similarity, block, few, by_fingerprint(texts, words, similarity)))
    classed = distinct.select("h1", "h2", "node", "first_id").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = classed.join(classed.groupBy("component").agg(F.min("first_id").alias("component_id")), "component").select("h1", "h2", "component_id")
    return rows.join(named, ["h1", "h2"]).select("doc_id", "__k1", "__k2", "component_id")


def dedup(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest doc_id.

    Of rows with that same doc_id, the one of the least content key stays; other columns, whatever their
    names, are kept as they are.
    """
    columns = docs.columns
    keyed = row_keys(docs, columns)
    placed = groups(keyed, words, similarity)
    group_key = F.coalesce(F.col("component_id"), F.lit(-(2**63)))
    best = placed.groupBy(group_key.alias("g")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__k1", "__k2")).alias("best"))
    keep = best.select(F.col("best.__k1").alias("__k1"), F.col("best.__k2").alias("__k2"))
    repeated = placed.groupBy("__k1", "__k2").agg(F.count("*").alias("n")).where("n > 1").select("__k1", "__k2")
    rows = keyed.join(keep, ["__k1", "__k2"], "left_semi").join(repeated.withColumn("__again", F.lit(True)), ["__k1", "__k2"], "left")
    once = rows.where("__again is null").select(*[f"`{c}`" for c in columns])
    return once.unionByName(rows.where("__again").dropDuplicates(["__k1", "__k2"]).select(*[f"`{c}`" for c in columns]))
