"""Vectors in shards: hierarchical small-world graphs for near-duplicates, the threshold algorithm for exact top-k.

Both lay every vector into a shard by hash of its id, so a shard's size is bounded by a parameter.  A shard
moves to one task, and blocks of queries are streamed past it; nothing larger than
a block and a shard is ever in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, streamed
from .components import components, forest


def usable(vectors: DataFrame, keep_zero: bool) -> DataFrame:
    """vec_id and v (array<double>): without null ids, null or empty arrays, null or non-finite components."""
    v = F.col("embedding").cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & whole
    if not keep_zero:
        ok = ok & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(ok)


def shard_rows(rows: DataFrame, key: str, dim: int, finish=None) -> DataFrame:
    """One row a value of ``key``: its ids and uids (int64), vectors (zeros up to ``dim``) and row weights ``n`` as binaries.

    Vectors are held in single precision where that is exact.  ``finish`` turns the matrix into an index.
    """

    def pack(table):
        import pyarrow as pa

        table = table.sort_by([(c, "ascending") for c in ("vec_id", "uid") if c in table.column_names])
        ids = table.column("vec_id").to_numpy()
        lists = table.column("v").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        if (sizes == dim).all():
            x = lists.flatten().to_numpy().reshape(-1, dim)
        else:
            x = np.zeros((len(ids), dim))
            x[np.arange(dim)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
        longs = [table.column(c).to_numpy() if c in table.column_names else like for c, like in (("uid", ids), ("n", np.ones(len(ids), np.int64)))]
        with np.errstate(over="ignore"):
            single = x.astype(np.float32)
        exact = bool((single == x).all())
        held = [c.astype("<i8").tobytes() for c in (ids, *longs)] + [np.ascontiguousarray(single if exact else x).tobytes(), finish(x) if finish else b""]
        named = {c: pa.array([v], pa.binary()) for c, v in zip(("ids", "uid", "weight", "x", "extra"), held)}
        return pa.table({key: pa.array([table.column(key)[0].as_py()], pa.int32()), **named, "width": pa.array([4 if exact else 8], pa.int32())})

    return rows.groupBy(key).applyInArrow(pack, f"{key} int, ids binary, uid binary, weight binary, x binary, extra binary, width int")


def _unpack(row: dict, dim: int):
    """ids, vectors in double precision, weights, uids."""
    one = lambda name: np.frombuffer(row[name], "<i8")
    return one("ids"), np.frombuffer(row["x"], f"<f{row['width']}").astype(float).reshape(-1, dim), one("weight"), one("uid") if "uid" in row else None


def _angle(cosine):
    return np.arccos(np.clip(cosine, -1, 1))


class SmallWorld:
    """A hierarchical navigable small-world graph over vectors, for links of cosine ``least`` or more.

    Vectors are inserted in random order, in batches of at most as many as are there (4096 at most): each is sought in the graph so
    far, takes links to diverse nodes of its beam and of its own batch, and gives links back.  A node is in level k
    with chance m**-k.  A vector within half the links' angle of a node becomes that node's member and no node of its own,
    so a group of near copies, however large, is one node, all of whose members are linked to each other.  Searches run in lockstep for many queries.
    """

    def __init__(self, x: np.ndarray, least: float, m: int = 24, ef: int = 32, seed: int = 5):
        self.least, self.m = least, m
        self.half = _angle(least) / 2
        unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
        n, rng = len(unit), np.random.default_rng(seed)
        order, level_of_row = rng.permutation(n), np.floor(-np.log(1 - rng.random(n)) / np.log(m)).astype(int)
        self.nodes = np.zeros(n, np.int64)  # the row of each node
        self.x = np.zeros_like(unit)
        self.links = [np.full((n, 2 * m), -1, np.int32)]
        self.top, self.count, self.of = 0, 0, np.full(n, -1, np.int64)
        join, at = np.cos(self.half) + 1e-5, 0
        while at < n:
            rows = order[at : at + min(4096, max(256, self.count))]
            at += len(rows)
            q = unit[rows]
            beams = self._descend(q, ef, 8) if self.count else []
            if beams:
                ids, sims = beams[0]
                best = sims.argmax(axis=1)
                best_sim = sims[np.arange(len(rows)), best]
                self.of[rows] = np.where(best_sim >= join, ids[np.arange(len(rows)), best], -1)
            open_ = np.flatnonzero(self.of[rows] < 0)
            near = q[open_] @ q[open_].T
            leads = self._lead(near >= join)
            alone = np.flatnonzero(leads == np.arange(len(leads)))
            number = np.full(len(leads), -1, np.int64)
            number[alone] = self.count + np.arange(len(alone))
            self.of[rows[open_]] = number[leads]
            new, new_rows = number[alone], rows[open_][alone]
            self.nodes[new], self.x[new] = new_rows, unit[new_rows]
            self.count += len(new)
            near = near[np.ix_(alone, alone)]
            np.fill_diagonal(near, -9)
            for level in range(int(level_of_row[new_rows].max(initial=0)) + 1):
                if level >= len(self.links):
                    self.links.append(np.full((n, m), -1, np.int32))
                mine = np.flatnonzero(level_of_row[new_rows] >= level)
                found = beams[level][0][open_][alone][mine] if level < len(beams) else np.full((len(mine), 1), -1)
                k = min(8, len(mine) - 1)
                if k > 0:
                    own = near[np.ix_(mine, mine)]
                    found = np.concatenate([found, new[mine][np.argpartition(-own, k - 1, axis=1)[:, :k]]], axis=1)
                if found.shape[1]:
                    self._insert(level, new[mine], found)
            self.top = max((k for k in range(len(self.links)) if (level_of_row[self.nodes[: self.count]] >= k).any()), default=0)
        self.entry = [np.flatnonzero(level_of_row[self.nodes[: self.count]] >= k)[:4] for k in range(self.top + 1)]
        self._finish(x)

    @staticmethod
    def _lead(near: np.ndarray) -> np.ndarray:
        """For each row the row that it joins: itself, or the first leader near it."""
        out = np.arange(len(near))
        free = np.ones(len(near), bool)
        for i in np.flatnonzero(near.sum(axis=1) > 1):
            if free[i]:
                joins = near[i] & free
                joins[: i + 1] = False
                out[joins], free[joins] = i, False
        return out

    def _finish(self, x: np.ndarray) -> None:
        """The members of each node and the largest angle between them and it."""
        c = self.count
        self.nodes, self.x = self.nodes[:c], self.x[:c]
        self.links = [k[:c] for k in self.links[: self.top + 1]]
        self.members = np.argsort(self.of, kind="stable")
        self.size = np.bincount(self.of, minlength=c)
        self.first = np.cumsum(self.size) - self.size
        self.far = np.zeros(c)
        norm = np.linalg.norm(x, axis=1)
        for lo in range(0, len(x), 65536):
            r = np.arange(lo, min(len(x), lo + 65536))
            lead = self.nodes[self.of[r]]
            angle = np.where(lead == r, 0.0, _angle(np.einsum("nd,nd->n", x[r], x[lead]) / (norm[r] * norm[lead])))
            np.maximum.at(self.far, self.of[r], angle)

    def _insert(self, level: int, new: np.ndarray, found: np.ndarray) -> None:
        """Links between new nodes and the diverse ones of ``found``, both ways; what a node can't hold it chooses anew."""
        links, m = self.links[level], self.m
        out = self._choose(new, found, m)
        links[new, :m] = out
        a, b = np.repeat(new, m), out.ravel().astype(np.int64)
        a, b = a[b >= 0], b[b >= 0]
        order = np.argsort(b, kind="stable")
        a, b = a[order], b[order]
        ends, first, n = np.unique(b, return_index=True, return_counts=True)
        width = links.shape[1]
        for lo in range(0, len(ends), 1024):
            e, f, c = ends[lo : lo + 1024], first[lo : lo + 1024], np.minimum(n[lo : lo + 1024], 64)
            more = np.where(np.arange(c.max())[None, :] < c[:, None], a[np.minimum(f[:, None] + np.arange(c.max())[None, :], len(a) - 1)], -1)
            both = np.concatenate([links[e], more], axis=1)
            both = np.where((both[:, :, None] == both[:, None, :]).argmax(axis=2) < np.arange(both.shape[1])[None, :], -1, both)
            both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
            fits = (both >= 0).sum(axis=1) <= width
            links[e[fits]] = both[fits, :width]
            if not fits.all():
                links[e[~fits]] = self._choose(e[~fits], both[~fits], width)

    def _choose(self, base: np.ndarray, cand: np.ndarray, m: int) -> np.ndarray:
        """Up to ``m`` of each node's candidates: those nearer to it than to any chosen before, then the nearest others."""
        cand = np.sort(cand, axis=1)
        twice = np.zeros(cand.shape, dtype=bool)
        twice[:, 1:] = cand[:, 1:] == cand[:, :-1]
        cand = np.where(twice | (cand == base[:, None]), -1, cand)
        s = (self.x[np.maximum(cand, 0)] @ self.x[base][:, :, None])[:, :, 0]
        s[cand < 0] = -9
        near = np.argsort(-s, axis=1, kind="stable")[:, : 2 * m]
        cand, s = np.take_along_axis(cand, near, axis=1), np.take_along_axis(s, near, axis=1)
        y = self.x[np.maximum(cand, 0)]
        between = y @ y.transpose(0, 2, 1)
        r, c = cand.shape
        kept = np.zeros((r, c), dtype=bool)
        for k in range(c):
            worst = np.where(kept[:, :k], between[:, k, :k], -9).max(axis=1) if k else np.full(r, -9.0)
            kept[:, k] = (worst < s[:, k]) & (cand[:, k] >= 0) & (kept.sum(axis=1) < m)
        rank = np.argsort(np.where(kept, 0, 1) * c + np.arange(c)[None, :], axis=1)[:, :m]
        chosen = np.take_along_axis(cand, rank, axis=1)
        if chosen.shape[1] < m:
            chosen = np.pad(chosen, ((0, 0), (0, m - chosen.shape[1])), constant_values=-1)
        return chosen.astype(np.int32)

    def to_bytes(self) -> bytes:
        import pickle

        small = np.int16 if self.count < 2**15 else np.int32
        return pickle.dumps((self.least, self.m, self.nodes.astype(np.int32), self.of.astype(np.int32), [k.astype(small) for k in self.links], self.top, self.entry), protocol=4)

    @classmethod
    def from_bytes(cls, x: np.ndarray, blob: bytes) -> SmallWorld:
        import pickle

        out = cls.__new__(cls)
        out.least, out.m, nodes, of, links, out.top, out.entry = pickle.loads(blob)
        out.nodes, out.of, out.links = nodes.astype(np.int64), of.astype(np.int64), links
        out.count, out.half = len(nodes), _angle(out.least) / 2
        led = x[out.nodes]
        out.x = (led / np.linalg.norm(led, axis=1, keepdims=True)).astype(np.float32)
        out._finish(x)
        return out

    def _beam(self, q: np.ndarray, level: int, entry: np.ndarray, beam: int, step: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` nodes found for each query and their similarities."""
        x, links, n, b = self.x, self.links[level], self.count, len(q)
        beam = min(beam, n)
        step = step or max(4, beam // 8)
        seen = np.zeros((b, n), dtype=bool)
        ids = np.full((b, beam), -1, dtype=np.int64)
        sims = np.full((b, beam), -9, dtype=np.float32)
        done = np.ones((b, beam), dtype=bool)

        def add(new, alive):
            nonlocal ids, sims, done
            new_s = (x[np.maximum(new, 0)] @ q[alive][:, :, None])[:, :, 0]
            new_s[new < 0] = -9
            all_s = np.concatenate([sims[alive], new_s], axis=1)
            top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam] if all_s.shape[1] > beam else np.argsort(-all_s, axis=1)
            ids[alive] = np.take_along_axis(np.concatenate([ids[alive], new], axis=1), top, axis=1)[:, :beam]
            sims[alive] = np.take_along_axis(all_s, top, axis=1)[:, :beam]
            done[alive] = np.take_along_axis(np.concatenate([done[alive], new < 0], axis=1), top, axis=1)[:, :beam]

        def fresh(new, alive):
            """Without what was seen, and each node once a query."""
            new = np.sort(new, axis=1)
            again = np.zeros(new.shape, dtype=bool)
            again[:, 1:] = new[:, 1:] == new[:, :-1]
            new = np.where(again | (new < 0) | seen[alive[:, None], np.maximum(new, 0)], -1, new)
            r, c = np.nonzero(new >= 0)
            seen[alive[r], new[r, c]] = True
            return new

        everyone = np.arange(b)
        add(fresh(entry, everyone), everyone)
        while True:
            open_s = np.where(done, -9, sims)
            alive = np.flatnonzero((~done).any(axis=1))
            if not len(alive):
                break
            k = min(step, beam)
            pick = np.argpartition(-open_s[alive], k - 1, axis=1)[:, :k]
            ok = np.take_along_axis(open_s[alive], pick, axis=1) > -9
            done[alive[:, None], pick] |= ok
            from_ = np.where(ok, np.take_along_axis(ids[alive], pick, axis=1), -1)
            new = np.where(from_[:, :, None] >= 0, links[np.maximum(from_, 0)], -1).reshape(len(alive), -1).astype(np.int64)
            add(fresh(new, alive), alive)
        return ids, sims

    def _descend(self, q: np.ndarray, beam: int, upper: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The beams of all levels, the lowest first."""
        parts = []
        for lo in range(0, len(q), 256):
            part, out = q[lo : lo + 256], []
            entry = self.entry[-1] if hasattr(self, "entry") else np.flatnonzero((self.links[self.top][: self.count] >= 0).any(axis=1))[:4]
            entry = np.tile(entry if len(entry) else np.arange(min(4, self.count)), (len(part), 1))
            for level in range(self.top, -1, -1):
                out.append(self._beam(part, level, entry, beam if level == 0 else upper))
                entry = out[-1][0]
            parts.append(out[::-1])
        wide = lambda arrays, fill: np.concatenate([np.pad(a, ((0, 0), (0, max(x.shape[1] for x in arrays) - a.shape[1])), constant_values=fill) for a in arrays])
        return [(wide([p[k][0] for p in parts], -1), wide([p[k][1] for p in parts], -9)) for k in range(self.top + 1)]

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and similarities of the best ``beam`` found for each unit query; a beam as wide as the graph holds every node."""
        if beam >= self.count:
            return np.tile(np.arange(self.count), (len(q), 1)), q @ self.x.T
        return self._descend(q, beam, 8)[0]


def audited_beam(index: SmallWorld, x: np.ndarray, q: np.ndarray, recall: float = 0.9997, probes: int = 256, seed: int = 0) -> tuple[int, int, int]:
    """The beam at which an audit passes, and the links that the probes have and that were lost.

    Probes are queries drawn from ``q``, the very vectors that ask this shard; each one's links to all of ``x`` are counted by brute force, and by
    ``linked``.  The beam is doubled until ``recall`` of all those links are found, at last up to the whole graph, which can miss nothing.
    """
    rows = np.random.default_rng(seed).permutation(len(q))[:probes]
    u, unit = q[rows] / np.linalg.norm(q[rows], axis=1, keepdims=True), np.linalg.norm(x, axis=1)
    true = sum(((u @ (x[lo : lo + 8192] / unit[lo : lo + 8192, None]).T) >= index.least).sum(axis=1) for lo in range(0, len(x), 8192))
    beam = 32
    while True:
        all_q, all_n, one_q, _ = linked(index, x, q[rows], beam)
        found = np.bincount(all_q, index.size[all_n], len(rows)) + np.bincount(one_q, minlength=len(rows))
        lost = int(np.maximum(true - found, 0).sum())
        if lost <= (1 - recall) * true.sum() or beam >= index.count:
            return beam, int(true.sum()), lost
        beam *= 2


def linked(index: SmallWorld, x: np.ndarray, q: np.ndarray, beam: int):
    """Links of queries to the vectors of a shard, as (query, node) with all the node's members, and (query, row).

    A query links with all members of a node if its angle to the node and the members' largest angle to it add up to no more than
    the links' angle, with none if their difference is larger; the members of the nodes between are verified one by one in double
    precision.  A query of whose beam over half the nodes may hold links is asked again with a beam four times as wide, for one node without
    links says little of those not met.
    """
    norm_q, norm_x = np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)
    unit, wide = (q / norm_q[:, None]).astype(np.float32), 2 * index.half
    slack = np.cos(np.minimum(np.pi, wide + index.far)) - 1e-4  # a node's cosine from which on a member may be linked
    all_q, all_n, one_q, one_r = [], [], [], []
    todo = np.arange(len(q))
    while len(todo):
        again = []
        for lo in range(0, len(todo), 1024 if beam < index.count else 64):
            part = todo[lo : lo + (1024 if beam < index.count else 64)]
            ids, sims = index.search(unit[part], beam)
            hit = (ids >= 0) & (sims >= slack[np.maximum(ids, 0)])
            full = (2 * hit.sum(axis=1) > (ids >= 0).sum(axis=1)) & (beam < index.count)
            again.append(part[full])
            r, c = np.nonzero(hit & ~full[:, None])
            a, k = part[r], ids[r, c]
            lead = index.nodes[k]
            angle = _angle(np.einsum("nd,nd->n", q[a], x[lead]) / (norm_q[a] * norm_x[lead]))
            sure = angle + index.far[k] <= wide - 1e-7
            all_q.append(a[sure])
            all_n.append(k[sure])
            a, k = a[~sure], k[~sure]
            ends = np.cumsum(index.size[k])
            at = 0
            while at < len(a):  # about a million members at a time
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), side="right")))
                size = index.size[k[at:to]]
                who = np.repeat(a[at:to], size)
                place = np.repeat(index.first[k[at:to]] - np.cumsum(size) + size, size) + np.arange(size.sum())
                row = index.members[place]
                for x0 in range(0, len(who), 65536):
                    i, j = who[x0 : x0 + 65536], row[x0 : x0 + 65536]
                    ok = np.einsum("nd,nd->n", q[i], x[j]) / (norm_q[i] * norm_x[j]) >= index.least
                    one_q.append(i[ok])
                    one_r.append(j[ok])
                at = to
        todo, beam = np.concatenate(again), beam * 4
    whole = lambda v: np.concatenate(v) if v else np.empty(0, dtype=np.int64)
    return whole(all_q), whole(all_n), whole(one_q), whole(one_r)


def near_duplicates(vectors: DataFrame, least: float = 0.9, rows_a_shard: int = 32_768, rows_a_block: int = 4096, with_recall: bool = False) -> DataFrame:
    """vec_id, n_links, component_id and kept for every vec_id; if asked also recall (the least of all pairs of block and shard) and audited (links).

    Equal vectors are one entry that counts as often as it has vec_ids.  Each shard of entries gets a graph, built once; the blocks of a
    shard's entries are streamed past each shard of no lower number.  Each such pair is audited with vectors of the block against brute
    force, and its beam widened until the audit passes (``audited_beam``).  What leaves a pair is a
    count an entry and a spanning forest of the links, not the links.  Vectors that can't be compared
    (null, empty, zero, null or non-finite components) link with nothing; shorter vectors count as ending in
    zeros; of a vec_id with several vectors that of the least content key counts; a null vec_id has no component.
    """
    keys = [F.xxhash64(F.lit(k), "v").alias(f"k{k}") for k in (1, 2)]
    good = usable(vectors, keep_zero=False).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).select("vec_id", "v", *keys)
    entry = good.groupBy("vec_id").agg(F.min(F.struct("k1", "k2")).alias("k")).select("vec_id", "k.k1", "k.k2")
    classes = cut(entry.groupBy("k1", "k2").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n")))
    size = good.agg(F.max(F.size("v")).alias("d")).first()
    dim, entries = size["d"] or 1, classes.count()
    shards = max(1, -(-entries // rows_a_shard))
    blocks = max(1, -(-entries // shards // rows_a_block))
    same = [good.vec_id == classes.first_id, good.k1 == classes.k1, good.k2 == classes.k2]
    rows = good.join(classes, same).select("vec_id", "v", "n").dropDuplicates(["vec_id"])
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    packed = cut(shard_rows(rows, "shard", dim, lambda x: SmallWorld(x, least).to_bytes()))

    def split(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                ids, x, weight, _ = _unpack(row, dim)
                for b in range(blocks):
                    held = [ids[b::blocks].tobytes(), weight[b::blocks].tobytes(), x[b::blocks].astype(f"<f{row['width']}").tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([row["shard"]], pa.int32()), pa.array([b], pa.int32()), *map(pa.array, ([h] for h in held)), pa.array([row["width"]], pa.int32())], ["i", "b", "ids", "weight", "x", "width"])

    parts = packed.mapInArrow(split, "i int, b int, ids binary, weight binary, x binary, width int")
    asks = parts.withColumn("shard", F.explode(F.sequence("i", F.lit(shards - 1)))).withColumn("block", F.col("i") * blocks + F.col("b")).drop("b")

    def opened(row):
        ids, x, weight, _ = _unpack(row, dim)
        index = SmallWorld.from_bytes(x, row["extra"])
        return row["shard"], ids, x, weight, index, np.bincount(index.of, weight, index.count)

    def answer(hold, row):
        import pyarrow as pa

        shard, ids, x, weight, index, held = hold
        ids_q, q, weight_q, _ = _unpack(row, dim)
        if not len(ids_q):
            return
        own = row["i"] == shard
        beam, true, lost = audited_beam(index, x, q)
        all_q, all_n, one_q, one_r = linked(index, x, q, beam)
        n_q = np.bincount(all_q, held[all_n], len(q)) + np.bincount(one_q, weight[one_r], len(q))
        if own:  # each entry asks in its own shard, so its links are counted on its side; it finds itself
            nodes, counts = ids_q, n_q - weight_q
        else:
            by_node = np.bincount(all_n, weight_q[all_q], index.count)[index.of] + np.bincount(one_r, weight_q[one_q], len(x))
            nodes, counts = np.concatenate([ids_q, ids]), np.concatenate([n_q, by_node])
        a, b = np.concatenate([ids_q[all_q], ids_q[one_q]]), np.concatenate([ids[index.nodes[all_n]], ids[one_r]])
        # a query that links with all members links them to their node
        led = np.flatnonzero(np.isin(index.of, all_n))
        a, b = np.concatenate([a, ids[led]]), np.concatenate([b, ids[index.nodes[index.of[led]]]])
        a, b = a[a != b], b[a != b]
        some = counts > 0
        nodes, counts = nodes[some], np.rint(counts[some]).astype(np.int64)
        ends, root = forest(a, b) if len(a) else (a, b)
        ends, root = np.concatenate([nodes, ends]), np.concatenate([nodes, root])
        counts = np.concatenate([counts, np.zeros(len(ends) - len(nodes), np.int64)])
        told = [*map(pa.array, (ends, counts, root)), *[pa.nulls(len(ends), pa.int64())] * 2]
        yield pa.RecordBatch.from_arrays(told, ["vec_id", "n", "root", "audited", "lost"])
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (None, None, None, true, lost)], ["vec_id", "n", "root", "audited", "lost"])

    found = cut(streamed(packed.drop("uid"), asks, shards, shards * blocks, opened, answer, "vec_id long, n long, root long, audited long, lost long"))
    counts = found.where("vec_id is not null").groupBy("vec_id").agg(F.sum("n").alias("others")).withColumnRenamed("vec_id", "first_id")
    comp = components(found.where("vec_id <> root").select("vec_id", "root")).select(F.col("node").alias("first_id"), "component")
    told = classes.join(counts, "first_id", "left").join(comp, "first_id", "left")
    n_links, component = F.coalesce("others", F.lit(0)) + F.col("n") - 1, F.coalesce("component", "first_id")
    told = entry.join(told.select("k1", "k2", n_links.alias("n_links"), component.alias("component_id")), ["k1", "k2"]).drop("k1", "k2")
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    out = every.join(told, "vec_id", "left").withColumn("component_id", F.coalesce("component_id", "vec_id")).withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    out = out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    if with_recall:
        recall = F.coalesce(F.min(F.when(F.col("audited") > 0, 1 - F.col("lost") / F.col("audited"))), F.lit(1.0))
        out = out.crossJoin(F.broadcast(found.agg(recall.alias("recall"), F.coalesce(F.sum("audited"), F.lit(0)).alias("audited"))))  # one row
    return out


def threshold_top(x: np.ndarray, ids: np.ndarray, uids: np.ndarray, order: np.ndarray, q: np.ndarray, own: int, k: int, first_depth: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Fagin's threshold algorithm: ids and scores of the best ``k`` rows of x for one query (whose own row is ``own`` among ``uids``).

    ``order`` sorts each column of x upwards.  A dimension's list is read from the end that helps the
    query; after each deepening all rows met are scored, and reading stops once the k-th score is above the bound
    of every row not met (a row that only ties could have a smaller id, so a tie reads on).
    """
    n = len(x)
    up, down = np.flatnonzero(q < 0), np.flatnonzero(q > 0)
    depth, met, score = 0, np.zeros(n, dtype=bool), np.empty(n, dtype=x.dtype)
    met_ids = np.empty(0, dtype=np.int64)
    if not len(up) and not len(down):
        met_ids, depth = np.arange(n), n
        score[:] = 0
    while depth < n:
        deeper = min(n, max(first_depth, 2 * depth))
        rows = np.concatenate([order[depth:deeper, up].ravel(), order[n - deeper : n - depth, down].ravel()])
        fresh = np.zeros(n, dtype=bool)
        fresh[rows] = True
        new = np.flatnonzero(fresh & ~met)
        score[new] = x[new] @ q
        met[new] = True
        met_ids = np.concatenate([met_ids, new])
        depth = deeper
        bound = x[order[depth - 1, up], up] @ q[up] + x[order[n - depth, down], down] @ q[down]
        others = met_ids[uids[met_ids] != own]
        if len(others) >= k and np.partition(score[others], len(others) - k)[len(others) - k] > bound:
            break
    others = met_ids[uids[met_ids] != own]
    best = others[np.lexsort((ids[others], -score[others]))[:k]]
    return ids[best], score[best]


def exact_top(vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0, rows_a_shard: int = 8192, rows_a_block: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best partners of each row whose vec_id ``every`` divides.

    Components become floor(scale * x), the score is their integer inner product (exact below 2**63); ties go to the smaller vec_id.  Vectors
    that are null, empty or hold null or non-finite components take no part; shorter ones end in zeros; a query's own row is no
    partner.  Rows of a repeated vec_id all count: each is a partner of the others, and each that asks gets ``k`` rows.  Each shard is sorted by
    dimension once and answers the blocks of queries that are streamed past it by the threshold algorithm; at most k rows a query and
    shard are merged.
    """
    good = usable(vectors, keep_zero=True).select(F.monotonically_increasing_id().alias("uid"), "vec_id", F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("double")).alias("v"))
    good = cut(good)
    asked = F.pmod("vec_id", F.lit(every)) == 0
    size = good.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"), F.count(F.when(asked, 1)).alias("q"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))).alias("top")).first()
    dim, shards, blocks = size["d"] or 1, max(1, -(-size["n"] // rows_a_shard)), max(1, -(-size["q"] // rows_a_block))
    whole = dim * (size["top"] or 0) ** 2 < 2**53  # then doubles are exact
    rows = good.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))
    queries = good.where(asked).withColumn("block", F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(blocks)).cast("int"))

    def orders(x):
        return np.argsort(x, axis=0, kind="stable").astype("<u2" if len(x) < 65536 else "<i4").tobytes()

    holds = shard_rows(rows, "shard", dim, orders)
    asks = shard_rows(queries, "block", dim).drop("extra").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def opened(row):
        ids, x, _, uids = _unpack(row, dim)
        order = np.frombuffer(row["extra"], "<u2" if len(x) < 65536 else "<i4").reshape(x.shape).astype(np.int64)
        return ids, uids, x if whole else x.astype(np.int64), order

    def answer(hold, row):
        import pyarrow as pa

        ids, uids, x, order = hold
        ids_q, q, _, uids_q = _unpack(row, dim)
        out = ([], [], [], [])
        for i, u, v in zip(ids_q.tolist(), uids_q.tolist(), q if whole else q.astype(np.int64)):
            best, score = threshold_top(x, ids, uids, order, v, u, k)
            for c, values in zip(out, ([u] * len(best), [i] * len(best), best, score.astype(np.int64))):
                c.append(np.asarray(values, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.empty(0, np.int64)) for c in out], ["uid", "query_id", "vec_id", "score"])

    found = streamed(holds, asks, shards, blocks, opened, answer, "uid long, query_id long, vec_id long, score long")
    place = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
