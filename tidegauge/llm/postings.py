"""A distributed positional inverted index, and exact phrase and proximity search in it.

The index is a stored table: one row a term and segment, with the places at which the term stands in the segment.  A segment is a stretch of
texts (about 16 MB), laid end to end with gaps no phrase can cross, so a place is one number for text and word.  A phrase goes
through its terms from the rarest of the corpus: each term's list, moved by the term's offset, is intersected with the
starts that are left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh_path, release
from .words import bytes_of, cut_words, gathered

WORD = ~bytes_of([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KINDS = "kind int, segment long, term string, n long, at binary, rows binary, first binary, doc_id long, row long"


@dataclass
class Index:
    """``postings``: segment, term, n, at (differences of places); ``parts``: a row a segment with the place, row and first
    word of each of its texts; ``rows``: row, doc_id, n (words) of every text."""

    postings: DataFrame
    parts: DataFrame
    rows: DataFrame
    overlap: int


def build(docs: DataFrame, overlap: int = 15, size: int = 1 << 24) -> Index:
    """Indexes every word of every text (null: no words), into the shared folder.

    Rows are told apart by a number of their own, so repeated or null doc_ids are texts like others.  A text above ``size`` bytes lies in several
    segments that share ``overlap`` words; phrases (with their slack) may have one word more.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def invert(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        names = [c.split()[0] for c in _KINDS.split(", ")]
        kinds = dict(zip(names, (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64())))

        def told(kind, k, **columns):
            full = {"kind": pa.array(np.full(k, kind, np.int32)), **columns}
            return pa.RecordBatch.from_arrays([full.get(c, pa.nulls(k, kinds[c])) for c in names], names)

        segment = row = TaskContext.get().partitionId() << 36
        for table in gathered(batches, size):
            ids, text = table.column("doc_id").combine_chunks(), table.column("text").combine_chunks()
            for lo, k, w in cut_words(text, WORD, np.zeros(256, bool), overlap, size):
                counts = np.bincount(w.row, minlength=k)
                heads = np.cumsum(counts) - counts
                start = heads + (overlap + 1) * np.arange(k)
                place = start[w.row] + np.arange(len(w.row)) - heads[w.row]
                first = np.zeros(k, np.int64)
                some = counts > 0
                first[some] = w.place[heads[some]]
                order = np.argsort(w.codes, kind="stable")
                at, n = place[order].astype(np.int32), np.bincount(w.codes, minlength=len(w.values))
                edges = np.concatenate([[0], np.cumsum(n)])
                steps = np.diff(at, prepend=np.int32(0))
                steps[edges[:-1]] = at[edges[:-1]]
                held = pa.py_buffer(steps.astype("<i4"))
                for x in range(0, len(n), 50_000):
                    y = min(len(n), x + 50_000)
                    lists = pa.Array.from_buffers(pa.binary(), y - x, [None, pa.py_buffer((4 * edges[x : y + 1]).astype(np.int32)), held])
                    yield told(0, y - x, segment=pa.array(np.full(y - x, segment)), term=w.values.slice(x, y - x), n=pa.array(n[x:y]), at=lists)
                own = (row + lo + np.arange(k)).astype("<i8")
                yield told(1, 1, segment=pa.array([segment]), at=pa.array([start.astype("<i8").tobytes()]), rows=pa.array([own.tobytes()]), first=pa.array([first.astype("<i8").tobytes()]))
                if w.last:
                    yield told(2, k, n=pa.array(first + counts), doc_id=ids.slice(lo, k), row=pa.array(own))
                segment += 1
            row += len(ids)
            del table, text
            release()

    path = fresh_path(docs.sparkSession, "postings")
    rows.mapInArrow(invert, _KINDS).write.option("compression", "zstd").parquet(path)
    of_kind = lambda k, *columns: docs.sparkSession.read.schema(_KINDS).parquet(path).where(F.col("kind") == k).select(*columns)
    return Index(of_kind(0, "segment", "term", "n", "at"), of_kind(1, "segment", F.col("at").alias("starts"), "rows", "first"), of_kind(2, "row", "doc_id", "n"), overlap)


def words_of(text: Column) -> Column:
    """Words of a text as the index has them."""
    return F.regexp_extract_all(F.translate(text, _CAPITALS, _SMALL), F.lit(_PATTERN), F.lit(0))


def windows(items: DataFrame, length: int = 10) -> DataFrame:
    """item_id and terms of each run of ``length`` words of an item; an item of fewer words (not none) is one run."""
    words = items.select("item_id", words_of("text").alias("w")).where("size(w) > 0")
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - length + 1)), lambda i: F.slice("w", i, F.lit(length)))
    return words.select("item_id", F.explode(runs).alias("terms"))


def search(index: Index, phrases: DataFrame, slack: int | None = None, phrases_a_block: int = 20_000, few_terms: int = 500_000) -> DataFrame:
    """row, item_ids, spans (lo, hi) of every text that holds one of the phrases (item_id, terms).

    Spans are those of the hits, united where they touch within a segment, in word numbers of the text.  With ``slack``, a phrase's distinct
    terms may stand in any order within its length plus ``slack`` words (proximity); a hit then spans the least stretch about each
    place of the rarest term.  Equal phrases are searched once; phrases with a term that the corpus lacks can't be found and aren't asked.
    Phrases meet each segment in blocks of ``phrases_a_block``, with the lists of their own terms only.  Up to ``few_terms`` terms (and 16 blocks)
    are sent to the index, so that it needn't be shuffled to be looked up; more are joined with it.
    A null item_id is no item, but its phrases hit.
    """
    slop = -1 if slack is None else slack
    distinct = phrases.groupBy("terms").agg(F.collect_set("item_id").alias("items")).where("size(terms) > 0")
    terms = cut(distinct.select(F.explode("terms").alias("term")).distinct())
    few = F.broadcast if terms.count() <= few_terms else (lambda rows: rows)
    terms = few(terms)
    counts = index.postings.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("total"))
    placed = distinct.select("terms", "items", F.posexplode("terms").alias("offset", "term"))
    placed = placed.join(counts, "term").groupBy("terms").agg(F.first("items").alias("items"), F.sort_array(F.collect_list(F.struct("total", "offset", "term"))).alias("order"))
    asked = cut(placed.where("size(order) = size(terms)").select(F.xxhash64("terms").alias("__h"), "items", "order.offset", "order.term"))
    blocks = max(1, -(-asked.count() // phrases_a_block))
    asked = asked.withColumn("block", F.pmod("__h", F.lit(blocks)).cast("int"))

    def pack(table):
        import pyarrow as pa

        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "asked": [sink.getvalue().to_pybytes()]})

    blobs = cut(asked.select("block", "items", "offset", "term").groupBy("block").applyInArrow(pack, "block int, asked binary"))
    sent = F.broadcast if blocks <= 16 else (lambda rows: rows)
    asks = index.parts.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(sent(blobs), "block")
    wanted = few(cut(asked.select("block", F.explode("term").alias("term")).distinct()))
    lists = index.postings.select("segment", "term", "at").join(wanted, "term")
    overlap = index.overlap

    def meet(key, left, right):
        import pyarrow as pa

        schema = pa.schema([("row", pa.int64()), ("item_ids", pa.list_(pa.int64())), ("lo", pa.list_(pa.int64())), ("hi", pa.list_(pa.int64()))])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        phrase, start, end, span_items = _hits(left, pa.ipc.open_stream(right.column("asked")[0].as_py()).read_all(), slop, overlap)
        one = lambda name: np.frombuffer(right.column(name)[0].as_py(), "<i8")
        starts, rows, first = one("starts"), one("rows"), one("first")
        text = np.searchsorted(starts, start, side="right") - 1
        move = first[text] - starts[text]
        order = np.lexsort((start, text))
        text, lo, hi, phrase = text[order], (start + move)[order], (end + move)[order], phrase[order]
        out = {"row": [], "item_ids": [], "lo": [], "hi": []}
        edges = np.flatnonzero(np.diff(text, prepend=-1, append=-1)) if len(text) else np.array([0])
        for a, b in zip(edges[:-1], edges[1:]):
            reach = np.maximum.accumulate(hi[a:b])
            new = np.concatenate([[True], lo[a + 1 : b] > reach[:-1]])
            ends = np.concatenate([np.flatnonzero(new)[1:] - 1, [b - a - 1]])
            out["row"].append(rows[text[a]])
            out["item_ids"].append(sorted({i for p in np.unique(phrase[a:b]) for i in span_items[p]}))
            out["lo"].append(lo[a:b][new].tolist())
            out["hi"].append(reach[ends].tolist())
        return pa.table(out, schema)

    found = lists.groupBy("segment", "block").cogroup(asks.groupBy("segment", "block")).applyInArrow(meet, "row long, item_ids array<long>, lo array<long>, hi array<long>")
    spans = F.flatten(F.collect_list(F.arrays_zip("lo", "hi")))
    return found.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("item_ids"), F.sort_array(spans).alias("spans"))


def _hits(lists, asked, slop: int, overlap: int):
    """(phrase, start, end) of each hit in a segment, out of its lists of terms, and the items of each phrase."""
    import pyarrow as pa
    import pyarrow.compute as pc

    at = lists.column("at").combine_chunks()
    edges = np.frombuffer(at.buffers()[1], np.int32)[at.offset : at.offset + len(at) + 1].astype(np.int64)
    steps = np.frombuffer(at.buffers()[2], "<i4")[edges[0] // 4 : edges[-1] // 4].astype(np.int64)
    edges = (edges - edges[0]) // 4
    total, n = np.cumsum(steps), np.diff(edges)
    before = total[edges[:-1]] - steps[edges[:-1]]
    places = total - np.repeat(before, n)
    width = int(places.max(initial=0)) + 2 * overlap + 2
    keys = np.repeat(np.arange(len(n)), n) * width + places + overlap  # ascending: by term, then place
    terms = asked.column("term").combine_chunks()
    ends = terms.offsets.to_numpy().astype(np.int64)
    size = np.diff(ends)
    flat = pc.index_in(terms.flatten(), value_set=lists.column("term").combine_chunks())
    code = pc.fill_null(flat, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    offset = asked.column("offset").combine_chunks().flatten().to_numpy().astype(np.int64)
    ends -= ends[0]
    whole = np.minimum.reduceat(code, ends[:-1]) >= 0 if len(size) else np.zeros(0, bool)
    todo, rare = np.flatnonzero(whole), code[ends[:-1]]
    load, found = np.cumsum(n[rare[todo]]), []
    lo = 0
    while lo < len(todo):  # about two million starts at a time
        hi = max(lo + 1, int(np.searchsorted(load, (load[lo - 1] if lo else 0) + 2_000_000, side="right")))
        p = todo[lo:hi]
        k = n[rare[p]]
        phrase = np.repeat(p, k)
        place = places[np.repeat(edges[rare[p]] - np.cumsum(k) + k, k) + np.arange(k.sum())]
        if slop < 0:
            start = place - offset[ends[phrase]]
            phrase, start = phrase[start >= 0], start[start >= 0]
            for j in range(1, int(size[p].max())):
                here = np.flatnonzero(size[phrase] > j)
                x = ends[phrase[here]] + j
                key = code[x] * width + start[here] + offset[x] + overlap
                hit = keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key
                kept = np.ones(len(phrase), bool)
                kept[here] = hit
                phrase, start = phrase[kept], start[kept]
            found.append((phrase, start, start + size[phrase]))
        else:
            found.append(_near(phrase, place, code, ends, size, keys, width, slop, overlap))
        lo = hi
    parts = [np.concatenate(c) if found else np.empty(0, np.int64) for c in (zip(*found) if found else ((), (), ()))]
    return *parts, asked.column("items").to_pylist()


def _near(phrase, place, code, ends, size, keys, width, slop, overlap):
    """Proximity hits about places of each phrase's rarest term: first every term must stand near enough, then the least stretch is measured."""
    reach = size + slop  # words that a hit may take
    for j in range(1, int(size[phrase].max(initial=1))):
        here = np.flatnonzero(size[phrase] > j)
        c, r = code[ends[phrase[here]] + j], reach[phrase[here]] - 1
        low = np.searchsorted(keys, c * width + np.maximum(place[here] + overlap - r, 0))
        high = np.searchsorted(keys, c * width + np.minimum(place[here] + overlap + r, width - 1), side="right")
        kept = np.ones(len(phrase), bool)
        kept[here] = high > low
        phrase, place = phrase[kept], place[kept]
    out = []
    for p, a in zip(phrase.tolist(), place.tolist()):
        own, r = np.unique(code[ends[p] : ends[p] + size[p]]), int(reach[p]) - 1
        near = []
        for c in own.tolist():
            lo, hi = np.searchsorted(keys, [c * width + max(a + overlap - r, 0), c * width + min(a + overlap + r, width - 1) + 1])
            near += [(int(x) - c * width - overlap, c) for x in keys[lo:hi]]
        near.sort()
        best, held, lo = None, {}, 0
        for place_, c in near:  # the least stretch that holds every term and the place itself
            held[c] = held.get(c, 0) + 1
            while held[near[lo][1]] > 1 and near[lo][0] < a:
                held[near[lo][1]] -= 1
                lo += 1
            if len(held) == len(own) and near[lo][0] <= a <= place_ and place_ - near[lo][0] <= r and (best is None or place_ - near[lo][0] < best[1] - best[0]):
                best = (near[lo][0], place_)
        if best:
            out.append((p, best[0], best[1] + 1))
    got = np.array(out, np.int64).reshape(-1, 3)
    return got[:, 0], got[:, 1], got[:, 2]


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, slack: int | None = None, size: int = 1 << 24) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids, contaminated of every row of ``docs``: words inside an occurrence of a run of an item.

    Null and empty texts have no words; repeated rows get a row each; an empty table of items hits nothing.  Other columns
    of either table aren't looked at.
    """
    index = build(docs, length - 1 + max(0, slack or 0), size)
    found = search(index, windows(items, length), slack)
    over = lambda held, s: F.struct((held.n + F.greatest(F.lit(0), s.hi - F.greatest(s.lo, held.end))).alias("n"), F.greatest(held.end, s.hi).alias("end"))
    hit = F.aggregate("spans", F.expr("named_struct('n', 0L, 'end', 0L)"), over, lambda held: held.n)
    told = index.rows.join(found.select("row", "item_ids", hit.alias("n_hit")), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return told.select("doc_id", F.col("n").alias("n_words"), n_hit.alias("n_hit"), F.coalesce("item_ids", F.expr("cast(array() as array<bigint>)")).alias("item_ids"), (n_hit > 0).alias("contaminated"))
