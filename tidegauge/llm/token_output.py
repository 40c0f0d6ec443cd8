"""Token-ID output: frequency-ranked ids in byte-aligned variable-length files.

Format of a file (little endian): ``TGV1``, number of documents (u64), number of ids (u64), the documents'
ids (i64 each, the smallest value for null), their token counts (u64 each), then blocks of up to 2**20 ids.
A block: ids (u32), bytes of data (u32), control bytes (2 bits an id, four ids a byte, low bits first:
length - 1), data bytes.  What is stored is the id's rank by frequency over the whole corpus, so frequent
ids take one byte.  ``ranks-*.parquet`` beside the files maps ranks back.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, fresh_path, id_and_text, slices, stored

BLOCK = 1 << 20
NULL_ID = -(2**63)
_SHIFTS = np.array([0, 2, 4, 6], dtype=np.uint8)
#: lengths of the four ids of each control byte
LENGTHS = (((np.arange(256, dtype=np.uint8)[:, None] >> _SHIFTS) & 3) + 1).astype(np.uint8)


def pack_block(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of up to 2**20 unsigned 32-bit values."""
    v = np.ascontiguousarray(values, dtype="<u4")
    lens = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.zeros(-(-len(v) // 4) * 4, dtype=np.uint8)
    padded[: len(v)] = lens - 1
    control = (padded.reshape(-1, 4) << _SHIFTS).sum(axis=1, dtype=np.uint8)
    kept = np.arange(4, dtype=np.uint8)[None, :] < lens[:, None]
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def unpack_block(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """Inverse of ``pack_block`` by table lookup; ``data`` needs three spare bytes at its end."""
    lens = LENGTHS[control].reshape(-1)[:n]
    at = np.cumsum(lens, dtype=np.int64) - lens
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(lens > k)
        if not len(more):
            break
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def pack_file(doc_ids: list[int], counts: list[int], values: list[np.ndarray]) -> bytes:
    stream = np.concatenate(values) if values else np.empty(0, dtype="<u4")
    parts = [b"TGV1", np.array([len(doc_ids), len(stream)], dtype="<u8").tobytes(), np.array(doc_ids, dtype="<i8").tobytes(), np.array(counts, dtype="<u8").tobytes()]
    for lo in range(0, len(stream), BLOCK):
        control, data = pack_block(stream[lo : lo + BLOCK])
        parts += [np.array([min(BLOCK, len(stream) - lo), len(data)], dtype="<u4").tobytes(), control, data]
    return b"".join(parts)


def unpack_file(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, token counts and the stream of ranks of one file."""
    if blob[:4] != b"TGV1":
        raise ValueError("not a token file")
    raw = np.frombuffer(blob + b"\0\0\0", dtype=np.uint8)
    n_docs, n_ids = (int(x) for x in np.frombuffer(blob, dtype="<u8", count=2, offset=4))
    at = 20
    doc_ids = np.frombuffer(blob, dtype="<i8", count=n_docs, offset=at)
    counts = np.frombuffer(blob, dtype="<u8", count=n_docs, offset=at + 8 * n_docs)
    at += 16 * n_docs
    out, done = np.empty(n_ids, dtype=np.uint32), 0
    while done < n_ids:
        n, size = (int(x) for x in np.frombuffer(blob, dtype="<u4", count=2, offset=at))
        at += 8
        c = -(-n // 4)
        out[done : done + n] = unpack_block(raw[at : at + c], raw[at + c : at + c + size + 3], n)
        at += c + size
        done += n
    return doc_ids, counts, out


def encode_ids(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens and ids (binary, unsigned 16-bit if the vocabulary allows, else 32-bit)."""

    def run(batches):
        import pyarrow as pa

        from .encoding import encoder

        e, end = encoder(vocabulary), np.array([end_id], dtype="<u4").tobytes()
        wide = e.tokenizer.get_vocab_size() > 65536
        for batch in batches:
            for part in slices(batch, rows=4000, size=4 << 20):
                blobs = e.encode(part.column("text").to_pylist(), end)
                n = [len(b) // 4 for b in blobs]
                if not wide:
                    blobs = [np.frombuffer(b, dtype="<u4").astype("<u2").tobytes() for b in blobs]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array([4 if wide else 2] * len(n), pa.int32()), pa.array(blobs, pa.binary())], ["doc_id", "n_tokens", "width", "ids"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, width int, ids binary")


def id_frequencies(encoded: DataFrame) -> DataFrame:
    """id and count over the whole corpus; at most one row an id leaves a task."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for blob, width in zip(batch.column("ids"), batch.column("width").to_pylist()):
                c = np.bincount(np.frombuffer(blob.as_buffer(), dtype=f"<u{width}"))
                if len(c) > len(total):
                    total = np.concatenate([total, np.zeros(len(c) - len(total), dtype=np.int64)])
                total[: len(c)] += c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    return encoded.select("width", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int = 2, tokens_a_file: int = 4_000_000) -> tuple[str, DataFrame, list[int]]:
    """Writes all texts as token files in ascending doc_id order into a new shared folder.

    Returns the folder, one row a file (part, number, n_docs, n_tokens) and the ids by rank (at most one entry an
    id of the vocabulary, so it is small).  Null texts count as empty, null doc_ids come first, equal
    doc_ids are ordered by a hash of their ids and then their bytes, so that rows of one doc_id are dealt out too; an empty table gives
    no file.  A part of the order goes to files of at most ``tokens_a_file`` ids (a longer document alone); a file
    appears by a rename, so a task that is run again replaces its own files.
    """
    spark = docs.sparkSession
    encoded = stored(encode_ids(docs, vocabulary, end_id), "ids")
    freq = id_frequencies(encoded).orderBy(F.desc("n"), "id").collect()
    by_rank = [r["id"] for r in freq]
    total = sum(r["n"] for r in freq)
    ranks = np.zeros(max(by_rank, default=0) + 1, dtype=np.uint32)
    ranks[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shared_ranks = spark.sparkContext.broadcast(ranks)
    folder = fresh_path(spark, "tokens")
    _make_folder(folder)

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, number, held = TaskContext.get().partitionId(), 0, 0
        table, docs_, counts, values = shared_ranks.value, [], [], []

        def flush():
            _put(f"{folder}/part-{part:08d}-{number:05d}.tgv", pack_file(docs_, counts, values))
            return pa.RecordBatch.from_pydict({"part": [part], "number": [number], "n_docs": [len(docs_)], "n_tokens": [held]})

        for batch in batches:
            for i, n, width, blob in zip(batch.column("doc_id").to_pylist(), batch.column("n_tokens").to_pylist(), batch.column("width").to_pylist(), batch.column("ids")):
                if docs_ and held + n > tokens_a_file:
                    yield flush()
                    number, held, docs_, counts, values = number + 1, 0, [], [], []
                docs_.append(NULL_ID if i is None else i)
                counts.append(n)
                values.append(table[np.frombuffer(blob.as_buffer(), dtype=f"<u{width}")])
                held += n
        if docs_:
            yield flush()

    keyed = encoded.withColumn("tie", F.xxhash64("ids"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    ordered = keyed.repartitionByRange(max(1, -(-total // tokens_a_file)), *order).sortWithinPartitions(*order, "ids").drop("tie")
    return folder, cut(ordered.mapInArrow(write, "part long, number long, n_docs long, n_tokens long")), by_rank


def read_token_files(spark: SparkSession, folder: str, by_rank: list[int]) -> DataFrame:
    """part, number, doc_id, at (ids before it in its file), n_tokens, ids_crc32 of each document, from the files."""
    table = spark.sparkContext.broadcast(np.array(by_rank or [0], dtype="<u4"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path, blob in zip(batch.column("path").to_pylist(), batch.column("content")):
                doc_ids, counts, ranks = unpack_file(blob.as_py())
                ids = table.value[ranks]
                ends = np.cumsum(counts.astype(np.int64))
                starts = ends - counts.astype(np.int64)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                part, number = map(int, path.rsplit("part-", 1)[1].split(".")[0].split("-"))
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(crc), pa.int64()), pa.array([number] * len(crc), pa.int64()), pa.array(doc_ids, pa.int64(), mask=doc_ids == NULL_ID), pa.array(starts), pa.array(counts.astype(np.int64)), pa.array(crc, pa.int64())], ["part", "number", "doc_id", "at", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(run, "part long, number long, doc_id long, at long, n_tokens long, ids_crc32 long")


def file_bases(files: DataFrame, parts_a_block: int = 1024) -> DataFrame:
    """part, number and base: the ids in all files before it.

    Sums run within blocks of parts, and once over the blocks' totals (a row a thousand parts), so no task takes all files.
    """
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocked = files.withColumn("block", F.floor(F.col("part") / parts_a_block))
    blocks = blocked.groupBy("block").agg(F.sum("n_tokens").alias("n_tokens")).select("block", before(Window.orderBy("block")).alias("earlier"))
    inside = before(Window.partitionBy("block").orderBy("part", "number"))
    return blocked.withColumn("inside", inside).join(blocks, "block").select("part", "number", (F.col("earlier") + F.col("inside")).alias("base"))


def token_index(docs: DataFrame, vocabulary: str, end_id: int = 2, tokens_a_file: int = 4_000_000) -> DataFrame:
    """Writes the files, reads them back: doc_id, start, n_tokens, ids_crc32 of each document."""
    folder, files, by_rank = write_token_files(docs, vocabulary, end_id, tokens_a_file)
    back = read_token_files(docs.sparkSession, folder, by_rank)
    return back.join(file_bases(files), ["part", "number"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _make_folder(folder: str) -> None:
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    system.create_dir(path, recursive=True)


def _put(target: str, blob: bytes) -> None:
    """Writes a file under another name, then renames it."""
    import uuid

    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(target if "://" in target or target.startswith("file:") else f"file://{target}")
    head, name = path.rsplit("/", 1)
    there = f"{head}/_{uuid.uuid4().hex}.{name}"
    with system.open_output_stream(there) as f:
        f.write(blob)
    system.move(there, path)
