"""WARC archives: writing with segmented, chunked and revisit records, and reading back by segment reassembly."""

from __future__ import annotations

import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh_path, stored
from .token_output import _make_folder

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
RECORD = "archive string, origin string, segment int, total long, kind string, page_id long, refers_to long, url string, payload_bytes long, payload_digest string, block binary, payload binary"


def chunked(payload: bytes, size: int = 4096) -> bytes:
    parts = []
    for lo in range(0, len(payload), size):
        piece = payload[lo : lo + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """Decodes chunked transfer framing; chunk extensions and trailers are passed over, anything torn is an error."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is missing")
        n = int(body[at:end].split(b";")[0].strip(), 16)
        if n == 0:
            return b"".join(parts)
        at = end + 2
        if body[at + n : at + n + 2] != b"\r\n":
            raise ValueError("chunk is torn")
        parts.append(body[at : at + n])
        at += n + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        raise ValueError("no HTTP head")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(b"WARC/1.1\r\n" + lines.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n") + z.flush()


def records(blob: bytes):
    """(headers with lower-case names, block) of each gzip member."""
    view, at = memoryview(blob), 0
    while at < len(view):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:  # in small pieces, so that what follows a member is never copied as a whole
            piece = view[at : at + 8192]
            if not len(piece):
                raise ValueError("torn gzip member")
            parts.append(z.decompress(piece))
            at += len(piece)
        at -= len(z.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(headers["content-length"])
        if len(rest) != n + 4:
            raise ValueError("record length differs")
        yield headers, rest[:n]


class _Files:
    """Files of about ``size`` bytes, each of which appears by a rename when full."""

    def __init__(self, folder: str, stem: str, size: int = 8 << 20):
        from pyarrow import fs

        self.system, self.path = fs.FileSystem.from_uri(folder if ":" in folder.split("/")[0] else f"file://{folder}")
        self.stem, self.size, self.n, self.parts, self.held = stem, size, 0, [], 0

    def add(self, blob: bytes) -> None:
        self.parts.append(blob)
        self.held += len(blob)
        if self.held >= self.size:
            self.close()

    def close(self) -> None:
        if self.parts:
            there = f"{self.path}/_{uuid.uuid4().hex}"
            with self.system.open_output_stream(there) as f:
                f.write(b"".join(self.parts))
            self.system.move(there, f"{self.path}/{self.stem}-{self.n:05d}.warc.gz")
            self.n, self.parts, self.held = self.n + 1, [], 0


def write_archives(pages: DataFrame, least_bytes: int = 1000, segment: int = 8192) -> tuple[str, DataFrame]:
    """Writes a record per row and returns the folder with one row an archive.

    Of equal payloads of at least ``least_bytes`` bytes the largest page_id is the response, other page_ids
    are revisits; null html is an empty payload, a null page_id is always a response, and of rows with the same page_id and payload all
    are responses if it is the largest.  Blocks above ``segment`` bytes go on in continuation records in a
    file of their own.  Payloads are shuffled once, by page_id, and only narrow rows by digest.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    narrow = rows.where((F.octet_length("payload") >= least_bytes) & F.col("page_id").isNotNull()).select("page_id", "digest")
    largest = narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("refers_to > least").select("digest", "refers_to")
    refers = narrow.join(largest, "digest").where("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()
    folder = fresh_path(pages.sparkSession, "warc")
    _make_folder(folder)

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        name, times, n = f"part-{TaskContext.get().partitionId():06d}", {}, 0
        first, rest = _Files(folder, f"{name}-a"), _Files(folder, f"{name}-b")
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["page_id"], r["digest"])
                k = times[key] = times.get(key, -1) + 1
                n += 1
                own = f"<urn:page:{r['page_id']}:{r['digest']}:{k}>"
                url = r["url"].replace("\r", " ").replace("\n", " ")
                base = [("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("X-Page-ID", "" if r["page_id"] is None else str(r["page_id"]))]
                body = [("WARC-Payload-Digest", f"sha1:{r['digest']}"), ("X-Payload-Length", str(len(r["payload"]))), ("Content-Type", "application/http;msgtype=response")]
                if r["refers_to"] is not None:
                    first.add(record([("WARC-Type", "revisit"), *base, *body, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{r['refers_to']}:{r['digest']}:0>")], HTTP_HEAD))
                    continue
                block = HTTP_HEAD + chunked(r["payload"])
                if len(block) <= segment:
                    first.add(record([("WARC-Type", "response"), *base, *body], block))
                    continue
                first.add(record([("WARC-Type", "response"), *base, *body, ("WARC-Segment-Number", "1")], block[:segment]))
                for s, lo in enumerate(range(segment, len(block), segment), 2):
                    last = [("WARC-Segment-Total-Length", str(len(block)))] if lo + segment >= len(block) else []
                    rest.add(record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{s}>"), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(s)), *last], block[lo : lo + segment]))
        first.close()
        rest.close()
        yield pa.RecordBatch.from_pydict({"archive": [name], "records": pa.array([n], pa.int64())})

    joined = rows.join(refers, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "refers_to")
    joined = joined.sortWithinPartitions("page_id", "digest", "url")  # so a task that is run again fills the same files
    return folder, cut(joined.mapInArrow(write, "archive string, records long"))


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Every page record: page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload).

    Continuation records are grouped with their origin by its identifier, ordered by segment number, and
    the joined block must have the stated total length and no number missing; then chunked framing is
    decoded and the payload's digest verified.  Whole records don't leave their task.  A revisit's
    payload, length and digest are those it refers to.  What is grouped is one page's record at most.
    """

    def parse(batches):
        import pyarrow as pa

        schema = pa.schema([("archive", pa.string()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("kind", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("block", pa.binary()), ("payload", pa.binary())])
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                archive, out, size = path.rsplit("/", 1)[1][:11], [], 0
                for h, block in records(content.as_py()):
                    kind, number, page = h["warc-type"], h.get("warc-segment-number"), h.get("x-page-id")
                    row = dict(archive=archive, origin=h.get("warc-segment-origin-id", h["warc-record-id"]), segment=None if number is None else int(number), kind=kind, url=h.get("warc-target-uri"), page_id=int(page) if page else None)
                    row["total"] = int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None
                    if "warc-payload-digest" in h:
                        row["payload_digest"] = h["warc-payload-digest"].split(":")[1]
                        row["payload_bytes"] = int(h["x-payload-length"])
                    if kind == "revisit":
                        row["refers_to"] = int(h["warc-refers-to"].split(":")[2])
                    elif number is None:
                        row |= _checked(block, row["payload_digest"], with_payload)
                    else:
                        row["block"] = block
                    out.append(row)
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    def join(batches):
        import pyarrow as pa

        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for lo in range(0, batch.num_rows, 50):
                out = []
                for r in batch.slice(lo, 50).to_pylist():
                    parts = r["parts"]
                    block = b"".join(p["block"] for p in parts)
                    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or len(block) != r["total"]:
                        raise ValueError(f"segments of {r['origin']} don't add up")
                    out.append({"page_id": r["page_id"], "url": r["url"]} | _checked(block, r["payload_digest"], with_payload))
                yield pa.RecordBatch.from_pylist(out, schema)

    parsed = stored(spark.read.format("binaryFile").load(folder).select("path", "content").mapInArrow(parse, RECORD), "records")
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    whole = parsed.where("segment is null").withColumn("record_type", F.col("kind")).select(*columns)
    parts = F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts")
    grouped = parsed.where("segment is not null").groupBy("archive", "origin").agg(parts, F.max("total").alias("total"), F.max("page_id").alias("page_id"), F.min("url").alias("url"), F.max("payload_digest").alias("payload_digest"))
    joined = grouped.select("origin", "parts", "total", "page_id", "url", "payload_digest").mapInArrow(join, "page_id long, url string, payload_bytes long, payload_digest string, payload binary")
    joined = joined.withColumn("record_type", F.lit("response")).withColumn("refers_to", F.lit(None).cast("long")).select(*columns)
    out = whole.unionByName(joined)
    if not with_payload:
        return out.drop("payload")
    kept = out.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload").alias("original")).dropDuplicates(["refers_to", "payload_digest"])
    return out.join(kept, ["refers_to", "payload_digest"], "left").withColumn("payload", F.coalesce("payload", "original")).select(*columns)


def _checked(block: bytes, digest: str, with_payload: bool) -> dict:
    payload = payload_of(block)
    if hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("payload digest differs")
    return {"payload_bytes": len(payload), "payload_digest": digest, "payload": payload if with_payload else None}
