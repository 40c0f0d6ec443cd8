"""Quality by attention over passages: multiple-instance learning from document labels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, release, slices

PASSAGE = 512  # bytes
PAIRS = 256
WIDTH = PAIRS + 1


def _classes() -> np.ndarray:
    """Byte -> one of 16 classes of writing."""
    c = np.full(256, 13, dtype=np.uint8)
    c[:32] = 0
    c[ord("a") : ord("z") + 1] = 2
    c[[ord(x) for x in "aeiou"]] = 1
    c[ord("A") : ord("Z") + 1] = 3
    c[ord("0") : ord("9") + 1] = 4
    for k, chars in ((5, " "), (6, "\n\r"), (7, "."), (8, ",;:"), (9, "|<>"), (10, "!?"), (11, "%$#*&@~^"), (12, "'\"()[]{}")):
        c[[ord(x) for x in chars]] = k
    c[128:192] = 15
    c[192:] = 14
    return c


CLASSES = _classes()
_SPREAD = np.random.default_rng(0).integers(1, 2**63, 64, dtype=np.uint64)


#: Bytes of a text that are worked on at once, and of its neighbourhood that they are seen with, for words cut by the edges.
WINDOW, MARGIN = 1 << 20, 1 << 12


def _features(raw: np.ndarray, at: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Features of ``rows`` passages out of bytes, their places in their texts, and the passages that they fall to (below zero: only seen)."""
    if len(raw) < 2:
        return np.zeros((rows, WIDTH), dtype=np.float32)
    c = CLASSES[raw].astype(np.int32)
    inside = (at[1:] > 0) & (row[1:] >= 0)
    flat = (row[1:] * PAIRS + c[:-1] * 16 + c[1:])[inside]
    x = np.bincount(flat, minlength=rows * PAIRS).reshape(rows, PAIRS).astype(np.float32)
    again = np.zeros((rows, 1), dtype=np.float32)
    black = (c != 5) & (c != 6) & (c != 0)
    starts = np.flatnonzero(black & (np.concatenate([[True], ~black[:-1]]) | (at == 0)))
    if len(starts):
        place = np.arange(len(raw)) - np.concatenate([np.zeros(starts[0], dtype=np.int64), np.repeat(starts, np.diff(np.append(starts, len(raw))))])
        key = np.add.reduceat(np.where(black, raw.astype(np.uint64) * _SPREAD[place & 63], 0).astype(np.uint64), starts)
        same = np.concatenate([[False], (key[1:] == key[:-1]) & (at[starts[1:]] > at[starts[:-1]])])
        own = row[starts] >= 0
        words = np.bincount(row[starts][own], minlength=rows)
        again = (np.bincount(row[starts][own], same[own], rows) / np.maximum(1, words)).astype(np.float32)[:, None]
    x = np.concatenate([x / np.maximum(1, x.sum(axis=1, keepdims=True)), again], axis=1)
    return np.sqrt(x)


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and passages per text, of texts that are short enough to be worked on at once.

    A passage's features are the roots of the shares of its pairs of neighbouring classes, and of the share of
    its words that repeat the word before.
    """
    blobs = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(b) for b in blobs], dtype=np.int64)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    raw = np.frombuffer(b"".join(blobs), dtype=np.uint8)
    at = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return _features(raw, at, np.repeat(np.cumsum(counts) - counts, sizes) + at // PASSAGE, int(counts.sum())), counts


def long_passages(text: str):
    """The features of a long text's passages, some at a time, so that memory beyond the text itself is bounded."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    for lo in range(0, len(raw), WINDOW):
        hi = min(len(raw), lo + WINDOW)
        first, last = max(0, lo - MARGIN), min(len(raw), hi + MARGIN)
        at = np.arange(first, last)
        row = np.where((at >= lo) & (at < hi), (at - lo) // PASSAGE, -1)
        yield _features(raw[first:last], at, row, -(-(hi - lo) // PASSAGE))


class Attention:
    """h = tanh(xW + b); weights = softmax(w . (tanh(hV) * sigmoid(hU))); score = sigmoid(c . sum(weights h) + d)."""

    NAMES = ("W", "b", "V", "U", "w", "c", "d")

    def __init__(self, hidden: int = 24, gate: int = 12, seed: int = 7):
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"W": g(WIDTH, hidden) * 4, "b": np.zeros(hidden, np.float32), "V": g(hidden, gate), "U": g(hidden, gate), "w": g(gate), "c": g(hidden), "d": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict:
        p, starts = self.p, np.cumsum(counts) - counts
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
        a = e / np.repeat(np.add.reduceat(e, starts), counts)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "y": y}

    def score(self, texts: list[str]) -> np.ndarray:
        """Scores of texts; a long one's attention is summed over windows of passages, as one softmax."""
        out = np.zeros(len(texts))
        short = [i for i, t in enumerate(texts) if len(t) <= WINDOW // 4]
        if short:
            out[short] = self.forward(*passages([texts[i] for i in short]))["y"]
        for i in set(range(len(texts))) - set(short):
            top, total, z = -np.inf, 0.0, 0.0
            for x in long_passages(texts[i]):
                h = np.tanh(x @ self.p["W"] + self.p["b"])
                e = (np.tanh(h @ self.p["V"]) / (1 + np.exp(-(h @ self.p["U"])))) @ self.p["w"]
                higher = max(top, float(e.max()))
                w = np.exp(e - higher)
                scale = np.exp(top - higher)
                top, total, z = higher, total * scale + w.sum(), z * scale + w @ h
            out[i] = 1 / (1 + np.exp(-np.clip(z / total @ self.p["c"] + self.p["d"][0], -30, 30)))
        return out

    def gradients(self, x: np.ndarray, counts: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict:
        p, f, starts = self.p, self.forward(x, counts), np.cumsum(counts) - counts
        dy = (f["y"] - label) * weight / weight.sum()
        dz = dy[:, None] * p["c"]
        dz_rows, a = np.repeat(dz, counts, axis=0), f["a"]
        da = (dz_rows * f["h"]).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), counts))
        gate = de[:, None] * p["w"]
        dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
        dh = (a[:, None] * dz_rows + dt @ p["V"].T + ds @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ dy, "d": dy.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], label: np.ndarray, epochs: int = 60, batch: int = 128, rate: float = 0.01, decay: float = 1e-5, seed: int = 3) -> Attention:
        """Adam; documents of the rarer label weigh as much in sum as at most five times their number."""
        share = label.mean() if len(label) else 0.5
        weight = np.where(label == 1, 1.0, min(5.0, share / max(1e-6, 1 - share)))
        order, m, v, step = np.random.default_rng(seed), {k: 0.0 for k in self.NAMES}, {k: 0.0 for k in self.NAMES}, 0
        for epoch in range(epochs if len(set(label.tolist())) > 1 else 0):
            perm, lr = order.permutation(len(bags)), rate * (1 - epoch / epochs)
            for lo in range(0, len(perm), batch):
                part = perm[lo : lo + batch]
                x, counts = np.concatenate([bags[i] for i in part]), np.array([len(bags[i]) for i in part])
                g, step = self.gradients(x, counts, label[part], weight[part]), step + 1
                for k in self.NAMES:
                    d = g[k] + decay * self.p[k]
                    m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.999 * v[k] + 0.001 * d * d
                    self.p[k] = (self.p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        if len(label) and len(set(label.tolist())) == 1:
            self.p["d"][:] = 4.0 if label[0] == 1 else -4.0
            self.p["c"][:] = 0
        return self


def held_out(doc_id):
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sampled: int = 4000, most_passages: int = 2048) -> Attention:
    """Fits on at most ``sampled`` labelled documents that aren't held out, drawn by hash of doc_id.

    Null labels don't count; of several labels of a document the least does.  Documents of more than
    ``most_passages`` passages (1 MB) take no part in fitting, so that what comes to the driver is bounded.
    """
    drawn = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    drawn = drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sampled)
    rows = id_and_text(docs).where(F.octet_length("text") <= most_passages * PASSAGE).join(F.broadcast(drawn), "doc_id")

    def features(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                x, counts = passages(part.column("text").to_pylist())
                cut_at = np.cumsum(counts)[:-1]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("quality").cast(pa.int32()), pa.array([a.astype(np.float16).tobytes() for a in np.split(x, cut_at)], pa.binary())], ["doc_id", "quality", "x"])

    got = rows.select("doc_id", "text", "quality").mapInArrow(features, "doc_id long, quality int, x binary").toArrow().sort_by([("doc_id", "ascending")])
    bags = [np.frombuffer(b.as_buffer(), dtype=np.float16).astype(np.float32).reshape(-1, WIDTH) for b in got.column("x")]
    model = Attention().fit(bags, got.column("quality").to_numpy().astype(np.float64))
    del got, bags
    release()
    return model


def with_scores(docs: DataFrame, model: Attention, name: str = "score") -> DataFrame:
    """``docs`` with the score of its text in one more column; other columns pass through."""
    params = docs.sparkSession.sparkContext.broadcast(model.p)
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        own = Attention()
        own.p = params.value
        for batch in batches:
            for part in slices(batch, at):
                y = own.score([t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(y.astype(np.float64))], [*part.schema.names, name])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def scored(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts are one empty passage and get a score too; repeated rows are kept; a null doc_id
    is not held out; without labels of both kinds the score is that of the one kind (or of untrained weights).
    """
    model = train(docs, labels)
    out = with_scores(id_and_text(docs), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier doesn't reject; nulls, repeats and empty tables as ``scored`` has it."""
    model = train(docs, labels)
    name = "score"
    while name in docs.columns:
        name = f"_{name}"
    return with_scores(docs, model, name).where(F.col(name) >= least).drop(name)
