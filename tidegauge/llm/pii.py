"""Personal data: generators propose overlapping spans, boosted trees judge them, calibrated thresholds select."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drawn, id_and_text, release, slices

# Fixed values of the contract: kinds in their order, and the base patterns, each anchored so that a text is read once:
# email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ from its @ outwards; ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+) as fours of
# a chain of numbers; card [0-9]([\x20-]?[0-9])+; phone \+[0-9][\x20().0-9-]+[0-9].
KINDS = ["email", "ip", "card", "phone"]
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
USER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: High-recall generators of further candidates: (kind, pattern); none has a repeat without bound before its anchor.
GENERATORS = [
    (1, re.compile(r"\b[0-9]{1,3}(?: ?(?:\.|\[\.\]) ?[0-9]{1,3}){3}\b")),
    (1, re.compile(r"\b(?:[0-9A-Fa-f]{1,4}:){3,7}:?[0-9A-Fa-f]{1,4}\b")),
    (2, re.compile(r"\b[0-9](?:[ ./_-]{0,2}[0-9]){11,18}\b")),
    (3, re.compile(r"(?<![\w.])(?:00[0-9]{1,3}|\(?0?[0-9]{2,4}\)?)(?:[ ./-]{1,2}\(?[0-9]{2,5}\)?){2,4}(?!\w)")),
    (3, re.compile(r"\+ ?[0-9][ ()./0-9-]{6,24}[0-9]")),
]
#: Addresses of other writings grow from an anchor: to the left over the user's characters, to the right over a host.
SPELT_AT = re.compile(r" ?(?:\(at\)|\[at\]|<at>| at ) ?")
SPELT_HOST = re.compile(r"[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]+)+")
WIDE_HOST = re.compile(r"@[\w-]+(?:\.[\w-]+)*")
_DIGIT = re.compile(r"[0-9]")
_CUES = [re.compile(p) for p in (r"(?i)e-?mail|contact|write|@", r"(?i)\bip\b|host|addr|server|login", r"(?i)card|visa|pay|credit|account|carte|karte|tarjeta", r"(?i)phone|tel|call|mobile|fax|whatsapp|número|telefon")]
FEATURES = 26


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _run_before(text: str, at: int, least: int, also=None) -> int:
    """Where the run of user characters that ends at ``at`` begins, not before ``least``."""
    a = at
    while a > least and (text[a - 1] in USER or also and also(text[a - 1])):
        a -= 1
    return a


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted, in time linear in the text's length."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        if (a := _run_before(text, at, last)) < at and (m := EMAIL_HOST.match(text, at)):
            out.append((a, 0, last := m.end()))
        at = text.find("@", max(at + 1, last))
    if _DIGIT.search(text):
        for m in IP_CHAIN.finditer(text):
            if m[0].count(".") >= 3:
                parts, a = m[0].split("."), m.start()
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k : k + 4]
                    n = sum(map(len, four)) + 3
                    if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in four):
                        out.append((a, 1, a + n))
                    a += n + 1
        for m in CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Proposals of all generators, overlaps included; no text is read more than a fixed number of times a generator."""
    out, last, at = set(), 0, text.find("@")
    while at >= 0:
        if (a := _run_before(text, at, last, str.isalnum)) < at and (m := WIDE_HOST.match(text, at)):
            out.add((a, 0, last := m.end()))
        at = text.find("@", max(at + 1, last))
    if " at " in text or "at)" in text or "at]" in text or "at>" in text:
        last = 0
        for anchor in SPELT_AT.finditer(text):
            if (a := _run_before(text, anchor.start(), last)) < anchor.start() and (m := SPELT_HOST.match(text, anchor.end())):
                out.add((a, 0, last := m.end()))
    if _DIGIT.search(text):
        out |= {(m.start(), k, m.end()) for k, p in GENERATORS for m in p.finditer(text)}
    return sorted(out)


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format and context of one candidate."""
    a, kind, b = span
    s = text[a:b]
    before, after = text[max(0, a - 24) : a], text[b : b + 8]
    digits = "".join(c for c in s if "0" <= c <= "9")
    groups = re.findall(r"[0-9]+", s)
    n = len(s)
    side = lambda c: 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4
    return [
        kind,
        n,
        len(digits),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        float(len(digits) >= 12 and luhn(digits)),
        float(len(groups) == 4 and all(int(g[:9]) <= 255 for g in groups)),
        s.count("."),
        s.count("-"),
        s.count(" "),
        s.count("@"),
        float(s[:1] == "+"),
        float("(" in s),
        sum(c.isalpha() for c in s) / n,
        sum(c.isupper() for c in s),
        float(bool(re.search(r"(?i)\(at\)|\[at\]|<at>|\[dot\]|\(dot\)", s))),
        float(" at " in s and " dot " in s),
        float(bool(re.search(r"\.[A-Za-z]{2,}$", s))),
        s.count(":"),
        side(before[-1:]),
        side(after[:1]),
        *(float(bool(p.search(before))) for p in _CUES),
    ]


class Boosted:
    """Gradient-boosted trees of depth three for the logistic loss, on histogram bins of each feature."""

    def __init__(self, rounds: int = 50, rate: float = 0.2, depth: int = 3, bins: int = 32, least: int = 5):
        self.rounds, self.rate, self.depth, self.bins, self.least, self.trees, self.base = rounds, rate, depth, bins, least, [], 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) if len(x) else np.empty(0) for j in range(x.shape[1])]
        share = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        self.base = float(np.log(share / (1 - share)))
        if len(set(y.tolist())) < 2:
            return self
        q, f = self._binned(x), np.full(len(x), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            node, splits = np.zeros(len(x), dtype=np.int64), {}
            for level in range(self.depth):
                first = 2**level - 1
                for k in range(2**level):
                    at = np.flatnonzero(node == first + k)
                    if len(at) >= 2 * self.least and (best := self._split(q[at], g[at], h[at])):
                        splits[first + k] = best
                        node[at] = 2 * (first + k) + 1 + (q[at, best[0]] > best[1])
            size = 2 ** (self.depth + 1) - 1
            value = self.rate * np.bincount(node, g, size) / (np.bincount(node, h, size) + 1)
            self.trees.append((splits, value))
            f += value[node]
        return self

    def _split(self, q, g, h):
        best, gain = None, 1e-6
        whole = g.sum() ** 2 / (h.sum() + 1)
        for j in range(q.shape[1]):
            n = len(self.edges[j]) + 1
            if n < 2:
                continue
            gs, hs, c = (np.cumsum(np.bincount(q[:, j], w, n))[:-1] for w in (g, h, None))
            v = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
            v[(c < self.least) | (len(q) - c < self.least)] = 0
            if v.max() > gain:
                best, gain = (j, int(v.argmax())), v.max()
        return best

    def score(self, x: np.ndarray) -> np.ndarray:
        f, q = np.full(len(x), self.base), self._binned(x)
        for splits, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for k, (j, cut) in sorted(splits.items()):
                at = np.flatnonzero(node == k)
                node[at] = 2 * k + 1 + (q[at, j] > cut)
            f += value[node]
        return 1 / (1 + np.exp(-f))


def _made(rng, words: list[str], kind: int) -> str:
    """A made value of a kind: an address out of a text's own words, random numbers of the right form."""
    n = lambda lo, hi: int(rng.integers(lo, hi))
    if kind == 0:
        word = lambda: words[n(0, len(words))].lower()
        return f"{word()}{('.', '_', '')[n(0, 3)]}{word() if n(0, 2) else n(1, 999)}@{word()}{n(1, 99) if n(0, 2) else ''}.{('com', 'org', 'net', 'example', 'de', 'co.uk')[n(0, 6)]}"
    if kind == 1:
        return ".".join(str(n(1, 255)) for _ in range(4))
    if kind == 2:
        d = str(n(3, 7)) + "".join(str(n(0, 10)) for _ in range(14))
        return d + next(c for c in "0123456789" if luhn(d + c))
    return f"+{n(1, 99)} {n(100, 999)} {n(100, 999)} {n(1000, 9999)}"


def _written(s: str, kind: int, rng, words: list[str]) -> list[tuple[str, int, int]]:
    """(text, kind, label) of a value: as it is and written otherwise (personal), and spoilt or of another nature (not).

    Personal are an address spelt out, other separators, a number without its plus, an address of letters beyond ASCII.  Not
    personal are a card number that fails its check digit, four numbers of which one is over 255, numbers of the wrong length, dates, times,
    versions, amounts, a handle, and two sentences that meet without a blank after "at".
    """
    n, word = lambda lo, hi: int(rng.integers(lo, hi)), lambda: words[int(rng.integers(len(words)))]
    out = [(s, kind, 1)]
    if kind == 0:
        user, _, host = s.partition("@")
        for at, dot in ((" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", " (dot) "), (" at ", "."), (" [at] ", "."), ("<at>", ".")):
            if at != " at " or dot != ".":
                out.append((f"{user}{at}{host.replace('.', dot)}", 0, 1))
        out.append((f"é{user}@ä{host}", 0, 1))
        out += [(f"{word()} at {word()}.{word().capitalize()}", 0, 0), (f"{user}@{host.split('.')[0]}", 0, 0), (f"{word()} at the. And", 0, 0), (f"{word()} at {word()}. {word()}", 0, 0), (f"{word()} at {word()} . {word().capitalize()}", 0, 0), (f"{word()}@{n(2, 99)}", 0, 0)]
    elif kind == 1:
        p = s.split(".")
        out += [(s.replace(".", "[.]"), 1, 1), (s.replace(".", " . "), 1, 1), (":".join(f"{n(256, 65536):x}" for _ in range(8)), 1, 1)]
        over = [*p]
        over[n(0, 4)] = str(n(256, 999))
        out += [(".".join(over), 1, 0), (" ".join(p), 1, 0), (f"{n(10, 24)}:{n(10, 60)}:{n(10, 60)}:{n(10, 60)}", 1, 0), (f"{n(1, 9)}. {n(1, 9)}. {n(1, 9)}. {n(1, 9)}", 1, 0)]
    elif kind == 2:
        d = re.sub(r"[^0-9]", "", s)
        out += [(sep.join(d[i : i + 4] for i in range(0, len(d), 4)), 2, 1) for sep in (" ", "-", ".", " - ")]
        for _ in range(3):
            i = n(0, len(d))
            w = d[:i] + str((int(d[i]) + 1 + n(0, 9)) % 10) + d[i + 1 :]
            if not luhn(w):
                out += [(w, 2, 0), (" ".join(w[i : i + 4] for i in range(0, len(w), 4)), 2, 0)]
    else:
        d = re.sub(r"[^0-9]", "", s)
        out += [(f"00{d[:-10]} {d[-10:-7]} {d[-7:-4]} {d[-4:]}", 3, 1), (f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", 3, 1), (f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}", 3, 1), (f"+ {s[1:]}", 3, 1)]
        year, month, day = n(1900, 2100), n(1, 13), n(1, 29)
        out += [(f"{year}-{month:02}-{day:02}", 3, 0), (f"{day:02}.{month:02}.{year}", 3, 0), (f"{day:02}/{month:02}/{year}", 3, 0), (f"{n(10, 999)}.{n(100, 1000)}.{n(100, 1000)}", 3, 0), (f"{n(10, 999)} {n(100, 1000)} {n(100, 1000)}", 3, 0)]
        out += [(f"{n(10, 99)} {n(10, 99)} {n(10, 99)}", 3, 0), (f"{year}-{year + n(1, 9)}-{n(10, 99)}", 3, 0), (f"{n(10, 24)}-{n(10, 60)}-{n(10, 60)}", 3, 0)]
    return out


def _examples(text: str, seed: int) -> list[tuple[list[float], int, int]]:
    """(features, label, kind) from one text: its base spans and a made value of each kind at a place in it, each written in many ways.

    What the generators propose apart from base spans is left out: it may be personal data written otherwise, so it says nothing.
    """
    rng, out = np.random.default_rng(seed), []
    words = [w for w in re.findall(r"[A-Za-z]{2,12}", text[:20_000])[:500]] or ["mail", "info", "home"]
    gaps = [m.start() for m in re.finditer(" ", text[:20_000])] or [0]
    known = [(a, kind, b, text[a:b]) for a, kind, b in base_spans(text)[:50]]
    known += [(g, kind, g, _made(rng, words, kind)) for kind in range(4) for g in [gaps[int(rng.integers(len(gaps)))]]]
    for a, kind, b, value in known:
        before, after = text[max(0, a - 40) : a], text[b : b + 20]
        before = f"{before} " if a == b and before[-1:] not in ("", " ") else before
        for new, k, label in _written(value, kind, rng, words):
            at = len(before)
            out.append((features(before + new + after, (at, k, at + len(new))), label, k))
    return out


def train(docs: DataFrame, sampled: int = 1500, most: int = 24_000) -> tuple[Boosted, list[float]]:
    """Trees and a threshold a kind, from at most ``sampled`` texts (of up to 1 MB), drawn by hash of their
    ids, which are drawn alone first, so the texts stay where they are.

    Two thirds of the texts' examples (at most ``most`` in all) grow the trees; on the others each kind's threshold is the
    least at which 99.5 of 100 chosen are right, and at least one half.  Each text gives made values of every kind, so
    every kind has examples on both sides; a corpus without texts finds base spans alone.
    """
    rows = id_and_text(docs).where((F.length("text") > 0) & (F.octet_length("text") <= 1_000_000))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = _examples(text, (doc_id or 0) & 0xFFFFFFFF)
                fold = [zlib.crc32(str(doc_id).encode()) % 3] * len(found)
                yield pa.RecordBatch.from_pydict({"x": pa.array([f[0] for f in found], pa.list_(pa.float64())), "y": pa.array([f[1] for f in found], pa.int32()), "kind": pa.array([f[2] for f in found], pa.int32()), "fold": pa.array(fold, pa.int32())})

    got = drawn(rows, sampled).mapInArrow(run, "x array<double>, y int, kind int, fold int").orderBy(F.xxhash64("x", "y", "fold")).limit(most).toArrow()
    x = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, FEATURES)
    y, kind, fold = (got.column(c).to_numpy().astype(np.int64) for c in ("y", "kind", "fold"))
    grown, told = (fold != 0, fold == 0) if len(set(fold.tolist())) > 1 else (fold >= 0, fold >= 0)
    model = Boosted().fit(x[grown], y[grown])
    s, least = model.score(x), []
    for k in range(4):
        own = told & (kind == k)
        order = np.argsort(-s[own])
        right = np.cumsum(y[own][order]) / np.arange(1, own.sum() + 1)
        ok = np.flatnonzero(right >= 0.995)
        least.append(max(0.5, float(s[own][order][ok[-1]]) if len(ok) else 1.1))
    del got, x
    release()
    return model, least


class _Taken:
    """Disjoint intervals by start."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.at: list[tuple[int, int]] = []
        for a, _, b in sorted(spans):
            if self.at and a < self.at[-1][1]:
                self.at[-1] = (self.at[-1][0], max(b, self.at[-1][1]))
            else:
                self.at.append((a, b))

    def meets(self, a: int, b: int) -> bool:
        k = bisect_left(self.at, (b,))
        return k > 0 and self.at[k - 1][1] > a

    def add(self, a: int, b: int) -> None:
        insort(self.at, (a, b))


def find(text: str, model: Boosted, least: list[float]) -> tuple[list, list]:
    """Base spans and added ones: candidates over their threshold, best first, that touch nothing chosen before."""
    base = base_spans(text)
    taken = _Taken(base)
    proposed = [c for c in candidates(text) if not taken.meets(c[0], c[2])]
    added = []
    for lo in range(0, len(proposed), 10_000):
        part = proposed[lo : lo + 10_000]
        s = model.score(np.array([features(text, c) for c in part]))
        added += [(-x, c) for x, c in zip(s.tolist(), part) if x >= least[c[1]]]
    chosen = _Taken([])
    out = []
    for _, c in sorted(added):
        if not chosen.meets(c[0], c[2]):
            chosen.add(c[0], c[2])
            out.append(c)
    return base, sorted(out)


def said(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, base_sha256, spans and n_added of every row.

    Null texts count as empty and have no spans; repeated rows are kept; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches):
        import hashlib

        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole)):
            out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")}
            for text in batch.column("text").to_pylist():
                base, added = find(text, *model.value)
                for k, name in enumerate(KINDS):
                    out[f"n_{name}"].append(sum(b[1] == k for b in base))
                out["base_sha256"].append(hashlib.sha256(said(base).encode()).hexdigest())
                out["spans"].append(said(base + added))
                out["n_added"].append(len(added))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *map(pa.array, out.values())], ["doc_id", *out])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each chosen span replaced by its kind in square brackets; a null text stays null.

    Overlapping spans are replaced as one, by the kind of the first; repeated rows are treated alike, an empty table stays empty.  Other columns stay, but n_chars, where there is one, is the new
    length of a changed text.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs))
    columns, schema = docs.columns, docs.schema
    at = columns.index("text")
    counted = columns.index("n_chars") if columns.count("n_chars") == 1 else None

    def run(batches):
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole, at)):
            texts, arrays = batch.column(at).to_pylist(), list(batch.columns)
            sizes = batch.column(counted).to_pylist() if counted is not None else None
            for i, text in enumerate(texts):
                if not text:
                    continue
                base, added = find(text, *model.value)
                merged: list[list[int]] = []
                for a, k, b in sorted(base + added):
                    if merged and a < merged[-1][2]:
                        merged[-1][2] = max(merged[-1][2], b)
                    else:
                        merged.append([a, k, b])
                if merged:
                    parts, last = [], 0
                    for a, k, b in merged:
                        parts += [text[last:a], f"[{KINDS[k].upper()}]"]
                        last = b
                    texts[i] = "".join([*parts, text[last:]])
                    if sizes is not None:
                        sizes[i] = len(texts[i])
            arrays[at] = pa.array(texts, pa.string())
            if sizes is not None:
                arrays[counted] = pa.array(sizes, batch.column(counted).type)
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return docs.mapInArrow(run, schema)
