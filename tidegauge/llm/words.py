"""Words of whole texts as arrays.

Separators are ASCII, and no byte of a longer UTF-8 sign is, so texts are cut at byte level: a batch takes a few passes of numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Each byte with A-Z lowered.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def bytes_of(signs: str | range) -> np.ndarray:
    """Table of 256: whether a byte is among ``signs``."""
    out = np.zeros(256, dtype=bool)
    out[[ord(s) for s in signs] if isinstance(signs, str) else list(signs)] = True
    return out


@dataclass
class Words:
    """The words of some texts in order."""

    values: object  # distinct words (Arrow strings)
    codes: np.ndarray  # of each word: its place among values
    row: np.ndarray  # its text's row
    place: np.ndarray  # its number in the text
    part: np.ndarray  # differs between words that a break or a text's end lies between
    fresh: np.ndarray  # false if an earlier window of the text has given the word already
    last: bool  # whether no later window of these texts follows


def gathered(batches, size: int) -> Iterator:
    """Tables of consecutive Arrow batches, of about ``size`` bytes of the column text."""
    import pyarrow as pa

    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.column("text").nbytes
        if total >= size:
            yield pa.Table.from_batches(held)
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _cut(data: np.ndarray, edges: np.ndarray, word: np.ndarray, breaks: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of the texts between ``edges`` of ``data``, and the byte at which each starts."""
    import pyarrow as pa

    low = LOWER[data]
    inside = word[low]
    first, end = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    heads, tails = edges[:-1][edges[:-1] < len(data)], edges[1:][edges[1:] > 0] - 1
    first[heads], end[tails] = inside[heads], inside[tails]
    start = np.flatnonzero(first)
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(np.flatnonzero(end) + 1 - start, out=offsets[1:])
    coded = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(low[inside])).dictionary_encode()
    at = np.searchsorted(start, edges)
    row = np.repeat(np.arange(len(edges) - 1), np.diff(at))
    part = np.cumsum(breaks[low], dtype=np.int32)[start] + row
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return Words(coded.dictionary, codes, row, np.arange(len(start)) - at[row], part, np.ones(len(start), bool), True), start


def cut_words(texts, word: np.ndarray, breaks: np.ndarray, overlap: int, size: int = 1 << 24) -> Iterator[tuple[int, int, Words]]:
    """(first row, rows, words) of groups of texts of about ``size`` bytes.

    A longer text comes alone, in windows of that size cut between words; each window repeats the last ``overlap`` words of the one
    before (not fresh there), so that phrases of up to ``overlap`` + 1 words lie whole in one window.  ``texts``: Arrow strings without nulls.
    """
    import pyarrow as pa

    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        held = data[offsets[lo] : offsets[hi]]
        if len(held) <= size:
            yield lo, hi - lo, _cut(held, offsets[lo : hi + 1] - offsets[lo], word, breaks)[0]
        else:
            for words in _windows(held, word, breaks, overlap, size):
                yield lo, 1, words
        lo = hi


def _windows(data: np.ndarray, word: np.ndarray, breaks: np.ndarray, overlap: int, size: int) -> Iterator[Words]:
    lo = hi = before = again = 0
    while hi < len(data):
        hi = min(len(data), hi + size)
        while hi < len(data):  # on to the next sign that is no word's
            ends = np.flatnonzero(~word[LOWER[data[hi : hi + 4096]]])
            hi = hi + int(ends[0]) if len(ends) else min(len(data), hi + 4096)
            if len(ends):
                break
        words, start = _cut(data[lo:hi], np.array([0, hi - lo]), word, breaks)
        words.place += before - again
        words.fresh[:again], words.last = False, hi >= len(data)
        yield words
        before += len(start) - again
        again = min(overlap, len(start))
        lo = lo + int(start[len(start) - again]) if again else hi
