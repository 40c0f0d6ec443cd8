"""Token ids of whole texts with the tokenizers library, by way of a cache of words.

Both public vocabularies split a text at white space before merging, so a word's ids don't depend on
its neighbours.  Each distinct word is encoded by the library once a worker; a text is the joined ids of
its words.  Texts that hold an added token's own string, those with the rare separators U+001C..U+001F (on which Python and
the library differ), and vocabularies of any other kind are encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_BYTE_LEVEL = re.compile(rf" ?[{_LETTERS}]+(?=[,.\s]|$)| ?\S+|\s+(?!\S)|\s+")
_SIGNS = ".,!?%#*&$;:"
#: Marks a key that no space precedes.
_ALONE = "\0"
_ODD = (_ALONE, "\x1c", "\x1d", "\x1e", "\x1f")


def _signs_of_bytes() -> dict[int, str]:
    """Byte -> its sign in byte-level vocabularies: itself where it prints, else the next free one from U+0100."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(0x100 + i) for i, b in enumerate(others)}


_SIGN_OF_BYTE = _signs_of_bytes()


class Encoder:
    """Encodes lists of texts to little-endian unsigned 32-bit ids, as the library does with add_special_tokens=False.

    The words of a list of texts are numbered against those known by one dictionary encoding; new ones are
    encoded, and the texts' ids are gathered from the words' ids.  ``special_as_text``: the strings of added tokens in a text
    are ordinary text; by default they become those tokens, as the library has it.  ``cache_words`` bounds the words
    held between lists (beyond it the newer half goes).
    """

    def __init__(self, path: str, cache_words: int = 500_000, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.cache_words = cache_words
        self.known = pa.array([], pa.string())  # word i has flat[start[i] : start[i] + size[i]]
        self.flat, self.start, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bare: dict[str, bytes] = {}  # words without signs, to build those with signs from
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        self.whole_if = (*_ODD, *(t["content"] for t in spec.get("added_tokens") or []))
        self.kind = None
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and norm is None:
            self.kind = "bytes"
        elif before.get("type") == "Sequence" and [x["type"] for x in before["pretokenizers"]] == ["Split", "ByteLevel"]:
            split = before["pretokenizers"][0]
            if split["behavior"] == "Removed" and split["invert"] and split["pattern"].get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"):
                self.kind = "words"

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: list[str]) -> list[bytes]:
        """The ids of new keys.

        A word and the signs after it are parted, as the word is often known.  A word of Latin letters goes to the library's
        model at once, a byte written as the sign that the vocabulary has for it; others take the library's whole way.
        """
        tokenize, bare, words = self.tokenizer.model.tokenize, self.bare, self.kind == "words"
        start, out, rest, signs = "" if words else _SIGN_OF_BYTE[32], [b""] * len(keys), [], {}
        for i, key in enumerate(keys):
            word = key if key.isalpha() else key.rstrip(_SIGNS)
            if not word.isalpha() or not word.isascii() and max(word) >= "\u0100":
                rest.append(i)
                continue
            ids = bare.get(word)
            if ids is None:
                shown = word.lower() if words else word
                if not word.isascii():
                    shown = shown.encode().decode("latin-1").translate(_SIGN_OF_BYTE)
                ids = bare[word] = array("I", [t.id for t in tokenize(start + shown)]).tobytes()
            if len(word) < len(key):
                after = key[len(word) :]
                if after not in signs:
                    signs[after] = self._whole([after])[0]
                ids += signs[after]
            out[i] = ids
        for lo in range(0, len(rest), 4096):
            part = rest[lo : lo + 4096]
            for i, ids in zip(part, self._whole([self._shown(keys[i]) for i in part])):
                out[i] = ids
        return out

    def _shown(self, key: str) -> str:
        """What a key stands for in its text."""
        if self.kind == "words" or key[:1] == "\n":
            return key
        return key[1:] if key[:1] == _ALONE else " " + key

    def _split(self, text: str) -> list[str]:
        """The keys of any text."""
        if self.kind == "words":
            return text.split()
        return [w[1:] if w[0] == " " and len(w) > 1 and not w[1].isspace() else _ALONE + w for w in _BYTE_LEVEL.findall(text)]

    def _gathered(self, keys: pa.Array, ends: np.ndarray) -> list[bytes]:
        """The ids of runs of keys that end at ``ends``."""
        if len(self.known) > self.cache_words:
            held = self.cache_words // 2
            self.known, self.bare = pa.concat_arrays([self.known.slice(0, held), pa.array([], pa.string())]), dict(islice(self.bare.items(), held))
            self.start, self.size = self.start[:held], self.size[:held]
            self.flat = self.flat[: int(self.start[-1] + self.size[-1])] if held else self.flat[:0]
        numbered, n = pa.concat_arrays([self.known, keys]).dictionary_encode(), len(self.known)
        if len(numbered.dictionary) > n:
            blobs = self._learn(numbered.dictionary.slice(n).to_numpy(zero_copy_only=False).tolist())
            size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(blobs), "<u4")])
            self.known = numbered.dictionary
        code = numbered.indices.slice(n).to_numpy()
        size = self.size[code]
        last = np.cumsum(size)
        at = np.repeat(self.start[code] - last + size, size)
        at += np.arange(len(at))
        ids, last = self.flat[at], np.concatenate([[0], last])
        bounds = last[np.concatenate([[0], ends])].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str], end: bytes = b"") -> list[bytes]:
        """The ids of each text, followed by ``end``."""
        out, plain, shown, other = [b""] * len(texts), [], [], []
        for i, t in enumerate(texts):
            if self.kind is None or any(o in t for o in self.whole_if):
                out[i] = self._whole([t])[0]
            elif not (bare := t.replace("\n", "")).isprintable():
                other.append(i)
            elif self.kind == "words":  # the only white space are spaces and line ends
                plain.append(i)
                shown.append(t if len(bare) == len(t) else t.replace("\n", " "))
            elif "  " not in t and "\n\n" not in t and " \n" not in t:  # a key is a word after one space, or a line end and a word
                plain.append(i)
                shown.append(_ALONE + (t if len(bare) == len(t) else t.replace("\n", " \n")))
            else:
                other.append(i)
        if plain:
            split = pc.split_pattern(pa.array(shown, pa.string()), " ")
            for i, ids in zip(plain, self._gathered(split.flatten(), split.offsets.to_numpy()[1:])):
                out[i] = ids
        if other:
            split = [self._split(texts[i]) for i in other]
            keys = pa.array([k for s in split for k in s], pa.string())
            for i, ids in zip(other, self._gathered(keys, np.cumsum([len(s) for s in split]))):
                out[i] = ids
        return [ids + end for ids in out] if end else out


_held: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process, kept between tasks."""
    if path not in _held:
        _held[path] = Encoder(path)
    return _held[path]
