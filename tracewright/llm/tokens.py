"""Encoding with the tables of the tokenizers library: words are cut and merged in numpy, odd ones by the library."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa

from .bpe import Merges
from .bytesx import buffers, slices

#: Bytes of texts that are worked on together, unless one text is longer. Each different word of these is merged once.
TOGETHER = 4 << 20
#: Bytes of a word beyond which the library merges it.
LONG = 64
#: White space by any library's rules, but for spaces and line feeds: texts with these are encoded whole.
ODD_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85᠎​﻿]")
#: Bytes that any odd white space begins with.
MAYBE_ODD = np.isin(np.arange(256), [0x09, 0x0B, 0x0C, 0x0D, *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]).astype(np.int64)
NONE = np.zeros(0, np.uint32)

#: Classes of characters. A run without white space that has an ODD one (an apostrophe, which may begin a contraction, or a character from U+0180 on) is encoded whole, by the library.
BLANK, LETTER, NUMBER, OTHER, ODD = range(5)


def _class(c: str) -> int:
    if c in " \n":
        return BLANK
    if c == "'" or unicodedata.category(c)[0] in "CZ":
        return ODD
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER)


ONE = np.array([_class(chr(x)) if x < 128 else ODD for x in range(256)], np.uint8)
#: Characters of two bytes, up to U+017F.
TWO = np.array([ODD] * 128 + [_class(chr(x)) for x in range(128, 0x180)], np.uint8)
LOWER = np.array([ord(chr(x).lower()) if len(chr(x).lower()) == 1 else x for x in range(0x180)], np.uint16)
TWO[[x for x in range(128, 0x180) if not 128 <= LOWER[x] < 0x180 or len(chr(x).lower()) > 1]] = ODD


def _byte_chars() -> list[str]:
    """How vocabularies of bytes write each byte: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def _shape(spec: dict) -> str | None:
    """Which of two known ways to cut words a tokenizer file asks for; None: neither, so that whole texts go to the library.

    "spaced": a space belongs to the word behind it; "ended": white space and case vanish, and words end in a mark.
    """
    model, pre, normal = spec.get("model", {}), spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    if not plain or any(t.get("normalized") or t.get("single_word") for t in spec.get("added_tokens", [])):
        return None
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and normal is None and not model.get("end_of_word_suffix"):
        return "spaced"
    first, *rest = pre.get("pretokenizers") or [pre]
    cuts = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    if first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True and first.get("pattern", {}).get("Regex") == cuts and [x.get("type") for x in rest] == ["ByteLevel"] and not rest[0].get("use_regex") and not rest[0].get("add_prefix_space"):
        steps = (normal or {}).get("normalizers") or []
        if [x.get("type") for x in steps] == ["NFC", "Replace", "Lowercase"] and steps[1].get("pattern") == {"Regex": r"\s+"} and steps[1].get("content") == " " and model.get("end_of_word_suffix"):
            return "ended"
    return None


class Encoder:
    """The ids of whole texts, equal to the library's encode(text, add_special_tokens=False).

    Nothing is kept from batch to batch but the tables of the vocabulary.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        #: Strings that the library turns into one id wherever they stand; a text with one is encoded whole.
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.shape = _shape(spec)
        if self.shape:
            vocab, end = spec["model"]["vocab"], spec["model"].get("end_of_word_suffix") or ""
            pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
            self.merges = Merges([vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], range(len(pairs)), [vocab[a + b] for a, b in pairs])
            self.byte = np.array([vocab[c] for c in _byte_chars()], np.int32)
            self.last = np.array([vocab[c + end] for c in _byte_chars()], np.int32)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _words(self, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, starts and ends of the words of texts that begin at `at`; words may leave out white space."""
        n = len(text)
        kind = ONE[text]
        two = np.flatnonzero((text[:-1] >= 0xC2) & (text[:-1] <= 0xC5))
        if len(two):
            code = ((text[two] & 0x1F).astype(np.int32) << 6) | (text[two + 1] & 0x3F)
            kind[two] = kind[two + 1] = TWO[code]
        blank = kind == BLANK
        start = np.zeros(n + 1, bool)
        start[at] = True
        # A piece: white space and all up to the next white space. One with an odd character stays whole.
        head = start[:-1].copy()
        head[1:] |= blank[1:] & ~blank[:-1]
        heads = np.flatnonzero(head)
        whole = np.logical_or.reduceat(kind == ODD, heads)
        inside = np.repeat(whole, np.diff(np.append(heads, n))) if whole.any() else np.zeros(n, bool)
        cut = kind[1:] != kind[:-1]
        # The last blank of several, and a line feed, stand alone but for a single space before a word.
        ahead = blank[1:] & blank[:-1]
        ahead[:-1] &= ~blank[2:] & ~start[2:-1]
        ahead[-1:] = False
        if self.shape == "spaced":
            cut &= ~((text[:-1] == 0x20) & blank[:-1])
            cut |= ahead
        else:
            cut |= (kind[1:] == NUMBER) & (text[1:] & 0xC0 != 0x80)
        head[1:] |= cut & ~inside[1:]
        starts = np.flatnonzero(head)
        ends = np.append(starts[1:], n)
        if self.shape == "ended":
            text = np.where((text >= 65) & (text <= 90), text | 32, text)
            if len(two):
                low = LOWER[code]
                change = TWO[code] != ODD
                text[two[change]] = (0xC0 | low >> 6)[change]
                text[two[change] + 1] = (0x80 | low & 0x3F)[change]
            held = ~blank[starts] | inside[starts]
            starts, ends = starts[held], ends[held]
        return text, starts, ends

    def _encoded(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words one after the other, and where each word's begin."""
        data, offsets = buffers(words)
        sizes = np.diff(offsets)
        kind = ONE[data]
        two = np.flatnonzero((data[:-1] >= 0xC2) & (data[:-1] <= 0xC5))
        kind[two] = kind[two + 1] = TWO[((data[two] & 0x1F).astype(np.int32) << 6) | (data[two + 1] & 0x3F)]
        odd = np.logical_or.reduceat(kind == ODD, offsets[:-1]) | (sizes > LONG)
        by_library = np.flatnonzero(odd)
        lists = [got.ids for got in self.library.encode_batch_fast(words.take(pa.array(by_library)).to_pylist(), add_special_tokens=False)]
        easy = ~odd
        symbols = self.byte[data]
        symbols[offsets[1:] - 1] = self.last[data[offsets[1:] - 1]]
        ids, where = self.merges.merged(symbols[np.repeat(easy, sizes)], np.append(0, np.cumsum(sizes[easy])))
        out = np.empty(len(sizes), np.int64)
        out[easy] = np.diff(where)
        out[by_library] = [len(x) for x in lists]
        ends = np.cumsum(out)
        flat = np.empty(int(ends[-1]), np.uint32)
        mine = np.repeat(easy, out)
        flat[mine] = ids
        flat[~mine] = np.fromiter(chain.from_iterable(lists), np.uint32)
        return flat, np.append(0, ends)

    def _asks_library(self, column: pa.Array, text: np.ndarray, at: np.ndarray, first: int) -> np.ndarray:
        """Which texts are encoded whole: those with odd white space or a special token's string."""
        maybe = np.add.reduceat(np.append(MAYBE_ODD[text], 0), at[:-1]) * (np.diff(at) > 0) > 0
        raw = text.tobytes()
        found = any(s in raw for s in self.special)
        for d in range(len(maybe)) if found else np.flatnonzero(maybe):
            own = raw[at[d] : at[d + 1]]
            maybe[d] = any(s in own for s in self.special) or (maybe[d] and ODD_SPACE.search(own.decode()) is not None)
        return maybe

    def texts(self, column: pa.Array):
        """The ids of each text of a column, in order; null is empty."""
        data, offsets = buffers(column)
        for i, j in slices(offsets, TOGETHER):
            at = offsets[i : j + 1] - offsets[i]
            text = data[offsets[i] : offsets[j]]
            if not self.shape or len(text) == 0:
                yield from (self._whole(column[i + d].as_py()) if at[d + 1] > at[d] else NONE for d in range(j - i))
                continue
            whole = self._asks_library(column, text, at, i)
            text, starts, ends = self._words(text, at)
            if len(starts) == 0:
                yield from (self._whole(column[i + d].as_py()) if whole[d] else NONE for d in range(j - i))
                continue
            sizes = ends - starts
            bounds = np.append(0, np.cumsum(sizes)).astype(np.int32)
            if bounds[-1] < len(text):
                held = np.zeros(len(text) + 1, np.int8)
                held[starts] += 1
                held[ends] -= 1
                text = text[np.cumsum(held[:-1], dtype=np.int8) > 0]
            coded = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(text))).dictionary_encode()
            ids, where = self._encoded(coded.dictionary)
            number = coded.indices.to_numpy()
            length = np.diff(where)[number]
            ends = np.cumsum(length)
            ids = ids[np.repeat(where[number] - ends + length, length) + np.arange(int(ends[-1]))]
            own = np.append(0, ends)[np.searchsorted(starts, at)].tolist()
            for d in range(j - i):
                yield self._whole(column[i + d].as_py()) if whole[d] else ids[own[d] : own[d + 1]]

    def encode(self, text: str) -> np.ndarray:
        return next(self.texts(pa.array([text], pa.string())))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each path and Python worker; it holds the vocabulary's tables only."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
