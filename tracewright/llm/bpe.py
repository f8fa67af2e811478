"""Byte-pair merges of whole batches of words at once, in numpy.

A word's merges depend on the word alone: of its neighbouring pairs the one of least order is merged, the leftmost of
equals, until no pair is known. Words of one length take a step together and then have one symbol less, so a batch
needs as many steps as its longest word has symbols, however many words there are, and no word's ids need be kept
from batch to batch.
"""

from __future__ import annotations

import numpy as np

#: Order of a pair that is not merged.
NONE = np.int32(2**31 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Merges:
    """Pairs of symbols with their order and what they merge into; looked up by open addressing."""

    def __init__(self, left, right, order, result):
        left, right = (np.asarray(x, np.uint64) for x in (left, right))
        keys = left << np.uint64(32) | right
        self.bits = np.uint64(64 - max(8, int(np.ceil(np.log2(len(keys) * 4 + 1)))))
        #: The last entry stands for an empty slot.
        self.keys = np.append(keys, np.uint64(2**64 - 1))
        self.order = np.append(np.asarray(order, np.int32), NONE)
        self.result = np.append(np.asarray(result, np.int32), np.int32(-1))
        self.slots = np.full(1 << int(64 - int(self.bits)), len(keys), np.int32)
        self.mask = np.int64(len(self.slots) - 1)
        todo, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(todo):
            free = self.slots[at] == len(keys)
            self.slots[at[free]] = todo[free]  # of several, the last one written stays
            lost = self.slots[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & self.mask
        #: What a pair of an order becomes, where all pairs of that order become the same; else -1.
        self.by_order = np.full(int(self.order[:-1].max(initial=0)) + 1, -2, np.int32)
        self.by_order[self.order[:-1]] = self.result[:-1]
        self.by_order[self.order[:-1][self.by_order[self.order[:-1]] != self.result[:-1]]] = -1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> self.bits).astype(np.int64)

    def _entries(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = self._home(keys)
        out = self.slots[at]
        last = len(self.keys) - 1
        miss = np.flatnonzero((self.keys[out] != keys) & (out != last))
        while len(miss):
            at[miss] = (at[miss] + 1) & self.mask
            out[miss] = self.slots[at[miss]]
            miss = miss[(self.keys[out[miss]] != keys[miss]) & (out[miss] != last)]
        return out

    def orders(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.order[self._entries(left.ravel(), right.ravel())].reshape(left.shape)

    def merged(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that words are merged into, one word after the other, and where each begins (one offset more than words). Words are not empty."""
        sizes = np.diff(offsets)
        by_size = np.argsort(-sizes, kind="stable")
        done: list[tuple[np.ndarray, np.ndarray]] = []
        longest = int(sizes.max(initial=0))
        words = np.zeros(0, np.int64)
        text, order = np.zeros((longest + 1, 0), np.int32), np.zeros((longest, 0), np.int32)
        upto = 0
        for size in range(longest, 0, -1):
            # Here text is (size, words) and order (size - 1, words): one column for each word.
            upto, old = int(np.searchsorted(-sizes[by_size], -size, "right")), upto
            new = by_size[old:upto]
            if len(new) or size == longest:
                fresh = symbols[offsets[new][None, :] + np.arange(size)[:, None]].astype(np.int32)
                text = np.concatenate([text[:size], fresh], axis=1)
                order = np.concatenate([order[: size - 1], self.orders(fresh[:-1], fresh[1:])], axis=1)
                words = np.concatenate([words, new])
            if size == 1 or not len(words):
                if len(words):
                    done.append((words, text))
                continue
            at = order.argmin(axis=0)
            each = np.arange(len(words))
            least = order[at, each]
            stay = least == NONE
            if stay.any():
                done.append((words[stay], text[:, stay]))
                go = ~stay
                words, text, order, at, least = words[go], text[:, go], order[:, go], at[go], least[go]
                each = np.arange(len(words))
            now = self.by_order[least]
            unsure = np.flatnonzero(now < 0)
            if len(unsure):
                now[unsure] = self.result[self._entries(text[at[unsure], unsure], text[at[unsure] + 1, unsure])]
            rows = np.arange(size - 1)[:, None]
            text = np.where(rows <= at, text[:-1], text[1:])
            text[at, each] = now
            order = np.where(rows[:-1] < at, order[:-1], order[1:])
            before, behind = np.flatnonzero(at > 0), np.flatnonzero(at < size - 2)
            order[at[before] - 1, before] = self.orders(text[at[before] - 1, before], now[before])
            order[at[behind], behind] = self.orders(now[behind], text[at[behind] + 1, behind])
        left = np.zeros(len(sizes), np.int64)
        for words, text in done:
            left[words] = len(text)
        ends = np.cumsum(left)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for words, text in done:
            out[(ends[words] - left[words])[None, :] + np.arange(len(text))[:, None]] = text
        return out, np.append(0, ends)
