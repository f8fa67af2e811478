"""SentencePiece encoding and decoding; giant documents by a max-plus parallel scan over chunks.

Two model types, one scheme: a giant document is cut into chunks, each chunk yields a transfer matrix over the states at
its borders, matrices combine associatively, and each chunk is then traced back alone.

* unigram: a state is the number of characters beyond a border that the last piece covers, a matrix has the best scores.
  Scores are whole numbers, so sums do not depend on how they are grouped, and of equal segmentations the one of the
  longest last piece wins, in a chunk as in a whole text.
* bpe: scores are merge ranks, whose highest sum is not what merging gives. But no merge crosses a border between two
  characters that no piece has side by side, so a text falls into units that are merged alone, and the state at a border
  is where the unit open there begins. A chunk whose last unit begins at c turns a state x into max(x, c): in max-plus
  terms the matrix [[0, c], [-inf, 0]], and the scan is a running maximum. Each chunk is then traced alone: it merges
  the units that begin in it, with the ends of the last one from the chunks behind.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import Merges
from .bytesx import buffers, slices
from .common import Scratch
from .lines import keyed

#: Bytes (bpe) or characters (unigram) of a document from which it is split into chunks, and of a chunk.
GIANT, CHUNK = 32_768, 8_192
#: Bytes of texts that are worked on together; each different unit of these is merged once.
TOGETHER = 4 << 20
#: Characters of a unit beyond which the library merges it.
LONG = 64
#: Units whose best segmentation a worker keeps (unigram).
KEPT = 100_000
#: What the library takes off the least score for a character that no piece covers.
UNKNOWN = 10.0
#: Scores are counted in whole parts of 2 ** -24.
SCALE = 1 << 24
NEVER = -(1 << 62)
_UNIT = re.compile("▁*[^▁]+|▁+")


def _fields(data: bytes):
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


def _message(data: bytes, number: int) -> dict[int, object]:
    return dict(_fields(next((v for k, v in _fields(data) if k == number), b"")))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product, associative: best over the state between."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), NEVER)


class Unigram:
    """The segmentation of highest total score, which is the library's encoding for models of type unigram."""

    def __init__(self, sp):
        self.library = sp
        self.byte, self.score, self.id = {}, {}, {}
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)):
                self.score[piece], self.id[piece] = round(sp.get_score(i) * SCALE), i
        self.longest = max(map(len, self.score))
        self.unknown = min(self.score.values()) - round(UNKNOWN * SCALE)
        #: Whether no piece goes from another character on to ▁: then a unit, ▁s and all up to the next ▁, stands alone.
        self.units = not any("▁" in p.lstrip("▁") for p in self.score)
        self.memo: dict[str, list[int]] = {}

    def ids_of(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            if p in self.id:
                out.append(self.id[p])
            elif self.byte:
                out += [self.byte[b] for b in p.encode()]
            else:
                out.append(self.library.unk_id())
        return out

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """Without byte pieces, unknown characters in a row are one unknown piece."""
        if self.byte or not len(ids):
            return ids
        unknown = ids == self.library.unk_id()
        return ids[np.append(True, ~(unknown[1:] & unknown[:-1]))]

    def steps(self, text: str, at: int, stop: int):
        """(end, score) of each piece at a place, no further than stop; an uncovered character is a piece too."""
        get, single = self.score.get, False
        for end in range(at + 1, min(at + self.longest, stop) + 1):
            s = get(text[at:end])
            if s is not None:
                single |= end == at + 1
                yield end, s
        if not single:
            yield at + 1, self.unknown

    def ahead(self, text: str, size: int, entry: list[int]) -> tuple[list[int], list[int]]:
        """(score, back) at each place up to size + longest - 1, for pieces that begin before size: entry has the scores of beginning at 0, 1, ...; back is -1 where the piece before a place began before the text."""
        n = min(len(text), size + self.longest - 1)
        score, back = [NEVER] * (n + 1), [-1] * (n + 1)
        for k, s in enumerate(entry[: n + 1]):
            score[k] = s
        for at in range(size):
            base = score[at]
            if base <= NEVER // 2:
                continue
            for end, s in self.steps(text, at, n):
                if base + s > score[end]:
                    score[end], back[end] = base + s, at
        return score, back

    def best(self, text: str) -> list[int]:
        return self.trace(text, len(text), [0], 0)[0]

    def trace(self, text: str, size: int, entry: list[int], beyond: int) -> tuple[list[int], int]:
        """Ids of the pieces that begin in a chunk whose last piece covers `beyond` characters behind it, and how many of its characters pieces from before cover."""
        _, back = self.ahead(text, size, entry)
        cuts, at = [], size + beyond
        while at and back[at] >= 0:
            cuts.append(text[back[at] : at])
            at = back[at]
        return self.ids_of(cuts[::-1]), at

    def lattice(self, normal: str) -> np.ndarray:
        """Ids of the best segmentation of a normalised text."""
        out: list[int] = []
        for u in _UNIT.findall(normal) if self.units else [normal] if normal else []:
            if u not in self.memo:
                if len(self.memo) > KEPT:
                    self.memo.clear()
                self.memo[u] = self.best(u)
            out += self.memo[u]
        return self.joined(np.array(out, np.uint32))

    def texts(self, column: pa.Array):
        """(ids, whether they decode to the text) of each text."""
        for t in column.to_pylist():
            ids = self.lattice(self.library.normalize(t)) if t else np.zeros(0, np.uint32)
            yield ids, self.library.decode(ids.tolist()) == (t or "")

    # -- max-plus transfer matrices

    def transfer(self, text: str, size: int) -> np.ndarray:
        """matrix[i, j]: the best score of text's first `size` characters, if a piece from before covers i of them and the last piece covers j characters beyond; the characters beyond are in text too."""
        width = self.longest
        score = np.full((size + width, width), NEVER, np.int64)
        score[np.arange(width), np.arange(width)] = 0
        for at in range(size):
            if (score[at] > NEVER // 2).any():
                for end, s in self.steps(text, at, min(len(text), size + width - 1)):
                    np.maximum(score[end], score[at] + s, out=score[end])
        return np.maximum(score[size : size + width].T, NEVER)


class Bpe:
    """The library's encoding by models of type bpe: texts are cut into units, and each different one is merged once."""

    def __init__(self, sp):
        self.library = sp
        proto = sp.serialized_model_proto()
        size = sp.vocab_size()
        pieces = {i: sp.id_to_piece(i) for i in range(size) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i) or sp.is_byte(i))}
        byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        kept = sp.normalize("a b") == "▁a▁b" and sp.normalize(" a  b ") == "▁▁a▁▁b▁" and not _message(proto, 3).get(2)
        unused = any(sp.is_unused(i) for i in range(size))
        #: Whether units can be found: spaces are kept, others characters are not changed, and no piece has a line feed.
        self.easy = len(byte) == 256 and kept and not unused and not any("\n" in p or " " in p for p in pieces.values()) and sp.encode("\n") == [sp.piece_to_id("▁"), byte[10]]
        if not self.easy:
            return
        number = {p: i for i, p in pieces.items()}
        spaced = [p.replace("▁", " ").encode() for p in pieces.values()]
        #: Bytes that a piece has side by side; everywhere else a unit ends.
        self.beside = np.zeros((256, 256), bool)
        for p in spaced:
            raw = np.frombuffer(p, np.uint8)
            self.beside[raw[:-1], raw[1:]] = True
        self.symbol = np.full(0x110000, -1, np.int32)
        self.symbol[list(range(128))] = [byte[b] for b in range(128)]
        for p, i in number.items():
            if len(p) == 1:
                self.symbol[0x20 if p == "▁" else ord(p)] = i
        score = {p: sp.get_score(i) for p, i in number.items()}
        order = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        pairs = [(number[p[:k]], number[p[k:]], order[score[p]], i) for p, i in number.items() for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
        self.merges = Merges(*zip(*pairs))
        #: What each id stands for, one after the other.
        stands = [b"" for _ in range(size)]
        for i, p in zip(pieces, spaced):
            stands[i] = p
        for b, i in byte.items():
            stands[i] = bytes([b])
        self.sizes = np.array([len(x) for x in stands], np.int64)
        self.at = np.append(0, np.cumsum(self.sizes))
        self.stands = np.frombuffer(b"".join(stands), np.uint8)

    def cuts(self, text: np.ndarray) -> np.ndarray:
        """Where a unit begins, but for the first place: at a character that no piece has behind the one before it."""
        return ~self.beside[text[:-1], text[1:]] & (text[1:] & 0xC0 != 0x80)

    def _unit(self, units: list[str]) -> list[list[int]]:
        """The library's ids of single units: behind a line feed no space is put before them."""
        return [x[2:] for x in self.library.encode(["\n" + u for u in units], num_threads=1)] if units else []

    def _encoded(self, units: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of different units one after the other, where each one's begin, and whether they stand for just its bytes."""
        data, offsets = buffers(units)
        code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        chars = np.append(0, np.cumsum(data & 0xC0 != 0x80))[offsets]
        symbols = self.symbol[code]
        odd = np.logical_or.reduceat(symbols < 0, chars[:-1]) | (np.diff(chars) > LONG)
        by_library = np.flatnonzero(odd)
        lists = self._unit(units.take(pa.array(by_library)).to_pylist())
        easy = ~odd
        ids, where = self.merges.merged(symbols[np.repeat(easy, np.diff(chars))], np.append(0, np.cumsum(np.diff(chars)[easy])))
        n = np.empty(len(units), np.int64)
        n[easy] = np.diff(where)
        n[by_library] = [len(x) for x in lists]
        ends = np.cumsum(n)
        flat = np.empty(int(ends[-1]), np.uint32)
        mine = np.repeat(easy, n)
        flat[mine] = ids
        flat[~mine] = np.array([x for one in lists for x in one], np.uint32)
        where = np.append(0, ends)
        size = self.sizes[flat]
        total = np.append(0, np.cumsum(size))
        same = np.diff(total[where]) == np.diff(offsets)
        if same.all():
            stand = self.stands[np.repeat(self.at[flat] - total[:-1], size) + np.arange(int(total[-1]))]
            same = ~np.logical_or.reduceat(stand != data, offsets[:-1])
        else:
            raw = data.tobytes()
            same = np.array([b"".join(self.stands[self.at[x] : self.at[x + 1]].tobytes() for x in flat[where[k] : where[k + 1]].tolist()) == raw[offsets[k] : offsets[k + 1]] for k in range(len(units))])
        return flat, where, same

    def stretches(self, text: np.ndarray, at: np.ndarray):
        """(ids, whether they stand for just the bytes) of each stretch from at[k] to at[k + 1], all of which begin with a unit."""
        if len(text) == 0:
            yield from ((np.zeros(0, np.uint32), True) for _ in at[1:])
            return
        head = np.append(True, self.cuts(text))
        head[at[at < len(text)]] = True
        starts = np.flatnonzero(head)
        bounds = np.append(starts, len(text)).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(text))).dictionary_encode()
        ids, where, same = self._encoded(coded.dictionary)
        number = coded.indices.to_numpy()
        length = np.diff(where)[number]
        ends = np.cumsum(length)
        ids = ids[np.repeat(where[number] - ends + length, length) + np.arange(int(ends[-1]))]
        first = np.searchsorted(starts, at)
        own = np.append(0, ends)[first]
        wrong = np.append(0, np.cumsum(~same[number]))[first]
        for k in range(len(at) - 1):
            yield ids[own[k] : own[k + 1]], bool(wrong[k] == wrong[k + 1])

    def plain(self, text: bytes) -> bool:
        """Whether a text goes by units: not if it has the character that stands for spaces in pieces."""
        return self.easy and "▁".encode() not in text

    def whole(self, text: str) -> tuple[np.ndarray, bool]:
        ids = self.library.encode(text)
        return np.array(ids, np.uint32), self.library.decode(ids) == text

    def texts(self, column: pa.Array):
        """(ids, whether they decode to the text) of each text."""
        data, offsets = buffers(column)
        for i, j in slices(offsets, TOGETHER):
            at, text = offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]]
            raw = text.tobytes()
            if self.plain(raw):
                some = np.diff(at) > 0
                spaced = np.insert(text, at[:-1][some], 0x20)
                yield from self.stretches(spaced, at + np.append(0, np.cumsum(some)))
            elif j == i + 1:
                yield self.whole(raw.decode())
            else:
                for d in range(i, j):
                    yield from self.texts(column.slice(d, 1))


_models: dict[str, Unigram | Bpe] = {}


def model(path: str) -> Unigram | Bpe:
    """One for each path and Python worker."""
    if path not in _models:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = _message(sp.serialized_model_proto(), 2).get(3, 1)
        if kind not in (1, 2):
            raise ValueError("a model of type unigram or bpe")
        _models[path] = Unigram(sp) if kind == 1 else Bpe(sp)
    return _models[path]


def _bytes(rows) -> pa.Array:
    return pa.array([np.asarray(x, "<u4").tobytes() for x in rows], pa.binary())


def whole(path: str):
    """For mapInArrow over (id, tkey, text): (id, tkey, ids, same)."""

    def run(batches):
        m = model(path)
        for batch in batches:
            got = list(m.texts(batch.column(2)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], _bytes(x for x, _ in got), pa.array([s for _, s in got], pa.bool_())], names=["id", "tkey", "ids", "same"])

    return run


def joined(path: str):
    """For mapInArrow over (id, tkey, parts array<struct<k, ids, same>> in order): (id, tkey, ids, same)."""

    def run(batches):
        m = model(path)
        for batch in batches:
            ids, same = [], []
            for parts in batch.column(2).to_pylist():
                raw = b"".join(p["ids"] for p in parts)
                ids.append(m.joined(np.frombuffer(raw, "<u4")) if isinstance(m, Unigram) else np.frombuffer(raw, "<u4"))
                same.append(all(p["same"] for p in parts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], _bytes(ids), pa.array(same, pa.bool_())], names=["id", "tkey", "ids", "same"])

    return run


# -- chunks of models of type bpe


def bpe_chunks(path: str, size: int):
    """For mapInArrow over (id, tkey, text): (id, tkey, k, last, head, rest): the k-th chunk, cut where its first unit begins, and the place in the text where its last unit begins (null: none does)."""

    def run(batches):
        m = model(path)
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for row in range(batch.num_rows):
                text = np.append(np.uint8(0x20), data[offsets[row] : offsets[row + 1]])
                starts = np.flatnonzero(np.append(True, m.cuts(text)))
                for k, a in enumerate(range(0, len(text), size)):
                    b = min(a + size, len(text))
                    own = starts[np.searchsorted(starts, a) : np.searchsorted(starts, b)]
                    cut = int(own[0]) if len(own) else b
                    one = pa.array([row])
                    cols = [pa.array([k], pa.int32()), pa.array([int(own[-1]) if len(own) else None], pa.int64()), pa.array([text[a:cut].tobytes()], pa.binary()), pa.array([text[cut:b].tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(one), batch.column(1).take(one), *cols], names=["id", "tkey", "k", "last", "head", "rest"])

    return run


def bpe_traced(path: str):
    """For mapInArrow over (id, tkey, k, rest, ends array<struct<k, head>>): (id, tkey, k, ids, same): the units that begin in a chunk."""

    def run(batches):
        m = model(path)
        for batch in batches:
            raw = [r + b"".join(e["head"] for e in (ends or [])) for r, ends in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            at = np.append(0, np.cumsum([len(x) for x in raw])).astype(np.int64)
            text = np.frombuffer(b"".join(raw), np.uint8)
            got = [x for i, j in slices(at, TOGETHER) for x in m.stretches(text[at[i] : at[j]], at[i : j + 1] - at[i])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _bytes(x for x, _ in got), pa.array([s for _, s in got], pa.bool_())], names=["id", "tkey", "k", "ids", "same"])

    return run


def bpe_giants(docs: DataFrame, path: str, size: int, kind: str, scratch: Scratch) -> DataFrame:
    """(id, tkey, k, ids, same) of giant documents' chunks. Of the texts only the few bytes of a unit that lie behind its chunk are moved by the scan."""
    key = f"id {kind}, tkey long, k int"
    cut = scratch.table(docs.mapInArrow(bpe_chunks(path, size), f"{key}, last long, head binary, rest binary"), "chunks")
    before = Window.partitionBy("id", "tkey").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    scan = cut.select("id", "tkey", "k", "head", F.max("last").over(before).alias("open")).where(F.octet_length("head") > 0)
    ends = scan.groupBy("id", "tkey", F.expr(f"cast(open div {size} as int)").alias("owner")).agg(F.array_sort(F.collect_list(F.struct("k", "head"))).alias("ends"))
    ends = ends.select(F.col("id").alias("e_id"), F.col("tkey").alias("e_tkey"), "owner", "ends")
    own = cut.where(F.octet_length("rest") > 0)
    both = own.join(ends, (F.col("tkey") == F.col("e_tkey")) & (F.col("k") == F.col("owner")) & F.col("id").eqNullSafe(F.col("e_id")), "left")
    return both.select("id", "tkey", "k", "rest", "ends").mapInArrow(bpe_traced(path), f"{key}, ids binary, same boolean")


# -- chunks of models of type unigram


def unigram_chunks(path: str, size: int):
    """For mapInArrow over (id, tkey, text): (id, tkey, k, n, text): chunks of `size` normalised characters, and after them those that a piece could cover."""

    def run(batches):
        m = model(path)
        for batch in batches:
            for row in range(batch.num_rows):
                t = m.library.normalize(batch.column(2)[row].as_py())
                for k, a in enumerate(range(0, len(t), size)):
                    n, one = min(size, len(t) - a), pa.array([row])
                    cols = [pa.array([k], pa.int32()), pa.array([n], pa.int32()), pa.array([t[a : a + n + m.longest - 1]])]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(one), batch.column(1).take(one), *cols], names=["id", "tkey", "k", "n", "text"])

    return run


def matrices(path: str):
    """For mapInArrow over (id, tkey, k, n, text): (id, tkey, k, matrix)."""

    def run(batches):
        m = model(path)
        for batch in batches:
            got = [m.transfer(t, n).tobytes() for t, n in zip(batch.column(4).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(got, pa.binary())], names=["id", "tkey", "k", "matrix"])

    return run


def scan_ahead(frame: pd.DataFrame) -> pd.DataFrame:
    """The best scores of each state at one document's chunk borders, from its matrices in order. One row and one small matrix for each chunk."""
    frame = frame.sort_values("k")
    width = int((len(frame["matrix"].iloc[0]) // 8) ** 0.5)
    now = np.where(np.arange(width) == 0, 0, NEVER).astype(np.int64)[None, :]
    entry = []
    for raw in frame["matrix"]:
        entry.append(now[0].tobytes())
        now = product(now, np.frombuffer(raw, np.int64).reshape(width, width))
    return pd.DataFrame({"id": frame["id"], "tkey": frame["tkey"], "k": frame["k"], "entry": entry})


def returns(path: str):
    """For mapInArrow over (id, tkey, k, n, text, entry): (id, tkey, k, into): for each state behind a chunk the state before it, traced back; such maps combine associatively too."""

    def run(batches):
        m = model(path)
        for batch in batches:
            got = []
            for n, t, entry in zip(*(batch.column(c).to_pylist() for c in (3, 4, 5))):
                _, back = m.ahead(t, n, np.frombuffer(entry, np.int64).tolist())
                into = []
                for at in range(n, len(back)):
                    while at and back[at] >= 0:
                        at = back[at]
                    into.append(at)
                got.append(into)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(got, pa.list_(pa.int32()))], names=["id", "tkey", "k", "into"])

    return run


def scan_back(frame: pd.DataFrame) -> pd.DataFrame:
    """How many characters beyond each chunk of one document its last piece covers."""
    frame = frame.sort_values("k", ascending=False)
    state, beyond = 0, []
    for into in frame["into"]:
        beyond.append(state)
        state = int(into[state])
    return pd.DataFrame({"id": frame["id"], "tkey": frame["tkey"], "k": frame["k"], "beyond": beyond})


def unigram_traced(path: str):
    """For mapInArrow over (id, tkey, k, n, text, entry, beyond): (id, tkey, k, ids, same)."""

    def run(batches):
        m = model(path)
        for batch in batches:
            got = [m.trace(t, n, np.frombuffer(e, np.int64).tolist(), b)[0] for n, t, e, b in zip(*(batch.column(c).to_pylist() for c in (3, 4, 5, 6)))]
            same = [m.library.unk_id() not in x for x in got]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _bytes(got), pa.array(same, pa.bool_())], names=["id", "tkey", "k", "ids", "same"])

    return run


def unigram_giants(docs: DataFrame, path: str, size: int, kind: str, scratch: Scratch) -> DataFrame:
    """(id, tkey, k, ids, same) of giant documents' chunks: matrices, their scan, maps back, their scan, and each chunk traced alone."""
    key = f"id {kind}, tkey long, k int"
    on = ["id", "tkey", "k"]

    def beside(rows: DataFrame, more: DataFrame) -> DataFrame:
        more = more.withColumnsRenamed({c: f"m_{c}" for c in on})
        return rows.join(more, (F.col("tkey") == F.col("m_tkey")) & (F.col("k") == F.col("m_k")) & F.col("id").eqNullSafe(F.col("m_id"))).drop("m_id", "m_tkey", "m_k")

    cut = scratch.table(docs.mapInArrow(unigram_chunks(path, size), f"{key}, n int, text string"), "chunks")
    entry = cut.repartition(*on).mapInArrow(matrices(path), f"{key}, matrix binary").groupBy("id", "tkey").applyInPandas(scan_ahead, f"{key}, entry binary")
    rows = scratch.table(beside(cut, entry), "entries")
    beyond = rows.mapInArrow(returns(path), f"{key}, into array<int>").groupBy("id", "tkey").applyInPandas(scan_back, f"{key}, beyond int")
    return beside(rows, beyond).mapInArrow(unigram_traced(path), f"{key}, ids binary, same boolean")


def digests(batches):
    """For mapInArrow over (id, ids, same): (id, n_tokens, ids_crc32, same)."""
    for batch in batches:
        raw = batch.column(1).to_pylist()
        cols = [pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols, batch.column(2)], names=["id", "n_tokens", "ids_crc32", "same"])


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", giant: int = GIANT, chunk: int = CHUNK, scratch: Scratch | None = None) -> DataFrame:
    """(id, ids, same) of every row: the library's ids as little-endian unsigned 32-bit integers in a binary column.

    Documents over `giant` bytes are encoded in chunks by the scan that the module's head describes; neither `giant`
    nor `chunk` changes a result. Models of type bpe that change characters, drop spaces or have no byte pieces, and
    texts with the character that stands for spaces, are encoded whole by the library. same: whether the ids decode to
    the text. Null texts are empty and have no ids. Repeated rows come back each; an empty table gives an empty
    result; other columns are not used.
    """
    scratch = scratch or Scratch(docs.sparkSession, "pieces")
    read = keyed(docs, id_col, text_col)
    kind = dict(read.dtypes)["id"]
    shape = f"id {kind}, tkey long, ids binary, same boolean"
    parts, encoded = bpe_giants, model(path)
    split = F.octet_length("text") > giant
    if isinstance(encoded, Unigram):
        parts = unigram_giants
    else:
        split = split & F.lit(encoded.easy) & ~F.contains(F.col("text"), F.lit("▁"))
    small = read.where(~split).mapInArrow(whole(path), shape)
    large = read.where(split)
    cut = parts(large.dropDuplicates(["id", "tkey"]), path, chunk, kind, scratch)
    gathered = cut.groupBy("id", "tkey").agg(F.array_sort(F.collect_list(F.struct("k", "ids", "same"))).alias("parts")).mapInArrow(joined(path), shape)
    gathered = gathered.withColumnsRenamed({"id": "g_id", "tkey": "g_tkey"})
    often = large.groupBy("id", "tkey").agg(F.count("*").cast("int").alias("n"))
    whole_again = often.join(gathered, (F.col("tkey") == F.col("g_tkey")) & F.col("id").eqNullSafe(F.col("g_id"))).withColumn("one", F.explode(F.sequence(F.lit(1), "n")))
    return small.union(whole_again.select("id", "tkey", "ids", "same")).select(F.col("id").alias(id_col), "ids", "same")


def decoded(path: str):
    """For mapInArrow over (id, ids binary): (id, text)."""

    def run(batches):
        m = model(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m.library.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(1).to_pylist()], pa.string())], names=["id", "text"])

    return run


def decode_pieces(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from binary ids, as encode_pieces gives them; null ids are an empty text."""
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(decoded(path), f"id {dict(rows.dtypes)['id']}, text string").withColumnRenamed("id", id_col)
