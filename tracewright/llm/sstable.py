"""Sorted-string-table shards: prefix-compressed key blocks, a sparse block index, a Bloom filter, a footer.

A file: data blocks, index block, filter block, footer.

* Data block: zstd-compressed entries in key order. Entry: varint shared, varint unshared, varint value size, the
  unshared key bytes, the value. shared is the length of the prefix shared with the entry before; every RESTART
  entries it is 0, and the block ends with the u32 offsets of these entries and their u32 count, for binary search.
* Index block: JSON list of [last key (hex), offset, size, crc32] of each data block.
* Filter block: u32 number of hashes, then the bits.
* Footer (52 bytes): u64 index offset, u64 index size, u64 filter offset, u64 filter size, u64 entries, u64 units
  (the sum of what the writer counts, here ids), u32 magic.
"""

from __future__ import annotations

import bisect
import json
import struct
import zlib

import numpy as np

MAGIC = 0x54575353
BLOCK, RESTART, BITS, PROBES = 64 << 10, 16, 10, 7
FOOTER = struct.Struct("<6QI")


def int_key(value: int | None) -> bytes:
    """Bytes that sort like the integers, null first."""
    return b"\0" if value is None else b"\1" + (value + 2**63).to_bytes(8, "big")


def key_int(key: bytes) -> int | None:
    return None if key == b"\0" else int.from_bytes(key[1:], "big") - 2**63


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int, probes: int):
    a, b = zlib.crc32(key), zlib.crc32(key, 0x9E3779B9) | 1
    return [(a + i * b) % bits for i in range(probes)]


class Writer:
    """Writes entries that come in key order to a binary file object. Only a block, the index and the keys' hashes are held."""

    def __init__(self, out):
        import zstandard

        self.out, self.zip = out, zstandard.ZstdCompressor(level=1)
        self.at = self.entries = self.units = 0
        self.index, self.keys = [], []
        self._new()

    def _new(self) -> None:
        self.block, self.restarts, self.last, self.count = bytearray(), [], b"", 0

    def add(self, key: bytes, value: bytes, units: int = 0) -> None:
        if self.entries and key < self.previous:
            raise ValueError("keys do not ascend")
        shared = 0
        if self.count % RESTART == 0:
            self.restarts.append(len(self.block))
        else:
            most = min(len(key), len(self.last))
            while shared < most and key[shared] == self.last[shared]:
                shared += 1
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last = self.previous = key
        self.count += 1
        self.entries += 1
        self.units += units
        self.keys.append((zlib.crc32(key), zlib.crc32(key, 0x9E3779B9) | 1))
        if len(self.block) >= BLOCK:
            self._flush()

    def _flush(self) -> None:
        if self.count:
            raw = bytes(self.block) + struct.pack(f"<{len(self.restarts) + 1}I", *self.restarts, len(self.restarts))
            data = self.zip.compress(raw)
            self.index.append([self.last.hex(), self.at, len(data), zlib.crc32(data)])
            self._put(data)
            self._new()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        self._flush()
        index, index_at = json.dumps(self.index).encode(), self.at
        self._put(index)
        bits = max(64, self.entries * BITS)
        field = np.zeros(bits, bool)
        if self.keys:
            pairs = np.array(self.keys, np.uint64)
            for i in range(PROBES):
                field[((pairs[:, 0] + np.uint64(i) * pairs[:, 1]) % np.uint64(bits)).astype(np.int64)] = True
        bloom, bloom_at = struct.pack("<IQ", PROBES, bits) + np.packbits(field).tobytes(), self.at
        self._put(bloom)
        self._put(FOOTER.pack(index_at, len(index), bloom_at, len(bloom), self.entries, self.units, MAGIC))


class Reader:
    """Reads a seekable binary file object: get(key) by filter, block index and restarts; iteration in key order."""

    def __init__(self, file, size: int):
        import zstandard

        self.file, self.unzip = file, zstandard.ZstdDecompressor()
        file.seek(size - FOOTER.size)
        index_at, index_size, self.bloom_at, self.bloom_size, self.entries, self.units, magic = FOOTER.unpack(file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a table of this format")
        file.seek(index_at)
        self.index = [(bytes.fromhex(k), at, n, crc) for k, at, n, crc in json.loads(file.read(index_size))]
        self.bloom = None

    def _block(self, k: int) -> bytes:
        _, at, n, crc = self.index[k]
        self.file.seek(at)
        data = self.file.read(n)
        if zlib.crc32(data) != crc:
            raise ValueError(f"block {k} is damaged")
        return self.unzip.decompress(data)

    @staticmethod
    def _entries(raw: bytes, at: int, end: int):
        key = b""
        while at < end:
            shared, at = _read_varint(raw, at)
            unshared, at = _read_varint(raw, at)
            size, at = _read_varint(raw, at)
            key = key[:shared] + raw[at : at + unshared]
            at += unshared
            yield key, raw[at : at + size]
            at += size

    @staticmethod
    def _restarts(raw: bytes) -> tuple[int, tuple[int, ...]]:
        (n,) = struct.unpack_from("<I", raw, len(raw) - 4)
        end = len(raw) - 4 - 4 * n
        return end, struct.unpack_from(f"<{n}I", raw, end)

    def may_hold(self, key: bytes) -> bool:
        if self.bloom is None:
            self.file.seek(self.bloom_at)
            raw = self.file.read(self.bloom_size)
            self.probes, self.bits = struct.unpack_from("<IQ", raw)
            self.bloom = raw[12:]
        return all(self.bloom[p >> 3] >> (7 - (p & 7)) & 1 for p in _probes(key, self.bits, self.probes))

    def get(self, key: bytes) -> bytes | None:
        """The first value of the key, or None."""
        if not self.may_hold(key):
            return None
        k = bisect.bisect_left(self.index, key, key=lambda x: x[0])
        if k == len(self.index):
            return None
        raw = self._block(k)
        end, restarts = self._restarts(raw)
        # the last restart below the key: a first key equal to it could have its first entry before
        first = lambda r: next(self._entries(raw, r, end))[0]
        i = max(0, bisect.bisect_left(restarts, key, key=first) - 1)
        for got, value in self._entries(raw, restarts[i], end):
            if got >= key:
                return value if got == key else None
        return None

    def __iter__(self):
        for k in range(len(self.index)):
            raw = self._block(k)
            yield from self._entries(raw, 0, self._restarts(raw)[0])
