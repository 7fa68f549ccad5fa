"""Patched frame-of-reference blocks of unsigned 32-bit integers, and files of them."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

#: Fixed values of the file format.
MAGIC, END = b"PFOR1\x00", b"\n"
_BLOCK = struct.Struct("<IIBI")  # values, minimum, width, exceptions
_HEAD = struct.Struct("<6sQ")  # magic, number of the file among its table's files
_TAIL = struct.Struct("<QQQ6s")  # documents, blocks, bytes of the footer before this, magic

# Widths whose packed bits are plain little-endian integers.
_WHOLE = {8: np.dtype("<u1"), 16: np.dtype("<u2"), 32: np.dtype("<u4")}


def pack(values: np.ndarray, percentile: float = 95.0) -> bytes:
    """One block: differences to the minimum at the width of a percentile, others as exceptions."""
    values = values.astype(np.uint32)
    low = int(values.min()) if len(values) else 0
    rest = values - np.uint32(low)
    width = int(np.percentile(rest, percentile, method="higher")).bit_length() if len(values) else 0
    at = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    if width in _WHOLE:
        packed = rest.astype(_WHOLE[width]).tobytes()
    else:
        bits = np.unpackbits(rest.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
        packed = np.packbits(bits, bitorder="little").tobytes()
    return _BLOCK.pack(len(values), low, width, len(at)) + packed + at.astype(np.uint32).tobytes() + rest[at].tobytes()


def unpack(block: bytes | memoryview) -> np.ndarray:
    n, low, width, patched = _BLOCK.unpack_from(block)
    begin = _BLOCK.size
    packed = -(-n * width // 8)
    if width in _WHOLE:
        rest = np.frombuffer(block, _WHOLE[width], n, begin).astype(np.uint32)
    else:
        bits = np.unpackbits(np.frombuffer(block, np.uint8, packed, begin), count=n * width, bitorder="little")
        wide = np.zeros((n, 32), np.uint8)
        wide[:, :width] = bits.reshape(n, width)
        rest = np.packbits(wide, axis=1, bitorder="little").view(np.uint32).reshape(n)
    at = np.frombuffer(block, np.uint32, patched, begin + packed)
    rest[at] = np.frombuffer(block, np.uint32, patched, begin + packed + 4 * patched)
    return rest + np.uint32(low)


class Writer:
    """Turns one file's documents, in order, into its records; END follows each record in the file.

    Head, blocks of ``block`` ids each whatever the documents' ends, footer:
    per block its byte offset and the index of its first id, then per document
    whether it has an id, the id, and its number of token ids.
    """

    def __init__(self, number: int, block: int = 8192, percentile: float = 95.0):
        self.block, self.percentile = block, percentile
        self.head = _HEAD.pack(MAGIC, number)
        self.offset, self.written = len(self.head) + len(END), 0
        self.starts: list[tuple[int, int]] = []
        self.docs: list[tuple[bool, int, int]] = []
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[bytes]:
        self.docs.append((doc_id is not None, doc_id or 0, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            yield from self._blocks(self.n_held // self.block * self.block)

    def _blocks(self, upto: int) -> Iterator[bytes]:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for i in range(0, upto, self.block):
            record = pack(ids[i : min(i + self.block, upto)], self.percentile)
            self.starts.append((self.offset, self.written))
            self.offset += len(record) + len(END)
            self.written += min(i + self.block, upto) - i
            yield record
        self.held, self.n_held = [ids[upto:]], len(ids) - upto

    def end(self) -> Iterator[bytes]:
        yield from self._blocks(self.n_held)
        has, ids, sizes = zip(*self.docs, strict=True) if self.docs else ((), (), ())
        footer = (
            np.array(self.starts, np.uint64).tobytes()
            + np.array(has, np.uint8).tobytes()
            + np.array(ids, np.int64).tobytes()
            + np.array(sizes, np.uint64).tobytes()
        )
        yield footer + _TAIL.pack(len(self.docs), len(self.starts), len(footer), MAGIC)


class File:
    """A file's bytes: document table at once, blocks on demand."""

    def __init__(self, content: bytes):
        self.content = memoryview(content)
        magic, self.number = _HEAD.unpack_from(content)
        docs, blocks, size, again = _TAIL.unpack_from(content, len(content) - _TAIL.size - len(END))
        if magic != MAGIC or again != MAGIC:
            raise ValueError("not a file of packed token ids")
        at = len(content) - _TAIL.size - len(END) - size
        self.footer = at
        self.starts = np.frombuffer(content, np.uint64, 2 * blocks, at).reshape(-1, 2).astype(np.int64)
        at += 16 * blocks
        self.has = np.frombuffer(content, np.uint8, docs, at).astype(bool)
        self.doc_ids = np.frombuffer(content, np.int64, docs, at + docs)
        self.sizes = np.frombuffer(content, np.uint64, docs, at + 9 * docs).astype(np.int64)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Token ids at positions begin … end - 1, reading only their blocks."""
        first = int(np.searchsorted(self.starts[:, 1], begin, "right")) - 1
        last = int(np.searchsorted(self.starts[:, 1], end, "left"))
        if end <= begin:
            return np.zeros(0, np.uint32)
        parts = [unpack(self.content[int(self.starts[i, 0]) :]) for i in range(first, last)]
        base = int(self.starts[first, 1])
        return np.concatenate(parts)[begin - base : end - base]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, position of its first token id, token ids) of each document, a few blocks in memory."""
        ends = np.cumsum(self.sizes)
        held, base, block = np.zeros(0, np.uint32), 0, 0
        for i, (end, size) in enumerate(zip(ends.tolist(), self.sizes.tolist(), strict=True)):
            begin = end - size
            parts, top = [held[begin - base :]], base + len(held)
            while top < end:
                parts.append(unpack(self.content[int(self.starts[block, 0]) :]))
                top += len(parts[-1])
                block += 1
            held, base = np.concatenate(parts) if len(parts) > 1 else parts[0], begin
            yield (int(self.doc_ids[i]) if self.has[i] else None), begin, held[:size]
