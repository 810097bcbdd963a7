"""Token-id files: independent zstandard frames, a document index, and a trailing seek table with checksums.

A file is a row of zstandard frames, each holding whole documents: their number, their ids and lengths, then all
token ids as little-endian unsigned 32-bit integers. After them follow two skippable frames: the least and largest
doc_id of every frame, and the seek table of the public seekable format (sizes of every frame packed and unpacked,
and the lower half of the xxHash64 of its content). A reader opens the end of the file and then only the frames
that hold what it looks for.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
import zstandard

FRAME_BYTES = 1 << 20
LEVEL = 3
NO_ID = -(2**63)  # stands for a missing doc_id

# fixed values of the seekable format
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
FOOTER_BYTES = 9


def _frame(docs: list[tuple[int, bytes]]) -> bytes:
    ids = np.asarray([d for d, _ in docs], dtype="<i8")
    sizes = np.asarray([len(t) // 4 for _, t in docs], dtype="<u8")
    return b"".join([struct.pack("<Q", len(docs)), ids.tobytes(), sizes.tobytes(), *(t for _, t in docs)])


def write(out, documents: Iterable[tuple[int, bytes]]) -> tuple[int, int]:
    """Write documents (doc_id, token ids) in their order; gives the number of documents and of ids."""
    packer = zstandard.ZstdCompressor(level=LEVEL)
    table, index = [], []
    docs: list[tuple[int, bytes]] = []
    size = n_docs = n_ids = 0

    def flush() -> None:
        nonlocal docs, size
        raw = _frame(docs)
        packed = packer.compress(raw)
        out.write(packed)
        table.append(struct.pack("<III", len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        index.append(struct.pack("<qq", min(d for d, _ in docs), max(d for d, _ in docs)))
        docs, size = [], 0

    for doc_id, ids in documents:
        docs.append((doc_id, ids))
        size += len(ids)
        n_docs, n_ids = n_docs + 1, n_ids + len(ids) // 4
        if size >= FRAME_BYTES:
            flush()
    if docs:
        flush()
    body = b"".join(index)
    out.write(struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body)
    body = b"".join(table) + struct.pack("<IBI", len(table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
    out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(body)) + body)
    return n_docs, n_ids


class Reader:
    """Reads documents from an open file that can seek."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.seek(0, 2)
        source.seek(size - FOOTER_BYTES)
        n, flags, magic = struct.unpack("<IBI", source.read(FOOTER_BYTES))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        at = size - FOOTER_BYTES - 12 * n
        source.seek(at - 8 - 16 * n)
        body = source.read(16 * n + 8 + 12 * n)
        self.ranges = [struct.unpack_from("<qq", body, 16 * i) for i in range(n)]
        self.frames, start = [], 0
        for i in range(n):
            packed, raw, check = struct.unpack_from("<III", body, 16 * n + 8 + 12 * i)
            self.frames.append((start, packed, raw, check))
            start += packed
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> Iterator[tuple[int, bytes]]:
        """The documents of one frame."""
        start, packed, size, check = self.frames[i]
        self.source.seek(start)
        raw = self.unpacker.decompress(self.source.read(packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {i} is damaged")
        (n,) = struct.unpack_from("<Q", raw)
        ids = np.frombuffer(raw, "<i8", n, 8)
        ends = 8 + 16 * n + 4 * np.cumsum(np.frombuffer(raw, "<u8", n, 8 + 8 * n)).astype(np.int64)
        start = 8 + 16 * n
        for doc_id, end in zip(ids.tolist(), ends.tolist()):
            yield doc_id, raw[start:end]
            start = end

    def documents(self) -> Iterator[tuple[int, bytes]]:
        for i in range(len(self.frames)):
            yield from self.frame(i)

    def find(self, doc_id: int) -> list[bytes]:
        """Token ids of all documents with this id; other frames stay packed."""
        hits = [i for i, (low, high) in enumerate(self.ranges) if low <= doc_id <= high]
        return [ids for i in hits for d, ids in self.frame(i) if d == doc_id]
