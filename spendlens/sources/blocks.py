"""One large sheet parsed by many tasks.

An archive is unzipped once, by one task, into blocks of bytes. Whether a line end inside a block ends a record depends
on quotes before the block, so every block is described by what it does to the reader's state, for each state it may
begin in: a map of four states, and for each where the first record end is. Maps are composed in block order, one small
row per block, which fixes every block's true state; then a block knows its first record. What stands before that record
goes to the block where it began, and the blocks are parsed in parallel, each behind a copy of the header.

The parsing tasks are as long as a block and the record that runs out of it. A record longer than blocks gathers the
blocks it covers.
"""

from __future__ import annotations

import codecs
import io
import re
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
ROWS_PER_BATCH = 10_000
ENCODINGS = ("utf-8", "shift_jis")  # in neither can a byte of a longer character be a quote, comma or line end
CELLS = "path string, header array<string>, cells array<string>, error string"

# --- the reader's states ---------------------------------------------------------------------------------------

FIELD_START, PLAIN, QUOTED, CLOSED = range(4)  # CLOSED: behind a quote that ends the field or begins a doubled one
OTHER, QUOTE, SEPARATOR = range(3)
STEPS = {
    OTHER: (PLAIN, PLAIN, QUOTED, PLAIN),
    QUOTE: (QUOTED, PLAIN, CLOSED, QUOTED),
    SEPARATOR: (FIELD_START, FIELD_START, QUOTED, FIELD_START),
}


def packed(states: tuple[int, ...]) -> int:
    """A map of the four states as one byte, two bits each."""
    return sum(state << (2 * s) for s, state in enumerate(states))


def after(step: int, state: int) -> int:
    return step >> (2 * state) & 3


SAME = packed((0, 1, 2, 3))
COMPOSED = np.array([[packed(tuple(after(b, after(a, s)) for s in range(4))) for b in range(256)] for a in range(256)], dtype=np.uint8)
_CLASS = np.full(256, packed(STEPS[OTHER]), dtype=np.uint8)
_CLASS[ord('"')] = packed(STEPS[QUOTE])
for _byte in b",\r\n":
    _CLASS[_byte] = packed(STEPS[SEPARATOR])


def transition(block: bytes) -> int:
    """The map of a whole block: neighbours are composed pairwise until one map is left."""
    steps = _CLASS[np.frombuffer(block, np.uint8)]
    while len(steps) > 1:
        if len(steps) % 2:
            steps = np.append(steps, np.uint8(SAME))
        steps = COMPOSED[steps[::2], steps[1::2]]
    return int(steps[0]) if len(steps) else SAME


_QUOTED_REST = rb'[^"]*(?:""[^"]*)*+"[^,\r\n]*+'
_FIELD = rb'(?:"' + _QUOTED_REST + rb'|[^",\r\n][^,\r\n]*+|)'
_RECORD_REST = rb"(?:[,\r]" + _FIELD + rb")*+\n"
_RECORD_END = [
    re.compile(begin + _RECORD_REST)
    for begin in (_FIELD, rb"[^,\r\n]*+", _QUOTED_REST, rb'(?:"' + _QUOTED_REST + rb'|(?!")[^,\r\n]*+)')
]
_BLANK = re.compile(rb"(?:[ \t]*(?:\r\n|\n|\r))*")


def record_end(block: bytes, state: int) -> int:
    """Bytes up to the first line end that ends a record, for a block that begins in a state; -1 without one."""
    found = _RECORD_END[state].match(block)
    return found.end() if found else -1


# --- unzipping -------------------------------------------------------------------------------------------------

BLOCKS = "path string, no int, data binary, step int, ends array<int>, header binary, encoding string, error string"
_NAMES = [part.split()[0] for part in BLOCKS.split(", ")]
_KINDS = [pa.string(), pa.int32(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.string(), pa.string()]


def _block_row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(n)], k) for n, k in zip(_NAMES, _KINDS)], names=_NAMES)


class _Decoders:
    """The encodings that all bytes so far fit."""

    def __init__(self) -> None:
        self.left = {name: codecs.getincrementaldecoder(name)() for name in ENCODINGS}

    def feed(self, data: bytes, final: bool = False) -> None:
        for name, decoder in list(self.left.items()):
            try:
                decoder.decode(data, final)
            except UnicodeDecodeError:
                del self.left[name]

    def first(self) -> str:
        self.feed(b"", final=True)
        for name in ENCODINGS:
            if name in self.left:
                return name
        raise ValueError(f"not readable as {' or '.join(ENCODINGS)}")


def _unzipped(path: str, opened: Callable, size: int) -> Iterator[pa.RecordBatch]:
    with opened(path) as raw, zipfile.ZipFile(raw) as archive, archive.open(archive.namelist()[0]) as member:
        decoders, no, header = _Decoders(), 0, None
        while data := member.read(size):
            decoders.feed(data)
            if header is None:  # the first block holds the whole header
                data = data.removeprefix(codecs.BOM_UTF8)
                while (end := record_end(data[_BLANK.match(data).end() :], FIELD_START)) < 0 and (more := member.read(size)):
                    decoders.feed(more)
                    data += more
                data = data[_BLANK.match(data).end() :]
                header = data[:end] if end >= 0 else data
            yield _block_row(path=path, no=no, data=data, step=transition(data), ends=[record_end(data, s) for s in range(4)])
            no += 1
        if not header:
            raise ValueError("no rows")
        yield _block_row(path=path, no=-1, header=header, encoding=decoders.first())


def unzipped(archives: DataFrame, opened: Callable, size: int = BLOCK_BYTES) -> DataFrame:
    """The blocks of every archive, and one row more of each (no = -1): its header and encoding, or an error."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    yield from _unzipped(path, opened, size)
                except Exception as error:  # the other archives go on
                    yield _block_row(path=path, no=-1, error=f"{type(error).__name__}: {error}")

    return archives.select("path").mapInArrow(read, BLOCKS)


# --- where records begin ---------------------------------------------------------------------------------------

PLAN = "path string, no int, split int, owner int, header binary, encoding string"


def planned(table: pd.DataFrame) -> pd.DataFrame:
    """For each block of one archive: where its first record begins, and which block owns what stands before."""
    ends = table[table["no"] < 0].iloc[0]
    blocks = table[table["no"] >= 0].sort_values("no")
    if ends["error"] is not None:
        blocks = blocks.iloc[:0]
    rows, state, owner = [], FIELD_START, 0
    for no, step, stops in zip(blocks["no"], blocks["step"], blocks["ends"]):
        split = 0 if no == 0 else int(stops[state])
        rows.append((ends["path"], no, split, owner, ends["header"], ends["encoding"]))
        if split >= 0:
            owner = no
        state = after(int(step), state)
    return pd.DataFrame(rows, columns=[part.split()[0] for part in PLAN.split(", ")])


# --- parsing ---------------------------------------------------------------------------------------------------


def _rows(path: str, header: list[str] | None, cells: list, error: str | None = None) -> pa.RecordBatch:
    """Rows of one batch; the header stands in the first row only."""
    n = len(cells)
    names = ["path", "header", "cells", "error"]
    texts = pa.list_(pa.string())
    columns = [pa.array([path] * n), pa.array([header] + [None] * (n - 1), texts), pa.array(cells, texts), pa.array([error] * n, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _parsed(path: str, first: bool, data: bytes, encoding: str) -> Iterator[pa.RecordBatch]:
    try:
        for part in pd.read_csv(io.BytesIO(data), encoding=encoding, dtype=str, chunksize=ROWS_PER_BATCH):
            cells = part.astype(object).where(part.notna(), None).values.tolist()
            if cells or first:
                yield _rows(path, [str(c) for c in part.columns], cells or [None])
    except Exception as error:
        yield _rows(path, None, [None], f"{type(error).__name__}: {error}")


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by path, owner and place; one owner's pieces make whole records."""
    key, pieces = None, []

    def done() -> Iterator[pa.RecordBatch]:
        if key is not None:
            path, owner, header, encoding = key
            yield from _parsed(path, owner == 0, b"".join(pieces if owner == 0 else [header, *pieces]), encoding)

    for batch in batches:
        for path, owner, data, header, encoding in zip(*(batch.column(n).to_pylist() for n in ("path", "owner", "data", "header", "encoding"))):
            if key is None or key[:2] != (path, owner):
                yield from done()
                key, pieces = (path, owner, header, encoding), []
            pieces.append(data)
    yield from done()


def parsed(blocks: DataFrame) -> DataFrame:
    """Header and cells of every record of all blocks, and the errors (columns CELLS)."""
    facts = blocks.select("path", "no", "step", "ends", "header", "encoding", "error")
    plan = facts.groupBy("path").applyInPandas(planned, PLAN)  # one small row per block
    placed = blocks.where("no >= 0").select("path", "no", "data").join(plan, ["path", "no"])
    body = F.struct(F.col("no").alias("owner"), F.expr("substring(data, split + 1)").alias("data"))
    head = F.struct(F.col("owner"), F.when(F.col("split") < 0, F.col("data")).otherwise(F.expr("substring(data, 1, split)")).alias("data"))
    both = F.when(F.col("split") == 0, F.array(body)).when(F.col("split") < 0, F.array(head)).otherwise(F.array(head, body))
    pieces = placed.select("path", "no", "header", "encoding", F.explode(both).alias("piece"))
    pieces = pieces.select("path", "piece.owner", "no", "piece.data", "header", "encoding")
    pieces = pieces.repartition("path", "owner").sortWithinPartitions("path", "owner", "no")
    failed = facts.where(F.col("error").isNotNull())
    none = F.lit(None).cast("array<string>")
    return pieces.mapInArrow(_parse_batches, CELLS).union(failed.select("path", none.alias("header"), none.alias("cells"), "error"))
