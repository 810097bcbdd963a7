"""Sheets parsed in blocks against the same sheets parsed in one piece."""

import csv
import io
import random
import zipfile
from contextlib import contextmanager

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendlens.sources import archives, blocks
from spendlens.sources.blocks import CLOSED, FIELD_START, OTHER, QUOTE, QUOTED, SEPARATOR, STEPS

BYTES = st.lists(st.sampled_from([b"a", b",", b'"', b"\n", b"\r", "é".encode()]), max_size=40).map(b"".join)


def symbol(byte):
    return QUOTE if byte == ord('"') else SEPARATOR if byte in b",\r\n" else OTHER


def walk(data, state):
    """The state after every byte, one after the other."""
    out = []
    for byte in data:
        state = STEPS[symbol(byte)][state]
        out.append(state)
    return out


@given(BYTES, st.integers(0, 40))
def test_transition(data, cut):
    step = blocks.transition(data)
    for state in range(4):
        assert blocks.after(step, state) == (walk(data, state) or [state])[-1]
        halves = blocks.after(blocks.transition(data[cut:]), blocks.after(blocks.transition(data[:cut]), state))
        assert halves == blocks.after(step, state)


@given(BYTES)
def test_record_end(data):
    for state in range(4):
        states = walk(data, state)
        ends = [i + 1 for i, (byte, s) in enumerate(zip(data, states)) if byte == ord("\n") and s == FIELD_START]
        assert blocks.record_end(data, state) == (ends[0] if ends else -1)


def test_a_quote_matters_only_where_a_field_begins():
    assert walk(b'"a', FIELD_START)[-1] == QUOTED and walk(b'x"a', FIELD_START)[-1] not in (QUOTED, CLOSED)


def zipped(data):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("sheet.csv", data)
    return out.getvalue()


def in_blocks(data, size):
    """All rows of a sheet by the functions that the tasks run, without Spark."""

    @contextmanager
    def opened(_):
        yield io.BytesIO(zipped(data))

    table = pd.DataFrame([b.to_pylist()[0] for b in blocks._unzipped("p", opened, size)]).astype(object).where(lambda d: d.notna(), None)
    plan = blocks.planned(table)
    pieces = {}
    for row, block in zip(plan.itertuples(), table[table["no"] >= 0].sort_values("no")["data"]):
        split = len(block) if row.split < 0 else row.split
        if split:
            pieces.setdefault(row.owner, []).append(block[:split])
        if row.split >= 0:
            pieces.setdefault(row.no, []).append(block[split:])
    header, rows = None, []
    for owner in sorted(pieces):
        whole = b"".join(pieces[owner] if owner == 0 else [plan.header[0], *pieces[owner]])
        for batch in blocks._parsed("p", owner == 0, whole, plan.encoding[0]):
            for row in batch.to_pylist():
                assert row["error"] is None
                header = header or row["header"]
                rows += [row["cells"]] if row["cells"] is not None else []
    return header, rows, len(plan)


def in_one_piece(data, encoding="utf-8"):
    table = pd.read_csv(io.BytesIO(data), encoding=encoding, dtype=str)
    return list(table.columns), table.astype(object).where(table.notna(), None).values.tolist()


def sheet(seed, rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    draw = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=quoting)
    writer.writerow(["id", 'na"me', "te\nxt", "道路"])
    for i in range(rows):
        texts = ["".join(draw.choice(['a', '"', ",", "\n", "\r\n", "学", " ", "b"]) for _ in range(draw.randrange(9))) for _ in range(3)]
        writer.writerow([i, *texts])
    return out.getvalue()


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 90), st.sampled_from(["\n", "\r\n"]), st.sampled_from([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
def test_any_block_size(seed, size, end, quoting):
    data = sheet(seed, 25, end, quoting).encode()
    header, rows, n = in_blocks(data, size)
    assert (header, rows) == in_one_piece(data)


def test_every_border():
    """A border before, inside and after each quote and line end."""
    data = 'a,b\n1,"x ""y"", z\nnext"\n"2",\r\n3,p"q\n\n4,""\n'.encode()
    for size in range(1, len(data) + 1):
        assert in_blocks(data, size)[:2] == in_one_piece(data), size


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "shift_jis"])
def test_encodings(encoding):
    data = sheet(5, 60).replace("学", "ソ表").encode(encoding)
    header, rows, n = in_blocks(data, 37)
    assert n > 10 and (header, rows) == in_one_piece(data, encoding)


def test_a_record_longer_than_blocks():
    data = ("a,b\n1,x\n2,\"" + "long\n" * 300 + '"\n3,y\n').encode()
    header, rows, n = in_blocks(data, 64)
    assert n > 20 and (header, rows) == in_one_piece(data)


def test_blank_lines_and_no_last_line_end():
    for data in (b"\n \n\na,b\n1,2\n\n\n3,4", b"a,b", b"a,b\n", b"a\r1\r2\r"):
        for size in (1, 3, 100):
            assert in_blocks(data, size)[:2] == in_one_piece(data)


def test_archives_in_blocks(spark, tmp_path):
    texts = {f"{i}-1_XX_2024_s{i}.zip": sheet(i, 300 if i else 3000) for i in range(3)}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(zipped(text.encode()))
    (tmp_path / "8-1_XX_2024_cut.zip").write_bytes(zipped(sheet(9, 900).encode())[:2000])
    listed = archives.list_archives(spark, str(tmp_path))
    unzipped = blocks.unzipped(listed, archives._open, 700)
    assert unzipped.where("no >= 0").agg(F.max(F.length("data"))).first()[0] <= 800
    got = blocks.parsed(unzipped).select(F.element_at(F.split("path", "/"), -1).alias("name"), "cells", "error").collect()
    for name, text in texts.items():
        assert sorted(r["cells"] for r in got if r["name"] == name) == sorted(in_one_piece(text.encode())[1])
    assert [r["error"][:10] for r in got if r["error"]] == ["BadZipFile"]
    assert blocks.parsed(unzipped).rdd.getNumPartitions() > 1
