"""Scores, draw and ranks against counting in Python; the selection against sorting."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import common, resampling
from tests.llm.small import documents, prose, with_clash

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def buckets(text):
    w = words_of(text)
    return [crc32(b" ".join(w[i : i + k])) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(10_000)]
    out, able = [], []
    for doc_id, text in rows:
        found = buckets(text)
        weight = sum(gain[b] for b in found)
        score = None
        if doc_id is not None:
            h = int(sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(words_of(text)) >= 20:
                able.append((-score, doc_id, len(out)))
        out.append([doc_id, len(found), weight, score, None])
    for rank, (_, _, at) in enumerate(sorted(able)[: 5 * len(able) // 100], 1):
        out[at][4] = rank
    return sorted(map(str, map(tuple, out)))


def got(df):
    return sorted(str(tuple(r)) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def table(n=400):
    rows = [(i, prose(i, 5 + i % 50, 300)) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, "One word"), (1003, "É é Ünï " * 9), (None, prose(7, 40)), (1004, "w1 " * 90_000), (2000, "A_b-C"), (2001, "w1. W1!")]


TARGET = [prose(900 + i, 30, 60) for i in range(20)] + [None, ""]


def benchmark(spark, texts=TARGET):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


@pytest.mark.parametrize("few", [3, 4096])
def test_rows(spark, few, monkeypatch):
    monkeypatch.setattr(resampling.cutoff, "__defaults__", (few,))
    rows = table()
    docs = with_clash(documents(spark, rows)).withColumn("down", F.lit("x")).withColumn("rank", F.lit("x"))
    assert got(resampling.resampled(docs.repartition(5), benchmark(spark))) == brute(rows, TARGET)


def test_repeated_rows_each_take_part(spark):
    rows = [(i % 3, prose(i % 3, 30)) for i in range(120)]
    result = resampling.resampled(documents(spark, rows), benchmark(spark))
    assert sorted(r["rank"] for r in result.where("rank IS NOT NULL").collect()) == [1, 2, 3, 4, 5, 6]
    assert got(result) == brute(rows, TARGET)


def test_few_or_no_rows(spark):
    for rows in ([], [(1, prose(1, 30))], [(1, None), (2, "short")]):
        assert got(resampling.resampled(documents(spark, rows), benchmark(spark))) == brute(rows, TARGET)
    rows = table(60)
    assert got(resampling.resampled(documents(spark, rows), benchmark(spark, []))) == brute(rows, [])


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = (prose(1, 2000) + " " + "x" * 300 + " tail").encode()
    whole = np.sort(np.concatenate([h for _, h in resampling.features(text)]))
    monkeypatch.setattr(resampling, "PART_BYTES", 100)
    parts = list(resampling.features(text))
    assert len(parts) > 20 and sum(n for n, _ in parts) == 2002
    assert (np.sort(np.concatenate([h for _, h in parts])) == whole).all()


def test_cutoff_is_the_kth_key(spark):
    draw = random.Random(5)
    for spread in (3, 10**9):  # a few scores, or all different
        keys = [(draw.randrange(spread), draw.randrange(50), i) for i in range(3000)]
        df = common.kept(spark.createDataFrame(keys, "down long, doc_id long, row long").repartition(11))
        for k in (1, 2, 700, 1500, 2999, 3000):
            assert resampling.cutoff(df, k, few=10) == sorted(keys)[k - 1]
        assert resampling.cutoff(df, 0) is None
        with pytest.raises(ValueError):
            resampling.cutoff(df, 3001)


def test_a_round_discards_a_quarter():
    draw = random.Random(1)
    parts = [sorted((draw.randrange(10**6), 0, i) for i in range(draw.randrange(1, 400))) for _ in range(30)]
    pivot = resampling.weighted_median([(len(p), p[(len(p) - 1) // 2]) for p in parts])
    every = [key for p in parts for key in p]
    below = sum(key < pivot for key in every)
    assert min(below + 1, len(every) - below) >= len(every) / 4
