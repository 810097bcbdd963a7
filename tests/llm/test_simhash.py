"""Fingerprints, the edited text and its neighbour, block tables against brute force."""

import hashlib

import numpy as np

from spendlens.llm import simhash
from tests.llm.small import as_dict, documents, prose, with_clash


def test_edited_texts_and_order(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 3)
    texts = {i * (7 if i > 20 else 1) - 5: prose(i, 5 + i) + "é東" for i in range(40)} | {900: "", 901: None, 902: "ab", 5000: "x"}
    got = as_dict(simhash.compared(with_clash(documents(spark, list(texts.items())))))
    order = sorted(texts, reverse=True)
    assert sorted(got) == sorted(order)
    for i, d in enumerate(order):
        text, after = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        assert got[d]["n_chars"] == len(text)
        assert got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        prints = simhash.fingerprints([t.encode() for t in (text, edited, after)])
        assert got[d]["fingerprint"] == prints[0].tobytes().hex() and got[d]["edited_fingerprint"] == prints[1].tobytes().hex()
        assert got[d]["near_edited"] == simhash.likeness(prints[0], prints[1])
        assert got[d]["near_next"] == simhash.likeness(prints[0], prints[2])


def test_likeness_tells_edited_from_other():
    texts = [prose(i, 60 + 5 * i) for i in range(100)]
    edited = [simhash.edited(t, u) for t, u in zip(texts, texts[1:] + texts[:1])]
    a, b = (simhash.fingerprints([t.encode() for t in x]) for x in (texts, edited))
    own = [simhash.likeness(x, y) for x, y in zip(a, b)]
    other = [simhash.likeness(x, y) for x, y in zip(a, np.roll(a, 1, axis=0))]
    assert np.percentile(own, 5) > np.percentile(other, 95)
    assert simhash.likeness(a[0], a[0]) == 1


def test_equal_texts_and_long_texts():
    many = prose(2, 40)
    a, b, c = simhash.fingerprints([many.encode(), many.upper().replace(" ", " - ").encode(), prose(1, 200_000).encode()])
    assert (a == b).all() and c.any()
    assert not simhash.fingerprints([b"", b" .,"]).any()
    slices = simhash.fingerprints([prose(i, 50).encode() for i in range(20)])
    assert all((simhash.fingerprints([prose(i, 50).encode()])[0] == slices[i]).all() for i in range(20))


def test_block_tables_find_all_neighbours(spark):
    draw = np.random.default_rng(3)
    rows, n = [], 0
    for _ in range(40):
        base = draw.integers(0, 256, 16, dtype=np.uint8)
        for flips in (0, 0, 1, 2, 3, 4, 5):
            bits = np.unpackbits(base)
            bits[draw.choice(128, flips, replace=False)] ^= 1
            rows.append((n, np.packbits(bits).tobytes().hex()))
            n += 1
    rows += [(None, rows[0][1]), (n, None)]
    links, members = simhash.neighbours(spark.createDataFrame(rows, "doc_id long, fingerprint string"))
    classes = {}
    for d, f in rows:
        if d is not None and f is not None:
            classes[f] = min(d, classes.get(f, d))
    want, names = set(), sorted(classes.items(), key=lambda x: x[1])
    for i, (f, a) in enumerate(names):
        for g, b in names[i + 1 :]:
            distance = (int(f, 16) ^ int(g, 16)).bit_count()
            if distance <= simhash.RADIUS:
                want.add((a, b, distance))
    assert {tuple(r) for r in links.collect()} == want
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == {d: classes[f] for d, f in rows if d is not None and f}


def test_cases(spark):
    assert simhash.compared(documents(spark, [])).count() == 0
    [one] = simhash.compared(documents(spark, [(3, "abc def")])).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest()
    rows = simhash.compared(documents(spark, [(3, "abc"), (3, "abc"), (None, "zz"), (-4, None)])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == [(False, -4), (False, 3), (False, 3), (True, 0)]


def test_one_word_more_is_a_small_step():
    """Texts of every length are like themselves with one word more; no length is a border."""
    steps = []
    for n in range(6, 40):
        texts = [prose(100 * n + i, n) for i in range(20)]
        a, b = (simhash.fingerprints([t.encode() for t in x]) for x in (texts, [f"{t} more" for t in texts]))
        steps.append(np.mean([simhash.likeness(x, y) for x, y in zip(a, b)]))
    assert min(steps) > 0.8
