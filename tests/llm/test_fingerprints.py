import hashlib
import random

import pytest

from tabprep.llm.fingerprints import _rolling, edit_distance, fingerprints, likeness, neighbour_likeness, signatures


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance_equals_the_table():
    dice = random.Random(1)
    for _ in range(400):
        a, b = ("".join(dice.choice("abcd") for _ in range(dice.randrange(90))) for _ in range(2))
        assert edit_distance(a, b) == plain_distance(a, b)


def test_rolling_hash_byte_by_byte():
    import numpy as np

    data = bytes(7) + bytes(random.Random(2).randrange(256) for _ in range(300))
    h1 = h2 = h3 = 0
    window, expected = [0] * 7, []
    for n, c in enumerate(data[7:]):
        h2 = (h2 - h1 + 7 * c) & 0xFFFFFFFF
        h1 = (h1 + c - window[n % 7]) & 0xFFFFFFFF
        window[n % 7] = c
        h3 = (h3 << 5 ^ c) & 0xFFFFFFFF
        expected.append((h1 + h2 + h3) & 0xFFFFFFFF)
    assert _rolling(np.frombuffer(data, np.uint8)).tolist() == expected


def test_a_text_has_one_fingerprint_wherever_it_stands():
    dice = random.Random(3)
    texts = ["".join(dice.choice("abcdef ") for _ in range(dice.choice([0, 1, 5, 60, 900, 20_000]))).encode() for _ in range(60)]
    alone = [signatures([t])[0] for t in texts]
    assert signatures(texts) == alone
    assert signatures([b""]) == ["3::"]
    assert signatures([b"a" * 100_000])[0].count(":") == 2
    assert max(len(f) for f in signatures([b"ab" * 50_000, b"abcdefgh" * 9_000])) < 400


def test_likeness_follows_edits():
    dice = random.Random(5)
    text = "".join(dice.choice("abcdefghijklmnop ") for _ in range(6000))
    other = "".join(dice.choice("abcdefghijklmnop ") for _ in range(6000))
    small = text[:3000] + "xyz" + text[3000:]
    a, b, c, d = signatures([t.encode() for t in (text, small, text[:3000] + other[:3000], other)])
    assert likeness(a, a) == 1 and likeness(a, b) > 0.9
    assert 0.3 < likeness(a, c) < 0.8 and likeness(a, d) < 0.25


def expected(docs):
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(docs):
        text, after = text or "", docs[(i + 1) % len(docs)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        f, g, h = (signatures([t.encode()])[0] for t in (text, new, after))
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), f, g, likeness(f, g), likeness(f, h)))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 7])
def test_neighbours_equal_brute_force(spark, partitions):
    docs = [(5, "héllo wörld " * 40), (1, None), (2, ""), (2, "twice"), (2, "twice"), (None, "no id"), (9, "z" * 50_000), (3, "𝒳𝒴 surrogate pairs " * 30)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS part", "'x' AS fingerprint").repartition(partitions)
    got = neighbour_likeness(frame)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(docs)


def test_corpus_equals_brute_force(spark, corpus):
    docs = [(r.doc_id, r.text) for r in corpus.collect()]
    assert sorted((tuple(r) for r in neighbour_likeness(corpus).collect()), key=str) == expected(docs)


def test_empty_and_single(spark):
    frame = spark.createDataFrame([(1, "alone in the world")], "doc_id bigint, text string")
    assert neighbour_likeness(frame.limit(0)).count() == 0
    assert [r.near_next for r in neighbour_likeness(frame).collect()] == [1.0]
    assert fingerprints(frame).count() == 1
