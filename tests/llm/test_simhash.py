import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabprep.llm.simhash import components, fingerprint, group_bits, keep_one, links, near_duplicates, plan, spanning_links

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_print(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values, distance=3):
    """Smallest member of the component of each value."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for v in sorted(values):
        for w in values:
            if w > v and (v ^ w).bit_count() <= distance:
                a, b = find(v), find(w)
                root[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def plain_components(docs, distance=3):
    prints = [(d, plain_print(t)) for d, t in docs]
    roots = plain_roots({p for _, p in prints}, distance)
    least = {}
    for d, p in prints:
        if d is not None:
            least[roots[p]] = min(least.get(roots[p], d), d)
    return sorted(((d, p, least.get(roots[p])) for d, p in prints), key=str)


def signed(value):
    return int(np.array(value, np.uint64).view(np.int64))


def found(frame):
    return sorted(((r.doc_id, r.fingerprint & (1 << 64) - 1, r.component_id) for r in frame.collect()), key=str)


def test_fingerprints():
    for text in ["", " \t ", "One", "one TWO", "a b c d a b c d", "É ü\x85x y z w", "w " * 3000, "\x1c a \x0b b \x0c c"]:
        assert fingerprint(text.encode()) == plain_print(text)
    assert fingerprint(b"a b c d e", 2) == plain_print("a b c d e", 2)


@pytest.mark.parametrize("parts, block", [(1, 4096), (2, 4096), (3, 8), (4, 4096), (4, 8)])
def test_links_connect_what_lies_near(spark, parts, block, monkeypatch):
    import tabprep.llm.simhash as module

    dice = random.Random(parts)
    values = {dice.getrandbits(64) for _ in range(250)}
    for v in list(values)[:40]:
        for _ in range(4):
            values.add(v ^ sum(1 << b for b in dice.sample(range(64), dice.randint(1, 5))))
    chain = 12345
    for b in range(0, 60, 2):
        chain ^= 3 << b
        values.add(chain)
    given = plan

    def fixed(n, both, distance):
        if parts == 4:
            return given(n, both, distance)
        groups = group_bits(n, both, parts)
        thresholds = {1: [3], 2: [1, 1], 3: [0, 1, 0]}[parts]
        return list(zip(groups, thresholds))

    monkeypatch.setattr(module, "plan", fixed)
    if parts == 1:
        values = set(list(values)[:15]) | {v ^ 5 for v in list(values)[:5]}
    frame = spark.createDataFrame([(signed(v),) for v in values], "fingerprint bigint")
    edges = links(frame, block=block)
    rooted = {r.node: r.root for r in components(edges).collect()}
    expected = plain_roots(values)
    groups, expected_groups = {}, {}
    for v in values:
        groups.setdefault(rooted.get(signed(v), signed(v)), set()).add(v)
        expected_groups.setdefault(expected[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected_groups.values()))


def test_thresholds_keep_the_pigeonhole():
    dice = np.random.default_rng(3)
    bits = (dice.random((2000, 64)) < dice.uniform(0.1, 0.9, 64)).astype(np.int64)
    for n in (100, 10**6, 10**10):
        for distance in (1, 3, 5):
            parts = plan(n, (bits.T @ bits) * (n // 100) // 20, distance)
            left_out = 64 - sum(len(b) for b, _ in parts)
            assert left_out >= 0 and sum(t + 1 for _, t in parts) == distance + 1
            assert len({b for own, _ in parts for b in own}) == 64 - left_out


def test_a_dense_bucket_gives_a_forest():
    values = np.array([sum(1 << b for b in p) for p in [(i,) for i in range(60)]], np.uint64)
    assert len(spanning_links(values, 3)) == 59


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 2000)] + [(5000, 5000 + i) for i in range(1, 300)], "a bigint, b bigint")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert {roots[i] for i in range(1, 301)} == {0} and roots[2000] == 1000 and {roots[5000 + i] for i in range(1, 300)} == {5000}


DOCS = [
    (7, "the same words here again"),
    (3, "The SAME words here again"),
    (5, None),
    (6, ""),
    (2, " \n"),
    (9, "a b c"),
    (9, "a b c"),
    (9, "quite another text under the same id"),
    (None, "a text without id stands here"),
    (8, "x " * 20_000),
]


def test_odd_rows_equal_brute_force(spark):
    frame = spark.createDataFrame(DOCS, "doc_id bigint, text string").selectExpr("*", "1 AS fingerprint", "2 AS part", "3 AS root")
    assert found(near_duplicates(frame)) == plain_components(DOCS)
    assert near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_one_of_each_group_stays(spark, broadcast_rows):
    names = ["component_id", "text_hash", "group", "kept", "own", "id", "n", "c0", "c1", "__own", "__id", "__hash", "a.b"]
    frame = spark.createDataFrame(DOCS, "doc_id bigint, text string").selectExpr("doc_id", "text", *[f"'{c}' AS `{c}`" for c in names])
    kept = keep_one(frame, broadcast_rows=broadcast_rows)
    assert kept.columns == frame.columns
    assert {tuple(r)[2:] for r in kept.collect()} == {tuple(names)}
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("3", DOCS[1][1]), ("2", " \n"), ("9", "a b c"), ("9", DOCS[7][1]), ("None", DOCS[8][1]), ("8", DOCS[9][1])]
    )


def test_corpus_equals_brute_force(spark, corpus):
    assert found(near_duplicates(corpus)) == plain_components([(r.doc_id, r.text) for r in corpus.collect()])
    copies = corpus.unionAll(corpus.withColumn("doc_id", F.col("doc_id") + 1000))
    assert keep_one(copies).where("doc_id >= 1000").count() == 0
