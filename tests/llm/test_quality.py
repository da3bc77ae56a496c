import random
import zlib

import numpy as np
import pytest

from tabprep.llm.quality import BINS, RANK, STATISTICS, WORDS, _raw, _sparse, extract, fit, parts_of, quality

GOOD = ["river", "stone", "meadow", "window", "garden", "yellow", "summer", "letter", "bridge", "market"]


def make(n, seed):
    """Label 0 where a text is a list of signs, or where two words meet that are each as frequent in texts of label 1."""
    dice = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [dice.choice(GOOD) for _ in range(dice.randint(20, 80))]
        kind = i % 4
        if kind == 0:
            words = [w + dice.choice(["$$$", "###", " |"]) for w in words]
        if kind in (1, 2):
            words += ["north" if kind == 1 else "south"] * 6 + ["east" if dice.random() < 0.5 else "west"] * 6
        docs.append((i, " ".join(words) + ".", len(words)))
        labels.append((i, int(kind != 0)))
    return docs, labels


def test_output_is_the_sum_over_pairs():
    dice = np.random.default_rng(1)
    weights, vectors = dice.normal(size=30), dice.normal(size=(30, 4))
    row, feature, value = np.array([0, 0, 0, 2, 2]), np.array([3, 9, 20, 9, 29]), dice.normal(size=5)
    z, _ = _raw(row, feature, value, 3, 0.5, weights, vectors)
    for r in range(3):
        at = np.flatnonzero(row == r)
        expected = 0.5 + sum(weights[feature[i]] * value[i] for i in at)
        expected += sum(vectors[feature[i]] @ vectors[feature[j]] * value[i] * value[j] for i in at for j in at if i < j)
        assert np.isclose(z[r], expected)


def test_pairs_are_learned():
    # Which of the words says nothing alone: only the pair does.
    dice = random.Random(3)
    texts, labels = [], []
    for _ in range(1600):
        a, b = dice.choice(["north", "south"]), dice.choice(["east", "west"])
        texts.append(f"{a} {b}".encode())
        labels.append(int((a == "north") == (b == "east")))
    model = fit(texts[:1200], labels[:1200], (600, 600), epochs=12)
    right = (model.scores(texts[1200:]) >= 0.5) == np.array(labels[1200:])
    assert right.mean() > 0.95


def test_parts_change_no_feature(monkeypatch):
    dice = random.Random(2)
    texts = [" ".join(dice.choice(GOOD) + dice.choice(["", ".", "!\n"]) for _ in range(n)).encode() for n in (0, 1, 400, 3000)] + [b"", "漢字 É".encode() * 50]
    whole = extract(texts)
    monkeypatch.setattr("tabprep.llm.quality.parts_of", lambda t: parts_of(t, 500))
    parts = extract(texts)
    assert np.array_equal(whole.row, parts.row) and np.array_equal(whole.bucket, parts.bucket) and np.allclose(whole.value, parts.value)
    lines = STATISTICS.index("lines")
    assert np.allclose(whole.statistics[:, :lines], parts.statistics[:, :lines])
    assert all(b"".join(parts_of(t, 500)) == t and max(map(len, parts_of(t, 500))) <= 500 for t in texts)


def test_bins_and_missing_metadata():
    found = extract([b"some words here", b""])
    edges = np.zeros((len(STATISTICS) + 1, BINS - 1))
    row, feature, _ = _sparse(found, np.array([[np.nan], [3.0]]), edges)
    last = WORDS + len(STATISTICS) * (BINS + 1)
    assert (row[feature == last + BINS].tolist(), row[feature == last + BINS - 1].tolist()) == ([0], [1])


def test_held_out_texts_are_told_apart(spark):
    docs, labels = make(800, 1)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, size int").selectExpr("*", "0.5D AS score", "'l' AS quality", "1 AS label", "2 AS place", "3 AS bytes", "4 AS m0")
    rows = quality(frame, spark.createDataFrame(labels, "doc_id bigint, quality int"), metadata=("size",)).collect()
    truth = dict(labels)
    assert len(rows) == 800 and {r.held_out for r in rows} == {True, False}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1
    right = [r.predicted == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(right) / len(right) > 0.98


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = make(200, 2)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, size int")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    scores = [{r.doc_id: r.score for r in quality(frame, spark.createDataFrame(own, "doc_id bigint, quality int")).collect()} for own in (labels, turned)]
    assert scores[0] == scores[1]


def test_odd_rows(spark):
    docs, labels = make(80, 3)
    docs += [(1000, None, None), (1001, "", 0), (1002, "!!!", None), (None, "river", 1), (1003, "x" * 3_000_000, 1), (5, "again", 1), (5, "again", 1)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, size int")
    marks = spark.createDataFrame([*labels, (None, 1), (2000, None), (1, 7), (1001, 0), (1002, 1)], "doc_id bigint, quality int")
    rows = quality(frame, marks, metadata=("size",)).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    assert quality(frame.limit(0), marks).count() == 0
    assert len({r.score for r in quality(frame, marks.limit(0)).collect()}) == 1


@pytest.mark.parametrize("labels", [[], [0, 0], [1]])
def test_one_label_only(labels):
    model = fit([b"some text"] * len(labels), labels)
    assert len(set(model.scores([b"", b"other text"]).tolist())) == 1 and model.vectors.shape[1] == RANK


def test_corpus(spark, sf, corpus):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality(corpus, labels).collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in rows) / len(rows) > 0.8
