import random
import zlib

import pytest

from tabprep.llm.shared import within_bytes
from tabprep.llm.toxicity import fit, telling_words, toxicity, windows_of, words_of

PLAIN = ["river", "stone", "meadow", "window", "garden", "yellow", "summer", "letter", "bridge", "market", "simple", "answer"]
BAD = ["vileword", "nastything", "awfulstuff"]


def make(n, seed):
    dice = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(dice.choice("abcdefghij") for _ in range(6)) if dice.random() < 0.4 else dice.choice(PLAIN) for _ in range(dice.randint(20, 120))]
        bad = i % 5 == 0
        for _ in range(3 if bad else 0):
            words.insert(dice.randrange(len(words)), dice.choice(BAD))
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def test_words_are_cut_not_dropped():
    assert words_of(b"Two WORDS, x" + b"y" * 100) == [b"two", b"words", b"x" + b"y" * 47, b"y" * 48, b"y" * 5]
    assert telling_words([[b"bad", b"the"]] * 20, [[b"the"]] * 100) == {b"bad"}


def test_rare_words_tell():
    # 20 of 3,000 toxic texts: below one in a hundred, and yet no chance.
    toxic = [[b"the", b"rareslur"] if i < 20 else [b"the"] for i in range(3000)]
    assert telling_words(toxic, [[b"the"]] * 3000) == {b"rareslur"}
    assert telling_words(toxic[18:], [[b"the"]] * 3000) == set()


def test_windows_of_long_runs_overlap():
    assert windows_of(b"short words") == [b"short", b"words"]
    run = "".join(map(chr, range(0x4E00, 0x4E20)))
    assert windows_of(run.encode()) == words_of(run.encode()) + [b"\0" + run[i : i + 2].encode() for i in range(31)]
    assert windows_of(run.encode(), frozenset()) == words_of(run.encode())
    dice = random.Random(5)
    texts, labels = [], []
    for i in range(240):
        letters = [chr(dice.randrange(0x4E00, 0x9000)) for _ in range(dice.randint(40, 90))]
        if i % 3 == 0:
            at = dice.randrange(len(letters))
            letters[at:at] = "\u9f98\u9f99\u9f9a"
        texts.append("".join(letters).encode())
        labels.append(int(i % 3 == 0))
    scores = fit(texts[:180], labels[:180]).scores(texts[180:])
    assert [int(s >= 0.7) for s in scores] == labels[180:]


def test_held_out_texts_are_told_apart(spark):
    docs, labels = make(600, 1)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "0.5D AS score", "'l' AS toxic")
    rows = toxicity(frame, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    truth = dict(labels)
    assert len(rows) == 600 and {r.held_out for r in rows} == {True, False}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    right = [r.predicted == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(right) / len(right) > 0.97


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = make(200, 2)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    scores = [{r.doc_id: r.score for r in toxicity(frame, spark.createDataFrame(own, "doc_id bigint, toxic int")).collect()} for own in (labels, turned)]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("long", [1, 0])
def test_long_text_crowds_out_no_others(spark, long):
    docs, labels = make(300, 4)
    docs += [(i, "river stone " * 30_000) for i in range(1000, 1006)]
    labels += [(i, long) for i in range(1000, 1006)]
    frame, marks = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    rows = toxicity(frame, marks, sample_bytes=300_000).where("held_out AND doc_id < 1000").collect()
    truth = dict(labels)
    assert sum(r.predicted == truth[r.doc_id] for r in rows) / len(rows) > 0.95


def test_within_bytes():
    rows = [(0, 500), (0, 5), (1, 900), (0, 60), (1, 700), (0, 90), (0, 4), (2, 2)]
    assert within_bytes(rows, 100) == [1, 3, 4, 6, 7]
    assert within_bytes([(0, 50), *[(0, 1)] * 60], 100) == list(range(1, 61))


def test_odd_rows(spark):
    docs, labels = make(60, 3)
    docs += [(1000, None), (1001, ""), (1002, "!!!"), (None, "vileword"), (1003, "x" * 100_000), (5, "again"), (5, "again")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (2000, None), (1, 7), (1001, 0), (1002, 1)], "doc_id bigint, toxic int")
    rows = toxicity(frame, marks).collect()
    assert len(rows) == len(docs)
    empty = {r.score for r in rows if r.doc_id in (1000, 1001, 1002)}
    assert len(empty) == 1 and 0 <= empty.pop() < 0.7
    assert toxicity(frame.limit(0), marks).count() == 0
    assert len({r.score for r in toxicity(frame, marks.limit(0)).collect()}) == 1


@pytest.mark.parametrize("labels", [[], [0, 0], [1]])
def test_one_label_only(labels):
    model = fit([b"some text"] * len(labels), labels)
    assert len(set(model.scores([b"", b"other text"]))) == 1
