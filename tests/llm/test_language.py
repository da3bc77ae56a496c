import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tabprep.llm.language import _buckets, _counts, fit, has_letter, identify_language, keep_identified, labelled_sample, normalised


def make(n, seed):
    dice = random.Random(seed)
    parts = {"aa": ["ba", "lo", "ti", "ra"], "bb": ["sch", "ung", "heit", "zu"], "cc": ["éa", "oui", "ç", "eux"]}
    out = []
    for i in range(n):
        lang = dice.choice(list(parts))
        words = ["".join(dice.choice(parts[lang]) for _ in range(dice.randint(1, 4))) for _ in range(dice.randint(3, 60))]
        out.append((i, " ".join(words).capitalize() + ".", lang))
    return out


def test_normalised_text():
    assert normalised("Ab, C-d  É1é\n") == " ab c d é é ".encode()
    assert normalised("12 !?") == b""
    assert has_letter("12 é") and has_letter("漢") and not has_letter("12 ² ½ _ !") and not has_letter("")


def test_table_gives_the_mean_of_embeddings():
    rows = make(120, 1)
    model = fit([t for _, t, _ in rows], [v for _, _, v in rows], buckets=1 << 12)
    texts = [rows[0][1], "x", "ab", rows[5][1] * 30, "Ç"]
    logits, known, usable, _ = model._logits(texts)
    for text, own, share in zip(texts, logits, known):
        buckets, shares = _counts(normalised(text), 1 << 12)
        expected = shares @ model.table[buckets]
        assert np.allclose(own, expected[:3] + model.bias, atol=1e-5) and np.isclose(share, expected[3], atol=1e-5)
    assert usable == [True] * 5
    assert len(_buckets(np.zeros(2, np.uint32), 3, 8)) == 0


def test_held_out_accuracy(spark):
    rows = make(900, 2)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "1 AS score", "true AS rejected")
    found = identify_language(frame).collect()
    truth = {i: v for i, _, v in rows}
    assert len(found) == 900
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    right = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out]
    assert sum(right) / len(right) > 0.99
    assert not any(r.rejected for r in found)


def test_labels_of_held_out_rows_change_nothing(spark):
    rows = make(200, 3)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    turned = frame.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, "aa").otherwise(F.col("lang")))
    one, other = ({r.doc_id: (r.lang_pred, r.score) for r in identify_language(f).collect()} for f in (frame, turned))
    assert one == other


def test_long_text_ends_no_sample(spark):
    rows = make(300, 5)
    rows = [(i, t * 40 if v == "aa" else t, v) for i, t, v in rows]
    # Whatever their place in hash order.
    rows += [(10_000 + i, "balo tira " * 30_000, "aa") for i in range(6)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    texts, languages = labelled_sample(frame, id_column="doc_id", text_column="text", language_column="lang", rows=4000, size=240_000)
    free = [v for i, _, v in rows if i < 10_000 and zlib.crc32(str(i).encode()) % 3 != 1]
    assert {v: languages.count(v) for v in ("bb", "cc")} == {v: free.count(v) for v in ("bb", "cc")}
    assert 0 < sum(len(t.encode()) for t, v in zip(texts, languages) if v == "aa") <= 80_000
    # A language with nothing but long texts is learned too.
    only = spark.createDataFrame([*make(60, 6), (7, "жоло тышу " * 9000, "dd")], "doc_id bigint, text string, lang string")
    assert labelled_sample(only, id_column="doc_id", text_column="text", language_column="lang", rows=4000, size=200_000)[1].count("dd") == (zlib.crc32(b"7") % 3 != 1)
    found = identify_language(frame, sample_bytes=240_000).where("held_out AND doc_id < 10000").collect()
    truth = {i: v for i, _, v in rows}
    assert sum(r.lang_pred == truth[r.doc_id] for r in found) / len(found) > 0.98


def test_left_out_language_of_the_same_alphabet_is_rejected():
    rows = make(1500, 8)
    learned = [r for r in rows[:900] if r[2] != "bb"]
    model = fit([t for _, t, _ in learned], [v for _, _, v in learned])
    # Syllables of plain letters too, but others.
    found = list(zip([v for _, _, v in rows[900:]], model.predict([t for _, t, _ in rows[900:]])))
    strange = [rejected for v, (_, _, rejected) in found if v == "bb"]
    known = [rejected for v, (_, _, rejected) in found if v != "bb"]
    assert sum(strange) / len(strange) > 0.9 and sum(known) / len(known) < 0.01


def test_odd_rows_and_rejection(spark):
    rows = make(300, 4) + [(1000, None, "aa"), (1001, "", None), (1002, "123 ... !", "bb"), (1003, "Это совсем другой язык", None), (1004, "漢字" * 9000, None), (7, "balo tira", "aa"), (7, "balo tira", "aa"), (None, "schungheit", "bb")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "'p' AS lang_pred")
    found = {(r.doc_id, r.lang_pred, r.rejected) for r in identify_language(frame).where("doc_id >= 1000 OR doc_id IS NULL").collect()}
    assert {(1000, "und", True), (1001, "und", True), (1002, "und", True), (None, "bb", False)} <= found
    assert {d for d, _, rejected in found if rejected} == {1000, 1001, 1002, 1003, 1004}
    kept = keep_identified(frame)
    assert kept.columns == frame.columns and kept.count() == len(rows) - 5
    assert identify_language(frame.limit(0)).count() == 0 and keep_identified(frame.limit(0)).count() == 0
    assert {r.lang_pred for r in identify_language(frame.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_corpus(corpus):
    found = {r.doc_id: r for r in identify_language(corpus).collect()}
    rows = [r for r in corpus.collect() if found[r.doc_id].held_out]
    assert sum(found[r.doc_id].lang_pred == r.lang for r in rows) / len(rows) > 0.9
