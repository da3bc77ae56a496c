import itertools
import random

from tabprep.llm.token_counts import MARK, Unigram, token_counts, unigram
from tabprep.llm.tokens import public_path


def plain(model, word):
    """Best of all segmentations, tried one after the other from the left."""
    text = MARK + word
    best = {0: (0, 0)}
    for i in range(len(text)):
        score, count = best[i]
        for j in range(i + 1, len(text) + 1):
            piece = model.scores.get(text[i:j])
            steps = [(piece, 1)] if piece is not None else []
            if j == i + 1 and piece is None:
                size = len(text[i].encode())
                steps.append((size * model.byte_score, size))
            for s, n in steps:
                new = (score + s, count + n)
                old = best.get(j)
                if old is None or new[0] > old[0] or new[0] == old[0] and new[1] < old[1]:
                    best[j] = new
    return best[len(text)][1]


def test_small_vocabulary_by_all_segmentations():
    scores = {MARK: -5, "a": -7, "b": -7, "ab": -9, "ba": -14, f"{MARK}a": -11, "aba": -15, "bb": -14}
    model = Unigram(scores, -100)
    words = {"".join(w) for n in range(1, 8) for w in itertools.product("ab", repeat=n)} | {"", "é", "aéb"}
    model.learn(words)
    assert model.counts == {w: plain(model, w) for w in words}
    assert model.nodes < sum(len(w) + 1 for w in words) / 2  # shared prefixes are scored once


def test_corpus_equals_brute_force(corpus):
    model = unigram(public_path("piece_bpe_32k.model"))
    rows = corpus.limit(60).collect()
    known = {w: plain(model, w) for r in rows for w in set(r.text.split())}
    got = {r.doc_id: (r.n_tokens, r.n_words) for r in token_counts(corpus).collect()}
    for r in rows:
        assert got[r.doc_id] == (sum(known[w] for w in r.text.split()), len(r.text.split()))


def test_forgetting_changes_nothing():
    dice = random.Random(1)
    texts = [" ".join("".join(dice.choice("abcdé") for _ in range(6)) for _ in range(50)) for _ in range(20)]
    model = unigram(public_path("piece_bpe_32k.model"))
    small = Unigram(model.scores, model.byte_score, remembered=10)
    assert [small.count([t])[0][0] for t in texts] == model.count(texts)[0]


def test_held_words_are_bounded_by_bytes():
    model = Unigram(unigram(public_path("piece_bpe_32k.model")).scores, -100, remembered=100_000)
    for i in range(30):
        model.count([chr(0x4E00 + i) * 20_000 + " " + "x" * i])
        assert sum(map(len, model.counts)) <= 100_000


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "漢字 😀"), (5, "x" * 50_000), (6, "a b"), (6, "a b"), (None, "a")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS n_tokens")
    rows = token_counts(frame).collect()
    assert len(rows) == 8
    got = {r.doc_id: r for r in rows}
    assert [(got[i].n_tokens, got[i].n_words) for i in (1, 2, 3)] == [(0, 0)] * 3
    assert got[4].n_words == 2 and got[4].n_tokens >= 4 and got[6].n_words == 2
    assert token_counts(frame.limit(0)).count() == 0
