import re

import pytest

from tabprep.llm.decontaminate import overlaps, remove_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    out = {}
    for doc_id, text in docs:
        own, hit, found, longest = words(text), set(), set(), 0
        for item_id, item in items:
            theirs = words(item)
            n = min(window, len(theirs))
            places = {}
            for j in range(len(theirs) - n + 1) if n else []:
                places.setdefault(tuple(theirs[j : j + n]), []).append(j)
            for i in range(len(own) - n + 1) if n else []:
                for j in places.get(tuple(own[i : i + n]), []):
                    hit.update(range(i, i + n))
                    found.add(str(item_id))
                    k = n
                    while i + k < len(own) and j + k < len(theirs) and own[i + k] == theirs[j + k]:
                        k += 1
                    longest = max(longest, k)
        out[doc_id] = (len(own), len(hit), sorted(found), longest)
    return out


def got(frame):
    return {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.longest) for r in frame.collect()}


LONG = " ".join(f"w{i % 97}" for i in range(30_000))
ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short ITEM"), (3, ""), (4, None), (5, "É é x-y"), (6, "a a a a a a a a a a a a a"), (7, " ".join(f"w{i}" for i in range(20, 60)))]
DOCS = [
    (1, "so One two, three four five six seven eight nine ten! eleven other"),
    (2, "two three four five six seven eight nine ten"),
    (3, "a short item here and a short item there"),
    (4, None),
    (5, ""),
    (6, "a " * 40),
    (7, LONG),
    (8, "É é x y"),
    (9, "short"),
    (10, "item short two three four five six seven eight nine ten eleven twelve one"),
]


def frames(spark, docs=DOCS, items=ITEMS):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_equals_brute_force(spark, block_bytes):
    docs, items = frames(spark)
    found = overlaps(docs, items, block_bytes=block_bytes)
    assert got(found) == brute(DOCS, ITEMS)


def test_random_texts_equal_brute_force(spark):
    import random

    dice = random.Random(4)
    make = lambda n: " ".join(dice.choice("abc") for _ in range(n))
    items = [(i, make(dice.choice([1, 3, 6, 9, 12]))) for i in range(12)]
    docs = [(i, make(dice.randrange(60))) for i in range(60)]
    for window in (3, 5):
        assert got(overlaps(*frames(spark, docs, items), window=window)) == brute(docs, items, window)


def test_corpus_equals_brute_force(spark, sf, corpus):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    expected = brute([(r.doc_id, r.text) for r in corpus.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(overlaps(corpus, items)) == expected
    assert any(v[1] for v in expected.values())


def test_filter_keeps_columns_rows_and_nulls(spark):
    docs, items = frames(spark)
    docs = docs.selectExpr("*", "'x' AS n_hit", "1 AS items").union(docs.where("doc_id = 9").selectExpr("*", "'x'", "1"))
    kept = remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 9, 9]


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert overlaps(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in overlaps(docs, items.limit(0)).collect()} == {0}
