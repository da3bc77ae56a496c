import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabprep.llm.divergence import _probability, divergence

SCHEMA = "doc_id bigint, text string, lang string, source string"


def plain(rows, top=200):
    """In whole numbers of any size, of (doc_id, text, lang, source)."""
    counts, in_docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        counts[lang or "", source or ""].update(terms)
        in_docs[lang or ""].update(set(terms))
    out = []
    for lang in in_docs:
        kept = [t for t, n in in_docs[lang].items() if n >= 3]
        sources = [s for own, s in counts if own == lang]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def p(own):
            total = sum(own[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (own[t] + 1) // total for t in kept}

        of, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for s in sources:
            pairs = [(-sum((of[s][t] - of[o][t]) ** 2 // of[o][t] for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-((of[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[lang, s][t] and of[s][t] > q[t]]
            for part, own in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(own, 1)]
    return sorted(out)


def corpus_rows(seed, n, sources):
    dice = random.Random(seed)
    words = ["Wind", "wind", "RAIN", "é", "É", "straße", "漢字", "x1y", "don't", "a_b", "end."] + [f"w{chr(97 + i)}{'z' * (i % 3)}" for i in range(26)]
    rows = []
    for i in range(n):
        lang, source = dice.choice(["aa", "bb", "", None]), dice.choice([*sources, None])
        own = words[: 12 + len(source or "")] + [source or "none"] * 2
        rows.append((i, " ".join(dice.choice(own) for _ in range(dice.randrange(30))) if dice.random() > 0.1 else None, lang, source))
    return rows


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "'t' AS term", "0 AS shard", "1 AS value")
    return sorted(map(tuple, divergence(frame, **options).collect()))


def test_equals_whole_number_arithmetic(spark):
    rows = corpus_rows(1, 400, ["s1", "s22", "s333", "q", ""])
    assert found(spark, rows) == plain(rows)


def test_tiles_change_nothing(spark):
    rows = corpus_rows(2, 500, [f"s{i}" for i in range(17)])
    assert found(spark, rows, side=4) == plain(rows)


def test_odd_rows(spark):
    rows = [(1, "word word", "aa", "s"), (2, "word", "aa", "s"), (3, None, "aa", "t"), (4, "", None, None), (5, "12 !", "bb", "only"), (None, "other", "aa", "s")]
    assert found(spark, rows) == plain(rows)
    assert all(r[4] == 0 for r in found(spark, rows))  # no term is in three rows
    long = [(i, "Long " * 200_000 + "y" * 300_000, "aa", "s" if i % 2 else "t") for i in range(4)] + [(9, "long", "aa", "t")] * 2
    assert found(spark, long) == plain(long)
    assert divergence(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0


def test_ties_go_by_utf8(spark):
    rows = [(i, "ab ä 😀 ￿ zz", "aa", "s") for i in range(3)] + [(9, "zz", "aa", "t")]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("total", [1, 7, 10**9 + 1, 4 * 10**15 + 3])
def test_probability_is_exact(total):
    dice = random.Random(total)
    counts = [dice.randrange(total) for _ in range(200)]
    assert _probability(np.array(counts, np.int64), np.int64(total)).tolist() == [1 + 10**9 * (c + 1) // total for c in counts]
