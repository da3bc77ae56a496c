import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tabprep.llm.packing import first_fit_decreasing, pack
from tabprep.llm.tokens import public_path

PLAIN = Tokenizer.from_file(public_path())
PLAIN.encode_special_tokens = True


def plain_first_fit(sizes, capacity):
    rooms, out = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, r in enumerate(rooms) if r >= sizes[i]), len(rooms))
        if at == len(rooms):
            rooms.append(capacity)
        out[i] = at, capacity - rooms[at]
        rooms[at] -= sizes[i]
    return out


def test_tree_equals_a_plain_search():
    dice = random.Random(6)
    for n in [1, 2, 3, 50, 400]:
        sizes = [dice.randint(1, 100) for _ in range(n)]
        bins, offsets = first_fit_decreasing(np.array(sizes), 100)
        assert list(zip(bins.tolist(), offsets.tolist())) == plain_first_fit(sizes, 100)


def check(rows, texts, capacity):
    """``texts``: (doc_id, text) with unique ids."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == {d for d, _ in texts}
    for doc_id, text in texts:
        ids = np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("group_pieces", [8192, 50])
def test_corpus(corpus, group_pieces):
    rows = pack(corpus, group_pieces=group_pieces).collect()
    sequences = check(rows, [(r.doc_id, r.text) for r in corpus.collect()], 1024)
    if group_pieces == 8192:
        assert sum(r.length for r in rows) / (sequences * 1024) > 0.98


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "word " * 5000), (4, "one"), (5, "two"), (6, "x" * 40_000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "7 AS offset", "'a' AS sequence_id", "2 AS group")
    check(pack(frame, capacity=64).collect(), docs, 64)
    with_ids = pack(frame, capacity=64, with_ids=True).collect()
    assert all(len(r.ids) == r.length for r in with_ids)
    repeated = spark.createDataFrame([(None, "same text")] * 5, "doc_id bigint, text string")
    assert pack(repeated).count() == 5
    assert pack(frame.limit(0)).count() == 0
