import heapq
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tabprep.llm.shared import temporary_folder
from tabprep.llm.token_file import Decoder, canonical_codes, code_lengths, encode_block, read_token_file, write_token_file
from tabprep.llm.tokens import public_path

PLAIN = Tokenizer.from_file(public_path())
PLAIN.encode_special_tokens = True


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


def test_lengths_are_optimal_and_limited():
    dice = random.Random(7)
    for _ in range(60):
        counts = np.array([dice.choice([0, 1, 2, 9, 100, 5000]) for _ in range(dice.randrange(2, 60))])
        if np.count_nonzero(counts) < 2:
            continue
        assert int((code_lengths(counts, 40) * counts).sum()) == huffman_cost(counts.tolist())
        short = code_lengths(counts, 6)
        assert short.max() <= 6 and abs(sum(2.0**-b for b in short[counts > 0].tolist()) - 1) < 1e-12
    fibonacci = [1, 1]
    while len(fibonacci) < 30:
        fibonacci.append(sum(fibonacci[-2:]))
    assert code_lengths(np.array(fibonacci), 16).max() == 16


@pytest.mark.parametrize("kinds", [1, 2, 3, 700])
def test_blocks_come_back(kinds):
    dice = np.random.default_rng(kinds)
    blocks = [np.minimum(dice.geometric(0.05, n), kinds) - 1 for n in (0, 1, 255, 256, 257, 5000)]
    lengths = code_lengths(np.bincount(np.concatenate(blocks), minlength=kinds))
    made = [encode_block(b, canonical_codes(lengths), lengths) for b in blocks]
    back = Decoder(lengths).decode([m[0] for m in made], [m[1] for m in made], [len(b) for b in blocks])
    assert back.tolist() == np.concatenate(blocks).tolist()


def expected(docs):
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or "")):
        ids = [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def back(frame, **options):
    folder = write_token_file(frame, temporary_folder(frame.sparkSession, "test"), **options)
    rows = read_token_file(frame.sparkSession, folder, with_ids=True).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[1])


def test_corpus_comes_back(corpus):
    assert back(corpus.repartition(5)) == expected([(r.doc_id, r.text) for r in corpus.collect()])


def test_odd_rows(spark):
    docs = [(4, None), (2, ""), (9, "again"), (9, "again"), (None, "no id"), (1, "long " * 30_000), (3, "é 漢 <|endoftext|>")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS ids", "2 AS part", "3 AS base")
    assert back(frame.repartition(3), block_ids=1000) == expected(docs)
    assert back(frame.where("doc_id = 2")) == [(2, 0, 1, zlib.crc32(bytes(4)), [0])]
    assert back(frame.limit(0)) == []
