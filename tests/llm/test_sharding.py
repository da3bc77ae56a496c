import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from tabprep.llm.sharding import difference, shard_by_bytes, water_level


def spread(loads):
    return max(loads) - min(loads)


def test_differencing_near_the_best_of_all_partitions():
    dice = random.Random(8)
    for _ in range(20):
        weights = [dice.randint(1, 40) for _ in range(7)]
        best = min(spread([sum(w for w, s in zip(weights, own) if s == k) for k in range(3)]) for own in product(range(3), repeat=7))
        shards, loads = difference(weights, 3)
        assert Counter({k: int(v) for k, v in enumerate(loads)}) == Counter({k: sum(w for w, s in zip(weights, shards) if s == k) for k in range(3)})
        assert spread(loads) <= best + 12


def test_many_weights_level_to_a_few_bytes():
    dice = np.random.default_rng(1)
    weights = dice.lognormal(7, 1, 5000).astype(int).tolist()
    _, loads = difference(weights, 40)
    assert spread(loads) <= 20
    held = dice.integers(0, 50_000, 40).astype(float)
    shards, more = difference(weights, 40, held)
    assert spread(held + more) <= 20
    assert spread(held + np.bincount(shards, weights=weights, minlength=40)) <= 20


def test_water_level():
    assert water_level(np.array([10.0, 0, 4]), 8).tolist() == [0, 6, 2]
    assert water_level(np.array([1.0, 1]), 0).tolist() == [0, 0]


def check(rows, docs, shards):
    by_shard, shard_of = defaultdict(list), defaultdict(set)
    expected = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    for r in rows:
        assert 0 <= r.shard < shards
        by_shard[r.shard].append(r)
        shard_of[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return [sum(r.size for r in by_shard[k]) for k in range(shards)]


@pytest.mark.parametrize("heavy_groups, block_groups", [(4096, 16_384), (10, 40), (0, 1000)])
def test_corpus(corpus, heavy_groups, block_groups):
    docs = [(r.doc_id, r.text) for r in corpus.collect()]
    loads = check(shard_by_bytes(corpus, 8, heavy_groups=heavy_groups, block_groups=block_groups).collect(), docs, 8)
    # Blocks of 40 groups are far too small to level 8 shards well; they show that many blocks come together.
    assert spread(loads) < (0.01 if block_groups > 40 else 0.3) * sum(loads) / 8


def test_a_group_larger_than_a_share_stands_alone(spark):
    docs = [(i, "copy " * 50) for i in range(400)] + [(1000 + i, f"text {i} " * (i % 17)) for i in range(900)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    for options in ({}, {"heavy_groups": 4, "block_groups": 100}):
        loads = check(shard_by_bytes(frame, 10, **options).collect(), docs, 10)
        rest = sorted(loads)[:-1]
        assert max(loads) == 400 * 266 and spread(rest) < 0.05 * sum(rest) / 9


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "é"), (3, "é"), (None, "x" * 100_000), (None, "x" * 100_000), (4, "y")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS shard", "'s' AS size", "2 AS row", "3 AS slot")
    check(shard_by_bytes(frame, 4).collect(), docs, 4)
    assert shard_by_bytes(frame.limit(0), 4).count() == 0
