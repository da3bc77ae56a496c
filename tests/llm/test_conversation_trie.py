import hashlib
import random
import zlib

import pytest

from tabprep.llm.conversation_trie import conversation_trie


def plain(rows):
    """The nodes by sequences themselves, of (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        whole = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append(c)
        ends.setdefault(tuple(whole), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, ids in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
            saved[node[:d]] = saved.get(node[:d], 0) + (len(ids) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted(
        (ids[0], len(n), members[n[:-1]][0] if n else -1, len(ids), children.get(n, 0), leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends.get(n, []))).encode()).hexdigest())
        for n, ids in members.items()
    )


def nodes(spark, rows, **options):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").selectExpr("*", "1 AS shard", "2 AS depth", "'x' AS k1")
    return sorted(tuple(-1 if v is None else v for v in r) for r in conversation_trie(frame, **options).collect())


def random_rows(seed, conversations, turns, first=0):
    dice = random.Random(seed)
    rows = []
    for c in dice.sample(range(first, first + 2 * conversations), conversations):
        for t in range(dice.randint(1, turns)):
            # Often the same turn, sometimes none; numbers have gaps.
            rows.append((c, None if t == 0 and dice.random() < 0.2 else 3 * t + 1, dice.choice(["user", "assistant", None]) if t > 2 else "user", dice.choice(["a", "bé", None, ""]) if t else "same"))
    dice.shuffle(rows)
    return rows


def test_equals_plain_sequences(spark):
    rows = random_rows(1, 60, 9) + random_rows(2, 40, 12, first=990)
    assert nodes(spark, rows) == plain(rows)


def test_long_conversations_span_bands_and_shards(spark):
    rows = random_rows(3, 30, 6) + [(c, t, "user", str(t if c != 33 or t < 21 else -t)) for c in (30, 31, 32, 33, 71) for t in range(30)]
    assert nodes(spark, rows, shard=10, band=4) == plain(rows)


def test_a_conversation_over_many_partitions(spark):
    rows = [(5, t, "user", f"turn {t % 7}") for t in range(260)] + [(6, t, "user", f"turn {t % 7}") for t in range(40)]
    assert nodes(spark, rows) == plain(rows)


def test_odd_rows(spark):
    # A turnless conversation: its base is absent and all its own turns are cut.
    empty = next(c for c in range(100, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(empty, 0, "user", "gone"), (empty, 1, "user", "gone"), (None, 0, "user", "none"), (0, 1, None, None), (0, 1, None, None), (0, None, "", "x" * 200_000), (7, 2, "user", "é")]
    got = nodes(spark, rows)
    assert got == plain(rows) and got[0][3] == 3
    frame = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    assert conversation_trie(frame.limit(0)).count() == 0


@pytest.mark.parametrize("same", [2500])
def test_a_large_group_of_copies(spark, same):
    rows = [(5 * c, t, "user", str(t)) for c in range(same) for t in range(2)]
    assert nodes(spark, rows) == plain(rows)
