"""Benchmark decontamination with suffix arrays of the training words.

Each task cuts its documents into shards of a few MB and builds the suffix array of
each shard: the word positions sorted by the words that follow. Every suffix of the
benchmark is then binary-searched in it, for all suffixes at once in numpy. The range
it falls into lists all places where its first ``window`` words stand verbatim; from
there matches are extended to their full length.

Words that no benchmark item has can't be part of a match, so they all get the id 0 and
suffixes that reach one within a window are left out of the array. This prunes, it
never drops a match. Nothing is shuffled: a document is judged where it is read.

The benchmark is sent to the tasks in blocks of at most ``block_bytes`` of text. More
blocks mean more passes over a shard, never a larger broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.shared import filtered, id_and_text, pieces, raw_bytes, type_of

WINDOW = 10
BLOCK_BYTES = 16 << 20
# Bytes that separate words: all ASCII but digits and letters; A-Z become a-z.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BETWEEN = b" \x01 "


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i] .. starts[i] + counts[i] - 1`` for each i, one after the other."""
    total = int(counts.sum())
    firsts = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(firsts - starts, counts)


class Shard:
    """Word ids of some documents and the suffix array of the positions that can match."""

    def __init__(self, texts: list[bytes], ids: dict[bytes, int], shortest: int, depth: int) -> None:
        stream = _BETWEEN.join(t.translate(_TABLE) for t in texts).split()
        words = np.fromiter(map(ids.get, stream, repeat(0)), np.int64, len(stream))
        breaks = np.flatnonzero(words == -1)
        words[breaks] = 0
        self.words = np.concatenate([words, np.zeros(depth + 1, np.int64)])
        self.begins = np.concatenate([[0], breaks + 1])
        self.ends = np.concatenate([breaks, [len(words)]])
        zeros = np.flatnonzero(self.words == 0)
        before = np.concatenate([[-1], zeros[:-1]])
        runs = zeros - before - 1
        usable = np.maximum(runs - shortest + 1, 0)
        places = ragged(before + 1, usable)
        bits = max(1, (len(ids) + 1).bit_length())
        self.per_key, self.bits = max(1, 63 // bits), bits
        keys = self.keys(self.words, places, depth)
        order = np.lexsort(keys[::-1]) if len(places) else np.zeros(0, np.int64)
        self.suffixes, self.sorted_keys = places[order], [k[order] for k in keys]

    def keys(self, words: np.ndarray, places: np.ndarray, depth: int) -> list[np.ndarray]:
        """The ``depth`` words from each place on, several words in one integer."""
        out = []
        for first in range(0, depth, self.per_key):
            key = np.zeros(len(places), np.int64)
            for j in range(first, first + self.per_key):
                key = key << self.bits
                if j < depth:
                    key |= words[places + j]
            out.append(key)
        return out

    def search(self, words: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place of ``words``: the range of suffixes that begin with its ``length`` words."""
        sought = self.keys(words, places, length)
        spare = -length % self.per_key
        have = self.sorted_keys[: len(sought)]

        def bound(right: bool) -> np.ndarray:
            low, high = np.zeros(len(places), np.int64), np.full(len(places), len(self.suffixes))
            while (open_ := low < high).any():
                middle = np.minimum((low + high) // 2, max(0, len(self.suffixes) - 1))
                less, same = np.zeros(len(places), bool), np.ones(len(places), bool)
                for n, (theirs, ours) in enumerate(zip(have, sought)):
                    mine = theirs[middle]
                    if n == len(sought) - 1 and spare:
                        mine = (mine >> (spare * self.bits)) << (spare * self.bits)
                    less |= same & (mine < ours)
                    same &= mine == ours
                goes_right = less | same if right else less
                low = np.where(open_ & goes_right, middle + 1, low)
                high = np.where(open_ & ~goes_right, middle, high)
            return low

        return bound(False), bound(True)


class Benchmark:
    """The items of one block: their words, and their distinct windows by length."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.names: list[str] = []
        words: list[int] = []
        windows: dict[int, dict[tuple[int, ...], list[int]]] = {}
        owner: list[int] = []
        for name, text in items:
            own = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            if not own:
                continue
            length, at = min(window, len(own)), len(words)
            for i in range(len(own) - length + 1):
                windows.setdefault(length, {}).setdefault(tuple(own[i : i + length]), []).append(at + i)
            owner += [len(self.names)] * (len(own) + 1)
            words += [*own, 0]
            self.names.append(name)
        self.ids[b"\x01"] = -1
        self.words = np.array([*words, *[0] * (window + 1)], np.int64)
        self.owner = np.array(owner, np.int64)
        # By length: a first place of each distinct window, all its places, and the set of items it stands in.
        self.windows, sets = {}, {}
        for length, found in windows.items():
            places = list(found.values())
            item_sets = [sets.setdefault(tuple(sorted({owner[p] for p in ps})), len(sets)) for ps in places]
            self.windows[length] = (np.array([ps[0] for ps in places]), places, np.array(item_sets))
        self.item_sets = list(sets)
        self.lengths = sorted(self.windows)

    def scan(self, texts: list[bytes]) -> list[dict]:
        """What each text shares with the items: words, spans of hit words, items, the longest match."""
        if not self.lengths:
            return [{"n_words": len(words_of(t)), "spans": [], "items": set(), "longest": 0} for t in texts]
        shard = Shard(texts, self.ids, self.lengths[0], self.lengths[-1])
        covered = np.zeros(len(shard.words) + 1, np.int64)
        found = [{"n_words": int(e - b), "spans": [], "items": set(), "longest": 0} for b, e in zip(shard.begins, shard.ends)]
        for length in self.lengths:
            first, places, item_set = self.windows[length]
            low, high = shard.search(self.words, first, length)
            counts = high - low
            if not counts.any():
                continue
            window = np.repeat(np.arange(len(first)), counts)
            at = shard.suffixes[ragged(low, counts)]
            np.add.at(covered, at, 1)
            np.add.at(covered, at + length, -1)
            doc = np.searchsorted(shard.ends, at, "right")
            for d, s in np.unique(np.stack([doc, item_set[window]]), axis=1).T.tolist():
                found[d]["items"].update(self.names[i] for i in self.item_sets[s])
            self._extend(shard, at, window, places, length, doc, found)
        hit = np.cumsum(covered)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        starts, stops = edges[::2], edges[1::2]
        for d, b, e in zip(np.searchsorted(shard.ends, starts, "right").tolist(), starts.tolist(), stops.tolist()):
            base = int(shard.begins[d])
            found[d]["spans"].append((b - base, e - base))
        return found

    def _extend(self, shard: Shard, at: np.ndarray, window: np.ndarray, places: list, length: int, doc: np.ndarray, found: list) -> None:
        """Lengthen the matches that have no word in common before them to the longest verbatim match."""
        longest = np.zeros(len(found), np.int64)
        sizes = np.array([len(p) for p in places])
        step = 1 << 20
        ends = np.cumsum(sizes[window])
        begin = 0
        while begin < len(at):
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + step, "right")))
            part = window[begin:stop]
            theirs = np.concatenate([places[w] for w in part.tolist()]).astype(np.int64)
            ours = np.repeat(at[begin:stop], sizes[part])
            owner = np.repeat(doc[begin:stop], sizes[part])
            same_before = (shard.words[ours - 1] == self.words[theirs - 1]) & (ours > 0) & (theirs > 0) & (self.words[theirs - 1] > 0)
            ours, theirs, owner = ours[~same_before], theirs[~same_before], owner[~same_before]
            n = length
            np.maximum.at(longest, owner, n)
            while len(ours):
                go = (self.words[theirs + n] == shard.words[ours + n]) & (self.words[theirs + n] > 0)
                ours, theirs, owner, n = ours[go], theirs[go], owner[go], n + 1
                np.maximum.at(longest, owner, n)
            begin = stop
        for d in np.flatnonzero(longest).tolist():
            found[d]["longest"] = max(found[d]["longest"], int(longest[d]))


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((b, e))
    return out


def benchmark_blocks(benchmark: DataFrame, id_column: str, text_column: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of at most ``block_bytes`` of text, one block on the driver at a time."""
    items = benchmark.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text"))
    block, held = [], 0
    for row in items.where("text is not null").toLocalIterator():
        text = row.text.encode()
        if block and held + len(text) > block_bytes:
            yield block
            block, held = [], 0
        block.append(("" if row.id is None else row.id, text))
        held += len(text)
    yield block


def _scanner(blocks: list, window: int) -> Callable[[list[bytes]], list[dict]]:
    """A function for tasks; each of ``blocks`` gives the items of one block."""
    ready: list[Benchmark] = []

    def scan(texts: list[bytes]) -> list[dict]:
        total: list[dict] | None = None
        for n, block in enumerate(blocks):
            if len(blocks) == 1 and not ready:
                ready.append(Benchmark(block.value, window))
            found = (ready[0] if ready else Benchmark(block.value, window)).scan(texts)
            # Of many blocks a task holds one at a time; the others wait on disk.
            vars(block).pop("_value", None)
            if total is None:
                total = found
                continue
            for a, b in zip(total, found):
                a["spans"] = _union(a["spans"] + b["spans"])
                a["items"] |= b["items"]
                a["longest"] = max(a["longest"], b["longest"])
        return total or []

    return scan


def _blocks(docs: DataFrame, benchmark: DataFrame, id_column: str, text_column: str, block_bytes: int) -> list:
    context = docs.sparkSession.sparkContext
    return [context.broadcast(b) for b in benchmark_blocks(benchmark, id_column, text_column, block_bytes)]


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items, longest, spans``.

    ``spans`` are the word ranges (end exclusive) that lie inside any occurrence of ``window``
    consecutive item words; an item with fewer words counts as one window, one without words
    never matches. ``items`` are the ids of the items found, sorted as strings; ``longest``
    is the longest verbatim match in words. A null or empty text has no words and no hits;
    repeated rows are judged one by one; an empty table gives an empty result, an empty
    benchmark no hits. Items with null ids go under the empty name.
    """
    scan = _scanner(_blocks(docs, benchmark, item_column, item_text_column, block_bytes), window)
    rows = id_and_text(docs, id_column, text_column)
    span = "array<struct<start:bigint,end:bigint>>"
    schema = f"doc_id {type_of(rows, 'doc_id')}, n_words bigint, n_hit bigint, items array<string>, longest int, spans {span}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = scan(raw_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f["n_words"] for f in found], pa.int64()),
                    pa.array([sum(e - b for b, e in f["spans"]) for f in found], pa.int64()),
                    pa.array([sorted(f["items"]) for f in found], pa.list_(pa.string())),
                    pa.array([f["longest"] for f in found], pa.int32()),
                    pa.array(
                        [[{"start": b, "end": e} for b, e in f["spans"]] for f in found],
                        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                    ),
                ],
                names=["doc_id", "n_words", "n_hit", "items", "longest", "spans"],
            )

    return rows.mapInArrow(run, schema)


def remove_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents without any hit, with all their columns; nulls and empty texts stay."""
    scan = _scanner(_blocks(docs, benchmark, item_column, item_text_column, block_bytes), window)

    return filtered(docs, text_column, lambda texts: [not f["spans"] for f in scan(raw_bytes(texts))])
