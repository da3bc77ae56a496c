"""Audit of how the words of sources differ, by Arrow kernels in columnar shards.

Each task cuts its texts into terms with Arrow's own kernels (lower-casing, split, dictionary, hash group-by) and keeps one partial
count for each language, source and term. Spark merges the counts and finds the terms a language keeps. Their counts are
then dealt by term to shards; a shard is a block of terms by sources, in which numpy compares every pair of
sources. Sources meet in tiles, so that a block's width is bounded however many sources a language has. Counts, probabilities and
divergences are whole numbers, so nothing depends on the order of sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.shared import pieces, runs, stored

#: What stands between terms: all of ASCII but letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS = 3
TOP = 200
UNIT = 1_000_000_000
SIDE = 128  # sources on a side of a tile
_TEXT_BYTES = 8 << 20
_HELD_ROWS = 400_000
_CELLS = 1 << 20  # terms by sources that a shard compares at a time


def _partial_counts(batch: pa.RecordBatch) -> pa.Table:
    """``lang, source, term, n, docs``: occurrences and rows of each term in one batch."""
    lists = pc.split_pattern_regex(pc.ascii_lower(batch.column("text").cast(pa.large_string())), BETWEEN)
    coded = lists.flatten().dictionary_encode()
    document = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    codes = coded.indices.to_numpy()
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:
        document, codes = document[codes != empty], codes[codes != empty]
    by_document = pa.table({"document": document, "term": codes}).group_by(["document", "term"]).aggregate([([], "count_all")])
    pairs = pa.table({"lang": batch.column("lang"), "source": batch.column("source")})
    of = by_document.column("document")
    rows = pa.table([*[pairs.column(c).dictionary_encode().take(of) for c in ("lang", "source")], by_document.column("term"), by_document.column("count_all")], names=["lang", "source", "term", "n"])
    found = rows.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("n", "count")])
    terms = pc.take(coded.dictionary, found.column("term")).cast(pa.string())
    plain = [found.column(c).cast(pa.string()) for c in ("lang", "source")]
    return pa.table([*plain, terms, found.column("n_sum"), found.column("n_count")], names=["lang", "source", "term", "n", "docs"])


def _merged(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return found.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of string columns ``lang, source, text`` without nulls, one row for each task at least that has the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in pieces(batches, limit=_TEXT_BYTES):
            held.append(_partial_counts(batch))
            if sum(t.num_rows for t in held) > _HELD_ROWS:
                held = [_merged(held)]
                if held[0].num_rows > _HELD_ROWS // 2:
                    yield from held[0].to_batches(max_chunksize=50_000)
                    held = []
        if held:
            yield from _merged(held).to_batches(max_chunksize=50_000)

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def _probability(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10⁹ (count + 1) / total), three digits at a time so that no product leaves 64 bits."""
    quotient, rest = np.zeros(np.broadcast(counts, total).shape, np.int64), counts + np.int64(1)
    quotient += rest // total
    rest = rest % total
    for _ in range(3):
        rest = rest * 1000
        quotient = quotient * 1000 + rest // total
        rest = rest % total
    return quotient + 1


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class _Tile:
    """One shard's part of a tile of pairs: the sources numbered in block ``left`` by those in block ``right`` of one language."""

    def __init__(self, lang: str, left: int, right: int, side: int) -> None:
        self.lang, self.left, self.right, self.side = lang, left, right, side
        self.groups: dict[int, tuple[str, int]] = {}  # number of the source: name, occurrences
        self.vocabulary = self.in_language = 0
        self.sums: np.ndarray | None = None
        self.waiting: list[pa.RecordBatch] = []

    def introduce(self, rows: pa.RecordBatch) -> None:
        self.vocabulary, self.in_language = rows.column("vocabulary")[0].as_py(), rows.column("in_language")[0].as_py()
        for number, name, n in zip(*[rows.column(c).to_pylist() for c in ("number", "item", "n")]):
            self.groups[number] = name, n

    def _ready(self) -> None:
        numbers = sorted(self.groups)
        self.columns = {g: i for i, g in enumerate(numbers)}
        self.names = pa.array([self.groups[g][0] for g in numbers], pa.string())
        self.totals = np.array([self.groups[g][1] + self.vocabulary for g in numbers], np.int64)
        sides = np.array(numbers, np.int64) // self.side
        self.at_left, self.at_right = np.flatnonzero(sides == self.left), np.flatnonzero(sides == self.right)
        self.sums = np.zeros((len(self.at_left), len(self.at_right)), np.int64)
        self.terms = 0

    def take(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Counts in the order of terms; the last term may go on in the next batch."""
        if self.sums is None:
            self._ready()
        self.waiting.append(rows)
        if sum(w.num_rows for w in self.waiting) >= 1 << 16:
            yield from self._compare(False)

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.sums is None:
            self._ready()
        yield from self._compare(True)
        yield self._pairs()

    def _compare(self, last: bool) -> Iterator[pa.RecordBatch]:
        if not self.waiting:
            return
        table = pa.Table.from_batches(self.waiting).combine_chunks()
        coded = table.column("item").chunk(0).dictionary_encode()
        number = coded.indices.to_numpy().astype(np.int64)  # terms come in order, and so do their numbers
        end = len(number) if last else int(np.searchsorted(number, number[-1]))
        group, n, in_language = [table.column(c).to_numpy() for c in ("number", "n", "in_language")]
        most = max(1, _CELLS // max(len(self.columns), 1))
        begin = 0
        while begin < end:
            first = int(number[begin])
            stop = int(np.searchsorted(number[:end], first + most))
            own = slice(begin, stop)
            terms = coded.dictionary.slice(first, int(number[stop - 1]) - first + 1)
            yield from self._block(terms, number[own] - first, group[own], n[own], in_language[own])
            begin = stop
        self.waiting = table.slice(end).combine_chunks().to_batches() if end < len(number) else []

    def _block(self, terms: pa.Array, number: np.ndarray, group: np.ndarray, n: np.ndarray, in_language: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Count in whole terms; ``number`` says which of them each count belongs to."""
        column = np.array([self.columns[g] for g in group.tolist()], int)
        counts = np.zeros((len(terms), len(self.totals)), np.int64)
        counts[number, column] = n
        p = _probability(counts, self.totals[None, :])
        right = p[:, self.at_right]
        for i, at in enumerate(self.at_left.tolist()):
            self.sums[i] += _divergence(p[:, at][:, None], right).sum(axis=0)
        self.terms += len(terms)
        if self.left == self.right:
            q = np.zeros(len(terms), np.int64)
            q[number] = _probability(in_language, np.int64(self.in_language + self.vocabulary))
            own, q = p[number, column], q[number]
            more = np.flatnonzero(own > q)
            yield self._rows("term", column[more], terms.take(pa.array(number[more])), _divergence(own[more], q[more]))

    def _pairs(self) -> pa.RecordBatch:
        """The sums of all pairs, and what each term of which no row tells adds to them."""
        none = _probability(np.zeros(len(self.totals), np.int64), np.maximum(self.totals, 1))
        missing = _divergence(none[self.at_left][:, None], none[self.at_right][None, :])
        left, right = np.nonzero(self.at_left[:, None] != self.at_right[None, :])
        return self._rows("pair", self.at_left[left], self.names.take(pa.array(self.at_right[right])), self.sums[left, right], missing[left, right])

    def _rows(self, part: str, columns: np.ndarray, items: pa.Array, values: np.ndarray, missing: np.ndarray | None = None) -> pa.RecordBatch:
        n = len(values)
        fixed = [pa.repeat(pa.scalar(x, pa.string()), n) for x in (self.lang, part)]
        rest = np.zeros(n, np.int64) if missing is None else missing
        return pa.RecordBatch.from_arrays(
            [fixed[0], self.names.take(pa.array(columns)), fixed[1], items, pa.array(values), pa.array(np.full(n, self.terms, np.int64)), pa.array(rest)],
            names=["lang", "source", "part", "item", "value", "terms", "missing"],
        )


def _compare(batches: Iterator[pa.RecordBatch], side: int) -> Iterator[pa.RecordBatch]:
    """Rows of shards, in each the sources of a tile before its counts; yields divergences."""
    tile, key = None, None
    for own, rows in runs(batches, ("lang", "left", "right", "shard", "kind")):
        if own[:4] != key:
            if tile is not None:
                yield from tile.finish()
            tile, key = _Tile(*own[:3], side), own[:4]
        if own[4] == 0:
            tile.introduce(rows)
        else:
            yield from tile.take(rows)
    if tile is not None:
        yield from tile.finish()


def divergence(
    docs: DataFrame,
    *,
    least_documents: int = LEAST_DOCUMENTS,
    top: int = TOP,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    side: int = SIDE,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far the terms of each source lie from those of the others.

    A language keeps the terms in at least ``least_documents`` of its rows. With V of them, of which a source has N
    occurrences, a term met n times there has p = 1 + floor(10⁹ (n + 1) / (N + V)). Rows of part ``pair`` hold for each other source of the language
    (q) the sum of floor((p - q)² / q) over all kept terms, those of part ``term`` the ``top`` terms that the
    source has and has more often than the whole language (q). Ranks go by value, then item. ``side`` sources at most are
    on a side of a block in memory.

    Null texts, languages and sources are empty; an empty language or source is one like any other. Repeated rows count each
    time; a source without terms has p of 1 + floor(10⁹ / V) everywhere. An empty table gives no rows; other columns aren't read.
    """

    def text(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(""))

    rows = docs.select(text(lang_column).alias("lang"), text(source_column).alias("source"), text(text_column).alias("text"))
    spark = docs.sparkSession
    # One shuffle by language and term serves both the sums for each source and those for the language.
    met = term_counts(rows).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    kept = met.withColumns({"in_docs": F.sum("docs").over(term), "in_language": F.sum("n").over(term), "first": F.min("source").over(term)})
    kept = kept.where(F.col("in_docs") >= least_documents)
    kept = stored(kept.select("lang", "source", "term", "n", "in_language", (F.col("first") == F.col("source")).cast("bigint").alias("first")), "terms")

    used = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum("first").alias("firsts"))
    groups = rows.select("lang", "source").distinct().join(used, ["lang", "source"], "left")
    order, whole = Window.partitionBy("lang").orderBy("source"), Window.partitionBy("lang")
    none = F.lit(0).cast("bigint")
    groups = groups.select(
        "lang",
        "source",
        F.coalesce("n", none).alias("n"),
        F.sum(F.coalesce("firsts", none)).over(whole).alias("vocabulary"),
        F.sum(F.coalesce("n", none)).over(whole).alias("in_language"),
        (F.row_number().over(order) - 1).alias("number"),
        (F.count("*").over(whole) - 1).alias("last"),
    )
    groups = stored(groups.withColumns({"own": F.floor(F.col("number") / side).cast("int"), "tiles": F.floor(F.col("last") / side).cast("int")}), "sources")

    # A source goes to the tiles of its row and of its column; the one on the diagonal is in both.
    others = F.sequence(F.lit(0), F.col("tiles"))
    across = F.transform(others, lambda t: F.struct(F.col("own").alias("left"), t.alias("right")))
    down = F.transform(others, lambda t: F.struct(t.alias("left"), F.col("own").alias("right")))
    tiles = F.explode(F.array_union(across, down)).alias("tile")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["lang", F.col("tile.left").alias("left"), F.col("tile.right").alias("right"), "shard", "kind", "item", "number", "n", "in_language", "vocabulary"]
    heads = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    heads = heads.select("*", F.lit(0).alias("kind"), F.col("source").alias("item"), tiles).select(*columns)
    counts = kept.join(groups.select("lang", "source", "number", "own", "tiles"), ["lang", "source"])
    counts = counts.select("*", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"), F.lit(1).alias("kind"), F.col("term").alias("item"), none.alias("vocabulary"), tiles).select(*columns)
    keys = ["lang", "left", "right", "shard"]
    dealt = heads.unionAll(counts).repartition(shards, *keys).sortWithinPartitions(*keys, "kind", "item")
    found = stored(dealt.mapInArrow(lambda batches: _compare(batches, side), "lang string, source string, part string, item string, value bigint, terms bigint, missing bigint"), "divergences")

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    by_term = found.where("part = 'term'").select("lang", "source", "part", "item", "value")
    by_term = by_term.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    sums = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"), F.max("missing").alias("missing"))
    sums = sums.join(groups.groupBy("lang").agg(F.max("vocabulary").alias("vocabulary")), "lang")
    value = F.col("value") + (F.col("vocabulary") - F.col("terms")) * F.col("missing")
    by_pair = sums.select("lang", "source", "part", "item", F.when(F.col("vocabulary") > 0, value).otherwise(none).alias("value"))
    return by_pair.withColumn("rank", F.row_number().over(ranked)).unionAll(by_term)
