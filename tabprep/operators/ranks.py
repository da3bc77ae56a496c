"""Exact order statistics (quantiles, medians, rank cuts) without sorting the table.

A value-to-count map per column, which the built-in exact ``percentile`` keeps, grows
with the distinct values, and a full sort shuffles everything. Here a small mergeable
sketch proposes two values around the wanted rank, a counting scan tells exactly how
many rows lie below, at and between them, and only the few rows strictly between are
looked at again, until they provably fit one task. The sketch decides the speed; the
counts decide the answer, so it is exact whatever the sketch said.
"""

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SKETCH = {
    "double": (F.kll_sketch_agg_double, F.kll_merge_agg_double, F.kll_sketch_get_n_double, F.kll_sketch_get_quantile_double),
    "bigint": (F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint, F.kll_sketch_get_n_bigint, F.kll_sketch_get_quantile_bigint),
}
_GRID = 400
_MARGIN = 0.004
_MERGE_GROUPS = 64
_COLUMNS_PER_SCAN = 20
_AGGREGATES_PER_SCAN = 64


@dataclass(frozen=True)
class RankProbe:
    """A column (NULL rows are skipped) and the ranks wanted from it.

    ``raw`` is a column of the table that equals ``value`` where that is not NULL; bounds on it reach the scan.

    ``ranks`` gets the number of values and returns groups of 0-based ranks; the
    ranks of one group are searched together and should lie close. ``size`` is the
    number of values, where the caller knows it.
    """

    value: Column
    ranks: Callable[[int], Sequence[Sequence[int]]]
    size: int | None = None
    raw: Column | None = None


@dataclass(frozen=True)
class RankHit:
    """The value at a rank, the rows below it and the rows equal to it."""

    value: Any
    below: int
    equal: int


@dataclass(frozen=True)
class _Value:
    """The columns that hold a probe's values, and what bounds are tested on."""

    name: str
    raw: str | None

    @property
    def column(self) -> Column:
        return F.col(self.name)

    @property
    def bound(self) -> Column:
        return F.col(self.raw or self.name)


@dataclass(frozen=True)
class _Span:
    """Ranks known to lie strictly between two values of one probe."""

    probe: int
    ranks: tuple[int, ...]
    low: Any
    high: Any
    below: int
    size: int

    def inside(self, value: Column, low=None, high=None) -> Column:
        """Whether a value lies strictly inside, also of tighter bounds if given."""
        low = self.low if low is None else low
        high = self.high if high is None else high
        if low is None and high is None:
            return value.isNotNull()
        if low is None:
            return value < F.lit(high)
        if high is None:
            return value > F.lit(low)
        return (value > F.lit(low)) & (value < F.lit(high))


def exact_ranks(
    df: DataFrame,
    probes: Sequence[RankProbe],
    kind: str = "double",
    extra: Callable[[Column], Sequence[Column]] | None = None,
    sketch_k: int = 1000,
    finish_rows: int = 1_000_000,
) -> tuple[list[dict[int, RankHit]], list[int], list[list]]:
    """Exact values at ranks, for all probes together.

    Returns per probe a dict rank → hit, the number of values, and the results of
    ``extra``: it gets a probe's values and returns aggregates, which ride on the
    first counting scan. ``df`` is scanned a few times and must give the same rows
    each time.
    """
    # Computed once per row as columns of their own; the many tests then stay small.
    names = [f"__v{i}" for i in range(len(probes))]
    raws = [f"__r{i}" if p.raw is not None else None for i, p in enumerate(probes)]
    df = df.withColumns(
        {n: p.value.cast(kind) for n, p in zip(names, probes)} | {r: p.raw for r, p in zip(raws, probes) if r}
    )
    values = [_Value(n, r) for n, r in zip(names, raws)]
    hits: list[dict[int, RankHit]] = [{} for _ in probes]
    known = [p.size for p in probes]
    if not extra and None not in known and sum(known) <= finish_rows:
        wanted = [tuple(sorted({r for g in p.ranks(p.size) for r in g})) for p in probes]
        _finish(df, values, [_Span(i, r, None, None, 0, n) for i, (r, n) in enumerate(zip(wanted, known)) if r], hits)
        return hits, known, [[] for _ in probes]
    everything = [_Span(i, (), None, None, 0, 0) for i in range(len(probes))]
    sketches = _sketch(df, values, everything, kind, sketch_k)
    totals = [n for n, _ in sketches]
    guesses = []
    for i, (n, grid) in enumerate(sketches):
        for group in probes[i].ranks(n) if n else ():
            span = _Span(i, tuple(sorted(set(group))), None, None, 0, n)
            guesses.append((span, *_guess(span, grid)))
    aggregates = [list(extra(v.column)) if extra else [] for v in values]
    extras: list[list] = []
    while guesses or any(aggregates):
        counts, found = _count(df, values, guesses, aggregates)
        extras = extras or found
        aggregates = [[] for _ in values]
        spans = []
        for (span, low, high), zone in zip(guesses, counts):
            spans += _narrow(span, low, high, zone, hits[span.probe])
        if sum(s.size for s in spans) <= finish_rows:
            _finish(df, values, spans, hits)
            break
        sketches = _sketch(df, values, spans, kind, sketch_k)
        guesses = [(s, *_guess(s, grid)) for s, (_, grid) in zip(spans, sketches)]
    return hits, totals, extras


def _sketch(df, values, spans, kind, sketch_k) -> list[tuple[int, list]]:
    """(number of values, grid of approximate quantiles) for every span.

    Sketches are merged in two steps, so that no single task receives one sketch
    from every input partition.
    """
    build, merge, size, quantile = _SKETCH[kind]
    names = [f"s{i}" for i in range(len(spans))]
    columns = [F.when(s.inside(values[s.probe].column), values[s.probe].column).alias(n) for s, n in zip(spans, names)]
    grid = F.split(F.lit(",".join(str(i / _GRID) for i in range(_GRID + 1))), ",").cast("array<double>")
    parts = (
        _inside_any(df, values, spans)
        .select(*columns, F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)).alias("merge_group"))
        .groupBy("merge_group")
        .agg(*[build(n, F.lit(sketch_k)).alias(n) for n in names])
    )
    merged = parts.agg(*[merge(n, F.lit(sketch_k)).alias(n) for n in names])
    row = merged.select(
        *[
            F.struct(size(n).alias("n"), F.when(size(n) > 0, quantile(n, grid)).alias("grid")).alias(n)
            for n in names
        ]
    ).first()
    return [(row[n]["n"] or 0, row[n]["grid"]) for n in names]


def _inside_any(df: DataFrame, values, spans) -> DataFrame:
    """Rows among which are all that lie inside a span.

    Where a probe names its raw column the bounds are tested on that one, so they reach the scan as filters.
    """
    if any(s.low is None and s.high is None for s in spans):
        return df
    tests = [span.inside(values[span.probe].bound) for span in spans]
    return df.where(functools.reduce(Column.__or__, tests))


def _guess(span: _Span, grid) -> tuple[Any, Any]:
    first = (span.ranks[0] - span.below) / span.size - _MARGIN
    last = (span.ranks[-1] - span.below + 1) / span.size + _MARGIN
    return grid[max(int(first * _GRID), 0)], grid[min(int(last * _GRID) + 1, _GRID)]


def _count(df, values, guesses, extra):
    """Rows of each span below, at, between and at the guessed values; and the extras.

    Few aggregates at a time keep the generated code small enough to be compiled.
    Each scan reads the columns of its own probes, so together they read each once.
    """
    wanted: list[list[Column]] = [[] for _ in values]
    for span, low, high in guesses:
        value = values[span.probe].column
        at_high = value == F.lit(high) if high > low else F.lit(False)
        tests = [span.inside(value, high=low), value == F.lit(low), span.inside(value, low, high), at_high]
        wanted[span.probe] += [F.count(F.when(t, 1)) for t in tests]
    results: list[list] = [[] for _ in values]
    scan: list[int] = []
    for i in range(len(values)):
        scan.append(i)
        planned = sum(len(wanted[j]) + len(extra[j]) for j in scan)
        following = len(wanted[i + 1]) + len(extra[i + 1]) if i + 1 < len(values) else _AGGREGATES_PER_SCAN
        if planned + following > _AGGREGATES_PER_SCAN:
            columns = [c for j in scan for c in (*wanted[j], *extra[j])]
            rows = df if any(extra) else _inside_any(df, values, [g[0] for g in guesses if g[0].probe in scan])
            row = list(rows.agg(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()) if columns else []
            for j in scan:
                size = len(wanted[j]) + len(extra[j])
                results[j], row = row[:size], row[size:]
            scan = []
    zones, taken = [], [0] * len(values)
    for span, _, _ in guesses:
        at = taken[span.probe]
        zones.append(results[span.probe][at : at + 4])
        taken[span.probe] += 4
    return zones, [r[len(w) :] for r, w in zip(results, wanted)]


def _narrow(span: _Span, low, high, zone, hits) -> list[_Span]:
    """Take the ranks that fell on a guessed value, keep smaller spans for the others."""
    under, at_low, between, at_high = zone
    left: dict[tuple, list[int]] = {}
    for rank in span.ranks:
        local = rank - span.below
        if local < under:
            part = (span.low, low, span.below, under)
        elif local < under + at_low:
            hits[rank] = RankHit(low, span.below + under, at_low)
            continue
        elif local < under + at_low + between:
            part = (low, high, span.below + under + at_low, between)
        elif local < under + at_low + between + at_high:
            hits[rank] = RankHit(high, span.below + under + at_low + between, at_high)
            continue
        else:
            passed = under + at_low + between + at_high
            part = (high, span.high, span.below + passed, span.size - passed)
        left.setdefault(part, []).append(rank)
    return [_Span(span.probe, tuple(ranks), *part) for part, ranks in left.items()]


def _finish(df, values, spans, hits) -> None:
    """Read the remaining ranks off value counts; the spans hold few rows by count."""
    if not spans:
        return
    pairs = []
    for i, span in enumerate(spans):
        value = values[span.probe].column
        pairs.append(F.when(span.inside(value), F.struct(F.lit(i).alias("span"), value.alias("value"))))
    counted = (
        _inside_any(df, values, spans)
        .select(F.explode(F.array_compact(F.array(*pairs))).alias("pair"))
        .groupBy("pair.span", "pair.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    running = Window.partitionBy("span").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.lit(False)
    for i, span in enumerate(spans):
        for rank in span.ranks:
            local = rank - span.below
            wanted = wanted | ((F.col("span") == i) & (F.col("upto") > local) & (F.col("upto") - F.col("n") <= local))
    for row in counted.withColumn("upto", F.sum("n").over(running)).where(wanted).collect():
        span = spans[row["span"]]
        below = span.below + row["upto"] - row["n"]
        for rank in span.ranks:
            if below <= rank < below + row["n"]:
                hits[span.probe][rank] = RankHit(row["value"], below, row["n"])


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    probabilities: Sequence[float],
    extra: Callable[[Column], Sequence[Column]] | None = None,
    sketch_k: int = 1000,
    finish_rows: int = 1_000_000,
    raws: dict[str, Column] | None = None,
) -> tuple[dict[str, list[float | None]], dict[str, int], dict[str, list]]:
    """Quantiles by linear interpolation between the two nearest values.

    Returns name → quantiles (None for a column without values), name → number of
    values, and name → results of ``extra`` aggregates.
    """
    names = list(columns)
    if len(names) > _COLUMNS_PER_SCAN:
        # Wide tables go group by group: a columnar scan reads each column once anyway.
        quantiles, counts, extras = {}, {}, {}
        for start in range(0, len(names), _COLUMNS_PER_SCAN):
            group = {n: columns[n] for n in names[start : start + _COLUMNS_PER_SCAN]}
            q, c, e = exact_quantiles(df, group, probabilities, extra, sketch_k, finish_rows, raws)
            quantiles, counts, extras = quantiles | q, counts | c, extras | e
        return quantiles, counts, extras

    def around(n: int) -> list[tuple[int, int]]:
        spots = [(n - 1) * p for p in probabilities]
        return [(int(s), min(int(s) + 1, n - 1)) for s in spots]

    raws = raws or {}
    probes = [RankProbe(c, around, raw=raws.get(n)) for n, c in columns.items()]
    hits, totals, extras = exact_ranks(df, probes, "double", extra, sketch_k, finish_rows)
    quantiles = {}
    for name, found, n in zip(columns, hits, totals):
        if not n:
            quantiles[name] = [None] * len(probabilities)
            continue
        quantiles[name] = []
        for p, (low, high) in zip(probabilities, around(n)):
            a, b = found[low].value, found[high].value
            part = (n - 1) * p - low
            # Also right where a value is infinite.
            quantiles[name].append(a if a == b or part == 0 else a + (b - a) * part)
    return quantiles, dict(zip(names, totals)), dict(zip(names, extras))
