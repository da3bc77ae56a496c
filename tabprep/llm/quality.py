"""Quality of texts by a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its words, hashed into buckets and weighted by the logarithm of their counts, and statistics of its structure (shares of kinds of
characters, lengths and repeats of words and lines) and metadata columns, each cut into bins at quantiles of the
training texts. Besides a weight each feature has a short vector, and each pair of features counts by
the product of theirs: half of the square of the sum less the sum of squares, so scoring is linear in the features.

It is trained in numpy by adaptive gradient steps on a bounded sample, and its scale calibrated on texts kept from
training. Long texts are read in parts, so memory doesn't grow with them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.shared import held_out, named, pieces, raw_bytes, sampled_texts, type_of

#: Most labelled rows of each label, and most text bytes of each, that a model is fitted on.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 16 << 20
WORDS = 1 << 16
BINS = 8
RANK = 6
EPOCHS = 5
BATCH = 32
THRESHOLD = 0.5
_PART = 2 << 20
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
# Kinds of bytes: small letters, capitals, digits, white space, sentence ends, other punctuation, other signs, beyond ASCII.
_KINDS = 8
_KIND = np.array(
    [0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 if c in b" \t\n\r\v\f" else 4 if c in b".!?" else 5 if c in b",;:'\"()-" else 6 if c < 128 else 7 for c in range(256)],
    np.uint8,
)
STATISTICS = (
    *("share_small", "share_capitals", "share_digits", "share_space", "share_ends", "share_punctuation", "share_signs", "share_beyond"),
    *("bytes", "words", "word_length", "longest_word", "distinct_words", "top_word", "lines", "line_length", "distinct_lines", "ended_lines"),
)


def parts_of(text: bytes, size: int = _PART) -> list[bytes]:
    """``text`` in parts of at most ``size`` bytes, cut after a line or else a space where there is one."""
    out, begin = [], 0
    while len(text) - begin > size:
        stop = begin + size
        at = max(text.rfind(b"\n", begin, stop), -1)
        at = at if at > begin + size // 2 else text.rfind(b" ", begin, stop)
        stop = at + 1 if at > begin else stop
        out.append(text[begin:stop])
        begin = stop
    return [*out, text[begin:]]


@dataclass
class Features:
    """Words of texts as sparse rows, and their statistics."""

    row: np.ndarray  # sorted
    bucket: np.ndarray
    value: np.ndarray
    statistics: np.ndarray


def extract(texts: list[bytes]) -> Features:
    n = len(texts)
    kinds, n_words, longest = np.zeros((n, _KINDS), np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    in_words, n_lines, ended = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    distinct_lines = np.zeros(n, np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def count(group: list[tuple[int, bytes]]) -> None:
        many = [t.translate(_TABLE).split() for _, t in group]
        sizes = np.array([len(w) for w in many])
        row = np.repeat(np.array([r for r, _ in group], np.int64), sizes)
        coded = pa.array([w for own in many for w in own], pa.binary()).dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        if len(codes):
            buckets = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % WORDS
            length = np.fromiter(map(len, words), np.int64, len(words))[codes]
            keys, counts = np.unique(row * WORDS + buckets[codes], return_counts=True)
            found.append((keys, counts))
            np.add.at(n_words, [r for r, _ in group], sizes)
            in_words[:] += np.bincount(row, weights=length, minlength=n).astype(np.int64)
            np.maximum.at(longest, row, length)
        for r, text in group:
            kinds[r] += np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=_KINDS)

    group: list[tuple[int, bytes]] = []
    held = 0
    for r, text in enumerate(texts):
        seen: set[int] = set()
        for part in parts_of(text):
            lines = [s for s in part.split(b"\n") if s]
            n_lines[r] += len(lines)
            ended[r] += sum(s[-1] in b".!?:\"'" for s in lines)
            seen.update(map(hash, lines))
            if held and held + len(part) > _PART:
                count(group)
                group, held = [], 0
            group.append((r, part))
            held += len(part)
        distinct_lines[r] = len(seen)
    if group:
        count(group)
    if found:
        keys = np.concatenate([k for k, _ in found])
        own, at = np.unique(keys, return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([c for _, c in found]))
    else:
        own, counts = np.zeros(0, np.int64), np.zeros(0)
    row, bucket = own // WORDS, own % WORDS
    value = np.log1p(counts)
    norm = np.sqrt(np.bincount(row, weights=value**2, minlength=n))
    value = value / np.maximum(norm[row], 1e-9)
    size = kinds.sum(axis=1)
    top, distinct = np.zeros(n), np.bincount(row, minlength=n)
    np.maximum.at(top, row, counts)

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a / np.maximum(b, 1)

    statistics = np.column_stack(
        [share(kinds, size[:, None]), np.log1p(size), np.log1p(n_words), share(in_words, n_words), longest, share(distinct, n_words), share(top, n_words)]
        + [np.log1p(n_lines), share(size, n_lines), share(distinct_lines, n_lines), share(ended, n_lines)]
    )
    return Features(row, bucket, value, statistics)


@dataclass(frozen=True)
class QualityModel:
    edges: np.ndarray  # of the bins of each statistic and metadata column
    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    scale: float
    shift: float

    def scores(self, texts: list[bytes], metadata: np.ndarray | None = None) -> np.ndarray:
        """Probability of label 1; ``metadata``: a column for each that the model was fitted with, NaN where there is none."""
        if not len(texts):
            return np.zeros(0)
        row, feature, value = _sparse(extract(texts), metadata, self.edges)
        z = self.scale * _raw(row, feature, value, len(texts), self.bias, self.weights, self.vectors)[0] + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _with_metadata(found: Features, metadata: np.ndarray | None) -> np.ndarray:
    return found.statistics if metadata is None else np.column_stack([found.statistics, metadata])


def _sparse(found: Features, metadata: np.ndarray | None, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, features and values, sorted by row. Each statistic is one of ``BINS`` bins or, if missing, one more."""
    columns = _with_metadata(found, metadata)
    n, many = columns.shape
    bins = np.column_stack([np.searchsorted(edges[k], columns[:, k], side="right") for k in range(many)])
    bins[np.isnan(columns)] = BINS
    numbers = WORDS + np.arange(many) * (BINS + 1) + bins
    row = np.concatenate([found.row, np.repeat(np.arange(n), many)])
    feature = np.concatenate([found.bucket, numbers.reshape(-1)])
    value = np.concatenate([found.value, np.full(n * many, 1 / np.sqrt(many))])
    order = np.argsort(row, kind="stable")
    return row[order], feature[order], value[order]


def _raw(row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int, bias: float, weights: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The machine's output for each row, and the sums of its features' vectors."""
    z = bias + np.bincount(row, weights=weights[feature] * value, minlength=n)
    sums = np.zeros((n, vectors.shape[1]))
    for f in range(vectors.shape[1]):
        part = vectors[feature, f] * value
        sums[:, f] = np.bincount(row, weights=part, minlength=n)
        z += 0.5 * (sums[:, f] ** 2 - np.bincount(row, weights=part**2, minlength=n))
    return z, sums


def fit(
    texts: list[bytes], labels: list[int], totals: tuple[int, int] = (1, 1), metadata: np.ndarray | None = None, *, rank: int = RANK, epochs: int = EPOCHS, seed: int = 7
) -> QualityModel:
    """Train on nine rows in ten and calibrate on the tenth; ``totals`` says how many rows of label 0 and 1 there are, of which these are a sample.

    Without rows of both labels the score is the labels' rate everywhere.
    """
    dice = np.random.default_rng(seed)
    y = np.array(labels, np.float64)
    columns = len(STATISTICS) + (0 if metadata is None else metadata.shape[1])
    size = WORDS + columns * (BINS + 1)
    weights, vectors = np.zeros(size), dice.normal(0, 0.05, (size, rank))
    none = np.zeros((columns, BINS - 1))
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return QualityModel(none, 0.0, weights, np.zeros((size, rank)), 1.0, float(np.log(rate / (1 - rate))))
    found = extract(texts)
    whole = _with_metadata(found, metadata)
    edges = np.array([np.quantile(own, np.arange(1, BINS) / BINS) if len(own := c[~np.isnan(c)]) else none[0] for c in whole.T])
    row, feature, value = _sparse(found, metadata, edges)
    begins = np.searchsorted(row, np.arange(len(y) + 1))
    each = np.where(y > 0, max(totals[1], 1) / y.sum(), max(totals[0], 1) / (len(y) - y.sum()))
    each /= each.mean()
    kept = np.zeros(len(y), bool)
    if len(y) >= 40:
        for label in (0, 1):
            kept[np.flatnonzero(y == label)[9::10]] = True
    train = np.flatnonzero(~kept)
    mean = float(np.average(y, weights=each))
    bias = float(np.log(mean / (1 - mean)))
    seen, seen_vectors, seen_bias = np.full(size, 1e-4), np.full((size, rank), 1e-4), 1e-4
    for epoch in range(epochs):
        rate = 0.1 / (1 + epoch)
        order = dice.permutation(train)
        for begin in range(0, len(order), BATCH):
            rows = order[begin : begin + BATCH]
            spans = [np.arange(begins[r], begins[r + 1]) for r in rows.tolist()]
            at = np.concatenate(spans)
            local = np.repeat(np.arange(len(rows)), [len(s) for s in spans])
            own, inverse = np.unique(feature[at], return_inverse=True)
            x, w, v = value[at], weights[own], vectors[own]
            z, sums = _raw(local, inverse, x, len(rows), bias, w, v)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * each[rows] / len(rows)
            pull = error[local] * x
            gradient = np.bincount(inverse, weights=pull, minlength=len(own)) + 1e-6 * w
            seen[own] += gradient**2
            weights[own] = w - rate * gradient / np.sqrt(seen[own])
            for f in range(rank):
                change = np.bincount(inverse, weights=pull * (sums[local, f] - v[inverse, f] * x), minlength=len(own)) + 1e-5 * v[:, f]
                seen_vectors[own, f] += change**2
                vectors[own, f] = v[:, f] - rate * change / np.sqrt(seen_vectors[own, f])
            seen_bias += float(error.sum()) ** 2
            bias -= rate * float(error.sum()) / np.sqrt(seen_bias)
    # Scale and shift of the output, on rows that training hasn't seen.
    check = np.flatnonzero(kept) if kept.any() else np.arange(len(y))
    z = _raw(row, feature, value, len(y), bias, weights, vectors)[0][check]
    scale, shift = _calibrated(z, y[check], each[check])
    return QualityModel(edges, bias, weights.astype(np.float32), vectors.astype(np.float32), scale, shift)


def _calibrated(z: np.ndarray, y: np.ndarray, each: np.ndarray) -> tuple[float, float]:
    """Scale and shift by logistic regression on one value, held near 1 and 0."""
    point, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    columns = np.column_stack([z, np.ones(len(z))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(columns @ point, -30, 30)))
        gradient = columns.T @ (each * (p - y)) + (point - start)
        curvature = (columns * (each * p * (1 - p))[:, None]).T @ columns + np.eye(2)
        point = point - np.linalg.solve(curvature, gradient)
    return max(float(point[0]), 1e-3), float(point[1])


def _numbers(columns: list[pa.Array]) -> np.ndarray | None:
    return np.column_stack([c.cast(pa.float64()).fill_null(float("nan")).to_numpy() for c in columns]) if columns else None


def quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    metadata: tuple[str, ...] = (),
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row.

    The model is fitted on at most ``sample_rows`` rows of each label whose crc32 of the id leaves 0 or 2 when divided by 3, and
    at most ``sample_bytes`` of their text for each label. Texts and the numeric ``metadata`` columns of ``docs`` alone enter a score. Null and
    empty texts have no words, and the statistics of nothing; missing metadata is a feature of its own. Without rows of both labels the score is
    the labels' rate everywhere. Repeated rows score alike; an empty table gives no rows; other columns aren't read.
    """
    keys = [f"m{i}" for i in range(len(metadata))]
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"), *[named(c).cast("double").alias(k) for c, k in zip(metadata, keys)]
    )
    allowed = labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).cast("int").alias("label"))
    found, totals = sampled_texts(rows, allowed.where(~held_out(F.col("doc_id")) & F.col("label").isin(0, 1)), sample_rows, sample_bytes)
    columns = [pa.array([r[k] for r in found], pa.float64()) for k in keys]
    model = fit([r["text"].encode() for r in found], [r["label"] for r in found], (totals.get(0, 0), totals.get(1, 0)), _numbers(columns))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            scores = shared.value.scores(raw_bytes(batch.column("text")), _numbers([batch.column(k) for k in keys]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, f"doc_id {type_of(rows, 'doc_id')}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
