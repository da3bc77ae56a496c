"""Language identification: averaged embeddings of hashed subwords and a linear softmax.

A text is lower-cased and its letters kept in words with a space around; its subwords are all runs of three and four
bytes of that, hashed into buckets. The mean of the buckets' embeddings goes through a linear layer.
Both are trained by stochastic gradient descent in numpy on a bounded sample. Since
everything before the softmax is linear, a trained model is one table of bucket by
language, and a text's logits are the mean of its rows: no more than a look-up per byte.

Confidence is calibrated on texts kept from training, by a temperature. A text is rejected if it has no letter, if its
confidence is too low, or the share of its subwords that training hasn't met too high, for texts of its language. The bounds
are set so that each rejects a stated share of good texts, by an exponential tail fitted to what texts kept from training have.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.shared import filtered, held_out, id_and_text, pieces, sampled_texts, strings, type_of

#: Most rows, and most text bytes, that a model is fitted on, shared evenly among the languages.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 24 << 20
BUCKETS = 1 << 17
WIDTH = 16
EPOCHS = 4
#: Share of good texts that each of the two bounds is to reject.
REJECT = 0.001
#: Weight, in subwords, of a language's usual share of unknown ones: short texts tell little.
_PRIOR = 40
UNDETERMINED = "und"
_PLAIN_LETTER = re.compile(r"[A-Za-z]")
_TABLE = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SHARD = 1 << 20
_SIZES = (3, 4)
_FACTORS = {3: np.uint32(0x9E3779B1), 4: np.uint32(0x85EBCA6B)}


def has_letter(text: str) -> bool:
    return bool(_PLAIN_LETTER.search(text)) or any(map(str.isalpha, text))


def normalised(text: str) -> bytes:
    words = text.lower().encode().translate(_TABLE).split()
    return b" %b " % b" ".join(words) if words else b""


def _buckets(data: np.ndarray, size: int, buckets: int) -> np.ndarray:
    """Bucket of the run of ``size`` bytes that begins at each place."""
    n = len(data) - size + 1
    value = np.zeros(max(n, 0), np.uint32)
    for i in range(size):
        value = (value << np.uint32(8)) | data[i : i + max(n, 0)]
    value = (value ^ (value >> np.uint32(15))) * _FACTORS[size]
    value ^= value >> np.uint32(13)
    return (value & np.uint32(buckets - 1)).astype(np.int32)


def _counts(text: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares."""
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    found = np.concatenate([_buckets(data, s, buckets) for s in _SIZES])
    own, counts = np.unique(found, return_counts=True)
    return own, (counts / max(len(found), 1)).astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray  # float32, bucket by language, and a last column that is 1 where training met the bucket
    bias: np.ndarray
    temperature: float
    least_confidence: np.ndarray  # of each language, as are the others
    most_unknown: np.ndarray
    usual_unknown: np.ndarray

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """Language, confidence and whether the text is rejected."""
        if not self.languages:
            return [(UNDETERMINED, 0.0, True)] * len(texts)
        logits, known, usable, n = self._logits(texts)
        best, confidence, unknown = self._measures(logits, known, n)
        bad = (confidence < self.least_confidence[best]) | (unknown > self.most_unknown[best])
        return [
            (self.languages[k], float(c), bool(b)) if good else (UNDETERMINED, 0.0, True) for k, c, b, good in zip(best.tolist(), confidence, bad, usable)
        ]

    def _measures(self, logits: np.ndarray, known: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the likeliest language, confidence in it, and the share of unknown subwords, drawn towards the usual one in short texts."""
        best = np.argmax(logits, axis=1)
        z = (logits - logits.max(axis=1, keepdims=True)) / self.temperature
        unknown = ((1 - known) * n + _PRIOR * self.usual_unknown[best]) / (n + _PRIOR)
        return best, 1 / np.exp(z).sum(axis=1), unknown

    def _logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool], np.ndarray]:
        """Logits, share of subwords that training has met, whether there is a letter, and number of subwords."""
        classes = len(self.languages)
        usable = [bool(classes and has_letter(t)) for t in texts]
        many = [normalised(t) for t in texts]
        sums, n = np.zeros((len(texts), classes + 1)), np.zeros(len(texts))
        begin = 0
        while begin < len(many):
            stop, held = begin, 0
            while stop < len(many) and (stop == begin or held + len(many[stop]) <= _SHARD):
                held += len(many[stop])
                stop += 1
            part = many[begin:stop]
            data = np.frombuffer(b"".join(part), np.uint8).astype(np.uint32)
            sizes = np.array([len(t) for t in part])
            starts = np.cumsum(sizes) - sizes
            for size in _SIZES:
                rows = np.flatnonzero(sizes >= size)
                if not len(rows):
                    continue
                at = _buckets(data, size, len(self.table))
                # Runs across two texts fall between the bounds and are left out.
                bounds = np.stack([starts[rows], starts[rows] + sizes[rows] - size + 1], axis=1).reshape(-1)
                n[begin + rows] += sizes[rows] - size + 1
                for k in range(classes + 1):
                    column = np.append(self.columns[k][at], np.float32(0))
                    sums[begin + rows, k] += np.add.reduceat(column, np.minimum(bounds, len(column) - 1), dtype=np.float64)[::2]
            begin = stop
        mean = sums / np.maximum(n, 1)[:, None]
        return mean[:, :classes] + self.bias, mean[:, classes], usable, n

    @property
    def columns(self) -> list[np.ndarray]:
        if "_columns" not in self.__dict__:
            object.__setattr__(self, "_columns", [np.ascontiguousarray(c) for c in self.table.T])
        return self.__dict__["_columns"]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_columns"}


def fit(
    texts: list[str], languages: list[str], *, buckets: int = BUCKETS, width: int = WIDTH, epochs: int = EPOCHS, reject: float = REJECT, seed: int = 1
) -> LanguageModel:
    """Train on four texts in five, calibrate on the fifth. Each text counts whole and as a short window, so that short texts are learned too."""
    dice = np.random.default_rng(seed)
    names = tuple(sorted(set(languages)))
    number = {v: i for i, v in enumerate(names)}
    kept = np.arange(len(texts)) % 5 == 4 if len(texts) >= 20 else np.zeros(len(texts), bool)
    met = np.zeros(buckets, bool)
    examples = []
    for text, language, keep in zip(texts, languages, kept):
        whole = normalised(text)
        if keep or len(whole) < 3:
            continue
        own, shares = _counts(whole, buckets)
        met[own] = True
        examples.append((own, shares, number[language]))
        size = int(dice.integers(20, 200))
        if len(whole) > size:
            at = int(dice.integers(0, len(whole) - size))
            examples.append((*_counts(whole[at : at + size], buckets), number[language]))
    embedding = dice.uniform(-1 / width, 1 / width, (buckets, width)).astype(np.float32)
    layer, bias = np.zeros((width, len(names)), np.float32), np.zeros(len(names), np.float32)
    seen = np.full(buckets, 1e-6, np.float32)  # squared gradients of a row, which scale its steps
    seen_layer = np.full(layer.shape, 1e-6, np.float32)
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for e in dice.permutation(len(examples)).tolist():
            own, shares, truth = examples[e]
            rate = 0.1 * (1 - done / max(steps, 1))
            done += 1
            hidden = shares @ embedding[own]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[truth] -= 1
            back = layer @ p
            gradient = np.outer(hidden, p)
            seen_layer += gradient**2
            layer -= rate * gradient / np.sqrt(seen_layer)
            bias -= 0.1 * rate * p
            seen[own] += shares**2 * float(back @ back) / width
            embedding[own] -= (rate * shares / np.sqrt(seen[own]))[:, None] * back
    table = np.concatenate([embedding @ layer * met[:, None], met[:, None].astype(np.float32)], axis=1)
    anything = np.zeros(len(names)), np.ones(len(names)), np.zeros(len(names))
    model = LanguageModel(names, table.astype(np.float32), bias.astype(np.float64), 1.0, *anything)
    check = [i for i in np.flatnonzero(kept).tolist() if has_letter(texts[i])]
    if not check:
        return model
    truth = np.array([number[languages[i]] for i in check], int)
    logits, known, _, n = model._logits([texts[i] for i in check])

    def loss(temperature: float) -> float:
        z = logits / temperature
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(truth)), truth]))

    temperature = min((0.25 * 1.25**k for k in range(16)), key=loss)
    # Short windows of the same texts too, since short texts are judged by the same bounds.
    windows = [normalised(texts[i])[: int(dice.integers(20, 200))].decode(errors="ignore") for i in check]
    good = [k for k, w in enumerate(windows) if has_letter(w)]
    more = model._logits([windows[k] for k in good])
    logits, known, n, truth = np.concatenate([logits, more[0]]), np.r_[known, more[1]], np.r_[n, more[3]], np.r_[truth, truth[good]]
    usual = np.array([np.average(1 - known[own], weights=n[own] + 1e-9) if (own := truth == k).any() else 0.0 for k in range(len(names))])
    model = LanguageModel(names, model.table, model.bias, temperature, *anything[:2], usual)
    _, confidence, unknown = model._measures(logits, known, n)

    def bounds(values: np.ndarray) -> np.ndarray:
        """What a share ``reject`` of a language's texts is to lie beyond; a language with few texts has the bound of all."""
        return np.array([_beyond(values[own] if (own := truth == k).sum() >= 30 else values, reject) for k in range(len(names))])

    return LanguageModel(names, model.table, model.bias, temperature, np.exp(-bounds(-np.log(confidence))), bounds(unknown), usual)


def _beyond(values: np.ndarray, share: float) -> float:
    """The bound that ``share`` of such values exceed, if their upper tenth falls off exponentially."""
    high = float(np.quantile(values, 0.9))
    over = values[values > high]
    return high + float((over - high).mean() if len(over) else 0.0) * math.log(max(0.1 / share, 1.0)) + 1e-9


def labelled_sample(docs: DataFrame, *, id_column: str, text_column: str, language_column: str, rows: int, size: int = SAMPLE_BYTES) -> tuple[list[str], list[str]]:
    """At most ``rows`` labelled rows that have an id and aren't held out, as evenly from the languages as they allow, by a hash.

    Each language has the same part of ``size`` text bytes; rows without room in it are passed over.
    """
    labelled = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"), F.col(language_column).cast("string").alias("label")
    ).where(~held_out(F.col("doc_id")) & F.col("text").isNotNull())
    labels = labelled.select("doc_id", "label")
    languages = max(1, labels.where("label IS NOT NULL").select("label").distinct().count())
    found, _ = sampled_texts(labelled, labels, max(1, rows // languages), max(1, size // languages))
    return [r["text"] for r in found], [r["label"] for r in found]


def fit_language_model(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang", sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> LanguageModel:
    """A model from at most ``sample_rows`` labelled rows whose crc32 of the id leaves 0 or 2 when divided by 3.

    Their texts have at most ``sample_bytes``, an equal part for each language; a language whose texts are all longer than its part has one of them.
    """
    return fit(*labelled_sample(docs, id_column=id_column, text_column=text_column, language_column=language_column, rows=sample_rows, size=sample_bytes))


def identify_language(
    docs: DataFrame,
    model: LanguageModel | None = None,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for each row.

    Only the whole text enters a prediction. A null text or one without a letter is ``und`` with score 0
    and rejected, as is every text if there are no labelled rows to learn from.
    Repeated rows score alike; an empty table gives no rows; other columns aren't read.
    """
    names = {"id_column": id_column, "text_column": text_column, "language_column": language_column}
    shared = docs.sparkSession.sparkContext.broadcast(model or fit_language_model(docs, **names, sample_rows=sample_rows, sample_bytes=sample_bytes))
    rows = id_and_text(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = shared.value.predict(strings(batch.column("text")))
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "lang_pred", "score", "rejected"])

    found = rows.mapInArrow(run, f"doc_id {type_of(rows, 'doc_id')}, lang_pred string, score double, rejected boolean")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(
    docs: DataFrame,
    model: LanguageModel | None = None,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """``docs``, with all columns, without the rows whose language is rejected."""
    names = {"id_column": id_column, "text_column": text_column, "language_column": language_column}
    shared = docs.sparkSession.sparkContext.broadcast(model or fit_language_model(docs, **names, sample_rows=sample_rows, sample_bytes=sample_bytes))

    return filtered(docs, text_column, lambda texts: [not f[2] for f in shared.value.predict(strings(texts))])
