"""Toxicity by compression distance with two zstandard dictionaries.

A dictionary is trained on ordinary text, another on what toxic texts have and ordinary ones hardly do.
A window of a text - a word with its surroundings held fixed, since the frame of a
compressed word alone would hide it - is compressed with the ordinary dictionary and with both. It counts as
toxic if both thresholds hold: with the toxic dictionary the word costs next to nothing, so it stands there as a whole;
and the ordinary dictionary needs so many bytes more. How often a text's words do so, and by
how much, becomes a probability by logistic regression. Thresholds and weights are calibrated
on texts that the dictionaries of their fold haven't seen.

The method as dealt trains the toxic dictionary on whole toxic text and scores by the lengths alone. That
finds too little when few words of a text are toxic; the README has the figures of both.

Every word of every text is compared, a long run of letters also by overlapping windows; workers remember the lengths of words they have met.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.shared import held_out, id_and_text, pieces, raw_bytes, sampled_texts, type_of

#: Most labelled rows of each label that a model is fitted on.
SAMPLE_ROWS = 3000
#: Most text bytes of the rows of each label.
SAMPLE_BYTES = 16 << 20
FOLDS = 3
TOXIC_BYTES, ORDINARY_BYTES = 32_768, 65_536
LEVEL = 19
CARRIER = 60
PREDICT = 0.7
REMEMBERED = 600_000
_LONGEST = 48  # bytes of a window; longer words are cut into several
_STEP = 6  # bytes of the overlapping windows of a longer word: six plain letters, or two characters of most scripts without spaces
_NONE = (99, 0)
_PIECE = re.compile(rb"(?=([\x00-\x7f\xc0-\xff].{%d}))" % (_STEP - 1), re.S)
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Letters and digits, A-Z lower-cased, in windows of at most 48 bytes."""
    words = text.translate(_TABLE).split()
    if words and max(map(len, words)) > _LONGEST:
        words = [w[i : i + _LONGEST] for w in words for i in range(0, len(w), _LONGEST)]
    return words


def windows_of(text: bytes, only: frozenset[bytes] | None = None) -> list[bytes]:
    """``words_of``, and of each longer word also the six bytes from every character on, so that no cut hides what stands in it.

    These begin with a zero byte, which no word has; ``only`` leaves out all but those that it holds.
    """
    words = words_of(text)
    if _LONGEST in map(len, words):
        inside = (b"\0" + m[1] for w in text.translate(_TABLE).split() if len(w) > _LONGEST for m in _PIECE.finditer(w))
        words = words + [p for p in inside if only is None or p in only]
    return words


def _cut(windows: list[bytes]) -> list[bytes]:
    """``windows_of`` without the overlapping ones."""
    return [w for w in windows if w[:1] != b"\0"]


def _trained(size: int, samples: list[bytes], segment: int) -> bytes:
    """Content of a trained dictionary; of few samples, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def telling_words(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> set[bytes]:
    """Words eight times as rare in ordinary texts as in toxic ones, and hardly so by chance; however few texts have them."""
    in_toxic, in_ordinary = Counter(), Counter()
    for words in toxic:
        in_toxic.update(set(words))
    for words in ordinary:
        in_ordinary.update(set(words))
    rate = (len(ordinary) + 1) / (len(toxic) + 1)
    share = math.log((len(toxic) + 1) / (len(toxic) + len(ordinary) + 2))

    def tells(n: int, m: int) -> bool:
        """``n`` toxic and ``m`` ordinary texts have the word."""
        chance = n * share + math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
        return (n + 0.5) * rate > 8 * (m + 0.5) and chance < -11.5

    return {w for w, n in in_toxic.items() if len(w) > 2 and tells(n, in_ordinary[w])}


@dataclass
class Compressors:
    """The two dictionaries and the lengths they give."""

    toxic: bytes
    ordinary: bytes
    telling: tuple[bytes, ...]
    known: dict[bytes, tuple[int, int]] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"toxic": self.toxic, "ordinary": self.ordinary, "telling": self.telling}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, known={})

    def _ready(self) -> None:
        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=False, write_dict_id=False)

        self.with_both = compressor(self.toxic + self.ordinary).compress
        self.with_ordinary = compressor(self.ordinary).compress
        self.carrier = self.ordinary[len(self.ordinary) // 2 :][:CARRIER]
        # What the toxic dictionary's own words cost, beyond the window without a word: nineteen in twenty no more than this.
        self.base = 0
        own = sorted(len(self.with_both(self._window(w))) for w in self.telling)
        self.base = own[len(own) * 19 // 20] if own else 0

    @property
    def pieces(self) -> frozenset[bytes]:
        """The overlapping windows that the toxic dictionary has; of others it has nothing as a whole."""
        return frozenset(w for w in self.telling if w[:1] == b"\0")

    def _window(self, word: bytes) -> bytes:
        return b"%b\n\t%b\t\n" % (self.carrier, word)

    def lengths(self, words: set[bytes]) -> None:
        """Learn of each word: its bytes with both dictionaries, less those of a toxic word, and how many more with the ordinary one."""
        if not hasattr(self, "base"):
            self._ready()
        known, pieces = self.known, self.pieces
        for word in words.difference(known):
            if word[:1] == b"\0" and word not in pieces:
                known[word] = _NONE
                continue
            window = self._window(word)
            own = len(self.with_both(window))
            # A word that the toxic dictionary doesn't have as a whole is not toxic, whatever the other one needs.
            known[word] = (own - self.base, len(self.with_ordinary(window)) - own if own - self.base <= 2 else 0)

    def forget(self, latest: set[bytes]) -> None:
        if len(self.known) > REMEMBERED:
            self.known = {w: self.known[w] for w in latest}


def fit_compressors(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> Compressors:
    telling = telling_words(toxic, ordinary)
    segments = [b"\n\t%b\t\n" % w for words in toxic for w in words if w in telling]
    groups = [b"".join(segments[i : i + 8]) for i in range(0, len(segments), 8)]
    content = _trained(TOXIC_BYTES, groups, 48) if groups else b""
    # What the trainer has cut at the edge of a segment.
    content = b"".join(s for s in sorted(set(segments)) if s not in content)[:TOXIC_BYTES] + content
    plain = [b" ".join(words[i : i + 12]) for words in map(_cut, ordinary) for i in range(0, len(words), 12)]
    step = max(1, len(plain) // 150_000)
    return Compressors(content, _trained(ORDINARY_BYTES, plain[::step], 64) if plain else b" ", tuple(sorted(telling)))


@dataclass(frozen=True)
class ToxicityModel:
    compressors: Compressors
    cost: int
    gain: int
    weights: tuple[float, ...]

    def scores(self, texts: list[bytes]) -> list[float]:
        pieces = self.compressors.pieces
        many = [windows_of(t, pieces) for t in texts]
        latest = set().union(*many) if many else set()
        self.compressors.lengths(latest)
        known, out = self.compressors.known, []
        toxic = {w: known[w][1] for w in latest if known[w][0] <= self.cost and known[w][1] >= self.gain}
        for words in many:
            out.append(_probability(_features([(w, toxic[w]) for w in words if w in toxic], len(_cut(words))), self.weights))
        self.compressors.forget(latest)
        return out


def _features(hits: list[tuple[bytes, int]], words: int) -> list[float]:
    gain = max((g for _, g in hits), default=0)
    kinds = len({w for w, _ in hits})
    return [1.0, math.log1p(len(hits)), math.log1p(1000 * len(hits) / max(words, 1)), min(gain, 10) / 10, math.log1p(kinds)]


def _probability(features: list[float], weights: tuple[float, ...]) -> float:
    z = sum(f * w for f, w in zip(features, weights))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(rows: np.ndarray, labels: np.ndarray, each: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    weights = np.zeros(rows.shape[1])
    free = np.r_[1e-6, np.full(rows.shape[1] - 1, penalty)]
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        gradient = rows.T @ (each * (labels - p)) - free * weights
        weights = weights + np.linalg.solve((rows * (each * p * (1 - p))[:, None]).T @ rows + np.diag(free), gradient)
    return weights


def fit(texts: list[bytes], labels: list[int], totals: tuple[int, int] = (1, 1)) -> ToxicityModel:
    """Dictionaries from all texts; thresholds and weights from folds that the dictionaries of the others have scored.

    ``totals``: how many rows of label 0 and 1 there are, of which the texts may be a sample.
    """
    many, y = [windows_of(t) for t in texts], np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        rate = min(max((y.sum() + 0.5) / (len(y) + 1), 0.01), 0.99) if len(y) else 0.01
        return ToxicityModel(Compressors(b"", b" ", ()), -1, 99, (math.log(rate / (1 - rate)), 0.0, 0.0, 0.0, 0.0))
    fold = np.zeros(len(y), int)
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        fold[own] = np.arange(len(own)) % FOLDS
    lengths: list[list[tuple[bytes, int, int]]] = [[] for _ in many]
    for k in range(FOLDS):
        rest = [i for i in range(len(many)) if fold[i] != k]
        made = fit_compressors([many[i] for i in rest if y[i]], [many[i] for i in rest if not y[i]])
        for i in np.flatnonzero(fold == k).tolist():
            made.lengths(set(many[i]))
            lengths[i] = [(w, *made.known[w]) for w in many[i] if made.known[w][1] > 0]
    sizes = [len(_cut(words)) for words in many]
    each = np.where(y > 0, totals[1] / y.sum(), totals[0] / (len(y) - y.sum()))
    each *= len(y) / each.sum()
    best = None
    for cost in (-1, 0, 1):
        for gain in (2, 3, 4, 5):
            rows = np.array([_features([(w, g) for w, c, g in found if c <= cost and g >= gain], size) for found, size in zip(lengths, sizes)])
            weights = _logistic(rows, y, each)
            p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
            loss = -float(np.mean(each * np.where(y > 0, np.log(p + 1e-12), np.log(1 - p + 1e-12))))
            if best is None or loss < best[0]:
                best = loss, cost, gain, weights
    final = fit_compressors([w for w, v in zip(many, y) if v], [w for w, v in zip(many, y) if not v])
    return ToxicityModel(final, best[1], best[2], tuple(best[3].tolist()))


def labelled_sample(docs: DataFrame, labels: DataFrame, *, id_column: str, text_column: str, label_column: str, rows: int, size: int = SAMPLE_BYTES) -> tuple[list[bytes], list[int], tuple[int, int]]:
    """At most ``rows`` rows of each label, by the hash of the id, and how many there are; rows held out are never taken, nor those without room in ``size`` text bytes of their label."""
    allowed = labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).cast("int").alias("label"))
    allowed = allowed.where(~held_out(F.col("doc_id")) & F.col("label").isin(0, 1))
    found, totals = sampled_texts(id_and_text(docs, id_column, text_column), allowed, rows, size)
    return [r["text"].encode() for r in found], [r["label"] for r in found], (totals.get(0, 0), totals.get(1, 0))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
    threshold: float = PREDICT,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row.

    The model is fitted on at most ``sample_rows`` labelled rows of each label whose crc32 of the id
    leaves 0 or 2 when divided by 3, with at most ``sample_bytes`` of text for each label; a text over a hundredth of that
    is taken only if there is room after the others. Only texts enter a score. Null and empty texts get the
    score of a text without toxic words. Without rows of both labels the score is the labels'
    rate everywhere. Repeated rows score alike; an empty table gives no rows; other columns aren't read.
    """
    texts, values, totals = labelled_sample(docs, labels, id_column=id_column, text_column=text_column, label_column=label_column, rows=sample_rows, size=sample_bytes)
    model = docs.sparkSession.sparkContext.broadcast(fit(texts, values, totals))
    rows = id_and_text(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            scores = model.value.scores(raw_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, f"doc_id {type_of(rows, 'doc_id')}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
