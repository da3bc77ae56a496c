"""Unigram token counts with the forward scores shared along a trie.

The pre-tokens of a text are its words, each with the mark of a word's beginning. The best segmentation of a pre-token
into vocabulary pieces follows from the best ones of its prefixes, so all distinct
pre-tokens of a batch are inserted in a trie (in sorted order, so that its nodes are visited depth
first and only one path is open) and each node, a prefix that any number of words share, is scored once. Words
keep the count at their terminal node; a text's count is their sum.

The vocabulary is a file of the sentencepiece library and isn't trained here. It orders pieces by
frequency; the piece of rank r has the probability of Zipf's law, in whole millionths of a nat, so
that sums are exact. Letters without a piece fall back to their bytes, each less likely than any piece.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabprep.llm.shared import id_and_text, pieces, strings, type_of
from tabprep.llm.tokens import public_path

MARK = "▁"
#: Bytes of words that a worker remembers the counts of; beyond that it keeps those of its latest batch.
REMEMBERED_BYTES = 64 << 20
_EACH = 100  # about what Python needs for each of them besides


def _bytes_of(words: set[str]) -> int:
    return sum(map(sys.getsizeof, words)) + _EACH * len(words)


class Unigram:
    """Pieces with scores, and the counts of the words a worker has met."""

    def __init__(self, scores: dict[str, int], byte_score: int, remembered: int = REMEMBERED_BYTES) -> None:
        self.scores, self.byte_score = scores, byte_score
        self.longest = max(map(len, scores), default=1)
        self.remembered = remembered
        self.counts: dict[str, int] = {}
        self.held = 0
        self.nodes = 0  # trie nodes scored so far

    @classmethod
    def from_file(cls, path: str) -> Unigram:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        norm = sum(1 / (r + 2) for r in range(len(plain)))
        scores = {model.id_to_piece(i): round(-1e6 * math.log((r + 2) * norm)) for r, i in enumerate(plain)}
        return cls(scores, 2 * min(scores.values()))

    def learn(self, words: set[str]) -> None:
        """Insert words in a trie and store the count at the end of each."""
        score, longest, byte_score = self.scores.get, self.longest, self.byte_score
        # The open path: for each prefix of ``path`` the best score, and the fewest tokens that reach it.
        path, best, tokens = "", [0], [0]
        for word in sorted(words):
            text = MARK + word
            shared, most = 0, min(len(path), len(text))
            while shared < most and path[shared] == text[shared]:
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(text) + 1):
                letter = score(text[end - 1 : end])
                if letter is None:
                    size = len(text[end - 1].encode())
                    top, count = best[-1] + size * byte_score, tokens[-1] + size
                else:
                    top, count = best[-1] + letter, tokens[-1] + 1
                for begin in range(max(0, end - longest), end - 1):
                    own = score(text[begin:end])
                    if own is not None:
                        own += best[begin]
                        if own > top or own == top and tokens[begin] + 1 < count:
                            top, count = own, tokens[begin] + 1
                best.append(top)
                tokens.append(count)
            self.nodes += len(text) - shared
            self.counts[word] = tokens[-1]
            path = text

    def count(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """Tokens and words of each text."""
        many = [t.split() for t in texts]
        words = [w for own in many for w in own]
        distinct = set(words)
        new = distinct.difference(self.counts)
        self.learn(new)
        self.held += _bytes_of(new)
        each = np.fromiter(map(self.counts.__getitem__, words), np.int64, len(words))
        sizes = np.array([len(own) for own in many], np.int64)
        reached = np.concatenate([[0], np.cumsum(each)])
        ends = np.cumsum(sizes)
        if self.held > self.remembered:
            self.counts = {w: self.counts[w] for w in distinct}
            self.held = _bytes_of(distinct)
        return (reached[ends] - reached[ends - sizes]).tolist(), sizes.tolist()


_models: dict[str, Unigram] = {}


def unigram(path: str) -> Unigram:
    """The model of this worker process."""
    if path not in _models:
        _models.clear()
        _models[path] = Unigram.from_file(path)
    return _models[path]


def token_counts(docs: DataFrame, *, model_file: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_words`` for each row.

    Words are what white space separates. A null or empty text has none; repeated rows are counted one by
    one; an empty table gives no rows; other columns aren't read. Ties between
    segmentations go to the one with fewer tokens.
    """
    path = model_file or public_path("piece_bpe_32k.model")
    rows = id_and_text(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            tokens, words = unigram(path).count(strings(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(tokens, pa.int64()), pa.array(words, pa.int64())], names=["doc_id", "n_tokens", "n_words"])

    return rows.mapInArrow(run, f"doc_id {type_of(rows, 'doc_id')}, n_tokens bigint, n_words bigint")
