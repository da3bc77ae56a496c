"""Token ids by the tokenizers library, with each distinct word encoded once.

Byte-level BPE never joins what stands on both sides of the space or line break after a word, so a text is the sequence
of its segments, cut there. A task encodes each distinct segment of its batches once, by the library's model,
and looks the others up. Tokenizers of another kind are called for the whole text.
"""

from __future__ import annotations

import json
import os
import re
import sys
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: The split of the byte-level pre-tokenizer (fixed value of that kind of tokenizer).
_PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
#: Letters that every version of the character tables has.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ʯ]+"
_WORD = f"^\n?{_LETTERS}$"
#: A word and what follows it, which is one pre-token if it doesn't begin with an apostrophe.
_WORD_AND_MARKS = rf"^(?P<word>\n?{_LETTERS})(?P<marks>[!-&(-/:-@\[-`{{-~][!-/:-@\[-`{{-~]*)$"
_TWO_SPACES = re.compile(r"\s\s")
_BESIDE_SPACE = re.compile(r"\s | \s")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
_BEFORE_BREAK = re.compile(r"(?<=\S)(?=\n)")
#: Bytes of segments and ids that a worker remembers; beyond that it keeps those of its latest batch.
REMEMBERED_BYTES = 128 << 20
#: About what Python and numpy need for each of them besides.
_EACH = 140
#: Words in a row for the model, few enough for the processor's cache.
_JOINED = 100
#: Words that are spelt at a time.
_SPELT = 80 * _JOINED
#: Numbers of pre-tokens that don't go in a row begin here.
_ALONE = 1 << 40


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else the next one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


class Encoder:
    """``encode`` gives the ids that ``encode_batch(texts, add_special_tokens=False)`` gives.

    The string of an added token in a text is that token, as the library has it; what stands before and after it is encoded on its own.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_BYTES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        self.by_word = parts["pre_tokenizer"] == _BYTE_LEVEL and parts["normalizer"] is None and model["type"] == "BPE" and not model["dropout"]
        added = parts["added_tokens"]
        # Tokens that also take white space around them, or need a word's edge, are left to the library.
        self.by_word = self.by_word and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added)
        self.added = {a["content"]: a["id"] for a in added}
        self.at_added = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))))
        self.vocabulary = self.whole.get_vocab_size()
        if self.by_word:
            self.words = Tokenizer.from_file(path)
            self.words.encode_special_tokens = True
            self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.letters = _byte_letters()
            self.opens = np.zeros(self.vocabulary, bool)
            self.opens[[i for w, i in self.words.get_vocab().items() if w[0] == self.letters[32] or w == self.letters[10]]] = True
            # The UTF-8 bytes that stand for each byte in a row: a space begins a word, a line break is a word of its own.
            spelt = [self.letters[b] for b in range(256)]
            spelt[32], spelt[10] = f" {spelt[32]}", f" {spelt[10]} "
            self.spelt = np.array([list(w.encode().ljust(4, b"\0")) for w in spelt], np.uint8)
            self.spelt_size = np.array([len(w.encode()) for w in spelt], np.uint8)
            self.remembered = remembered
            self._forget()

    def _forget(self) -> None:
        self.place: dict[str | tuple[str], int] = {}
        self.starts, self.counts = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.zeros(1 << 18, np.int32), 0
        self.held = 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        if not self.by_word:
            many = [e.ids for e in self.whole.encode_batch(texts, add_special_tokens=False)]
            return np.array([i for ids in many for i in ids], np.int32), np.array([len(i) for i in many], np.int64)
        if not any(a in t for a in self.added for t in texts):
            return self._encode(texts)
        # Texts in parts between added tokens, each part but the last of a text with the token after it.
        parts, after, of = [], [], []
        for n, text in enumerate(texts):
            own = self.at_added.split(text) if self.added else [text]
            parts += own
            after += [[self.added[a]] for a in self.at_added.findall(text)] + [[]]
            of += [n] * len(own)
        ids, counts = self._encode(parts)
        ends = np.cumsum(counts)
        more = np.array([len(a) for a in after], np.int64)
        ids = np.insert(ids, np.repeat(ends, more), [i for a in after for i in a])
        return ids.astype(np.int32), np.bincount(of, weights=counts + more, minlength=len(texts)).astype(np.int64)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Texts with a space at the beginning of each segment but the first; of a segment after a line break it isn't part.
        cut = [self._cut(t) if t else None for t in texts]
        plain = [n for n, t in enumerate(cut) if t is not None]
        lists = pc.split_pattern(pa.array([cut[n] for n in plain], pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        segments: list[str | tuple[str]] = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = [coded.indices.to_numpy()]
        sizes = np.zeros(len(texts), np.int64)
        order = np.zeros(len(texts), np.int64)  # where the segments of each text begin
        offsets = lists.offsets.to_numpy()
        sizes[plain], order[plain] = np.diff(offsets), offsets[:-1]
        # No space stands before the first segment of a text, so it goes under another name.
        firsts = [(cut[n].split(" ", 1)[0],) for n in plain]
        first = dict.fromkeys(firsts)
        begin = dict(zip(first, range(len(segments), len(segments) + len(first))))
        segments += first
        if plain:
            codes[0] = codes[0].astype(np.int64)
            codes[0][offsets[:-1]] = [begin[k] for k in firsts]
        at_end, distinct = len(codes[0]), True
        for n, text in enumerate(texts):
            if text and not sizes[n]:
                own = _BEFORE_SPACE.split(text)
                codes.append(np.arange(len(segments), len(segments) + len(own)))
                segments += [(own[0],), *[(s,) if s[1:2] == "\n" else s[1:] for s in own[1:]]]  # may repeat others
                distinct = False
                sizes[n], order[n], at_end = len(own), at_end, at_end + len(own)
        places = np.fromiter(map(self.place.get, segments, repeat(-1)), np.int64, len(segments))
        new = places < 0
        if new.any():
            keys = list(compress(segments, new.tolist()))
            if distinct:
                places[new] = self._learn(keys)
            else:
                self._learn(list(dict.fromkeys(keys)))
                places[new] = [self.place[k] for k in keys]
        at = places[np.concatenate(codes)]
        if at_end > offsets[-1]:  # bring the segments of all texts into the order of the texts
            at = at[np.arange(int(sizes.sum())) + np.repeat(order - (np.cumsum(sizes) - sizes), sizes)]
        counts = self.counts[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, self.used) < 1 << 31 else np.int64
        ids = self.flat[np.arange(total, dtype=kind) + np.repeat((self.starts[at] - (ends - counts)).astype(kind), counts)]
        last = np.cumsum(sizes)
        reached = np.concatenate([[0], ends])
        per_text = reached[last] - reached[last - sizes]
        if self.held > self.remembered:
            self._keep(set(segments))
        return ids, per_text

    @staticmethod
    def _cut(text: str) -> str | None:
        """The text with a space before each line break that ends a segment; None if its spaces alone don't tell segments apart."""
        if not _TWO_SPACES.search(text):
            return text.replace("\n", " \n")
        return None if _BESIDE_SPACE.search(text) else _BEFORE_BREAK.sub(" ", text)

    def _keep(self, latest: set) -> None:
        keys = list(latest)
        at = np.array([self.place[k] for k in keys], np.int64)
        counts = self.counts[at]
        ends = np.cumsum(counts)
        flat = self.flat[np.arange(int(counts.sum())) + np.repeat(self.starts[at] - (ends - counts), counts)]
        self._forget()
        self._add(keys, flat, counts)

    def _add(self, keys: list, flat: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.place)
        while first + len(keys) > len(self.starts):
            self.starts, self.counts = np.concatenate([self.starts, self.starts]), np.concatenate([self.counts, self.counts])
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, self.flat])
        self.starts[first : first + len(keys)] = self.used + np.cumsum(counts) - counts
        self.counts[first : first + len(keys)] = counts
        self.flat[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.held += 4 * len(flat) + _EACH * len(keys) + sum(map(sys.getsizeof, keys)) + sum(sys.getsizeof(k[0]) for k in keys if k.__class__ is tuple)
        self.place.update(zip(keys, range(first, first + len(keys))))

    def _learn(self, keys: list[str | tuple[str]]) -> np.ndarray:
        """Encode segments, and give their places: cut them into pre-tokens, and give each distinct pre-token to the model.

        Most are a word, or a word and marks: those are told apart by Arrow, all at once. A segment in a tuple is meant as it is,
        others that don't begin with a line break have a space before them.
        """
        array = pa.array([None if k.__class__ is tuple else k for k in keys], pa.large_string())
        split = pc.extract_regex(array, _WORD_AND_MARKS)
        kind = pc.fill_null(pc.match_substring_regex(array, _WORD), False).to_numpy(zero_copy_only=False).astype(np.int64)
        kind += 2 * split.is_valid().to_numpy(zero_copy_only=False)
        of_kind = [np.flatnonzero(kind == n) for n in range(3)]
        odd, words = [[keys[i] for i in of_kind[n].tolist()] for n in (0, 1)]
        split = split.take(pa.array(of_kind[2]))
        bases, marks = split.field("word").to_pylist(), split.field("marks").to_pylist()
        # Pre-tokens for the model, and of each segment their numbers: in ``rows``, in ``alone``, or -1 less the place of a segment.
        rows = dict(zip(words, range(len(words))))
        alone: dict[str, int] = {}

        def number(token: str) -> int:
            if token[0] == " " and token.find(" ", 1) < 0 and "\n" not in token:
                return rows.setdefault(token[1:], len(rows))
            return alone.setdefault(token, _ALONE + len(alone))

        parts = [np.arange(len(words))]
        sizes = [np.ones(len(words), np.int64)]
        held = map(self.place.get, bases, repeat(-1))
        pairs = np.zeros((len(bases), 2), np.int64)
        pairs[:, 0] = [-1 - p if p >= 0 else rows.setdefault(w, len(rows)) for p, w in zip(held, bases)]
        pairs[:, 1] = [alone.setdefault(m, _ALONE + len(alone)) for m in marks]
        parts.append(pairs.reshape(-1))
        sizes.append(np.full(len(bases), 2, np.int64))
        cut = [_PRE_TOKENS.findall(k[0] if k.__class__ is tuple else k if k[:1] == "\n" else " " + k) for k in odd]
        parts.append(np.array([number(w) for own in cut for w in own], np.int64))
        sizes.append(np.array([len(own) for own in cut], np.int64))
        flat, counts = self._model(list(rows), list(alone))
        part = np.concatenate(parts)
        part[part >= _ALONE] += len(rows) - _ALONE
        size = np.concatenate(sizes)
        old = part < 0
        begin, of_part = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        begin[~old] = (self.used + np.cumsum(counts) - counts)[part[~old]]
        of_part[~old] = counts[part[~old]]
        begin[old], of_part[old] = self.starts[-1 - part[old]], self.counts[-1 - part[old]]
        flat = np.concatenate([self.flat[: self.used], flat])
        ends = np.cumsum(of_part)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.arange(total) + np.repeat(begin - (ends - of_part), of_part)]
        reached = np.concatenate([[0], ends])
        last = np.cumsum(size)
        order = np.concatenate([of_kind[1], of_kind[2], of_kind[0]])
        places = np.zeros(len(keys), np.int64)
        places[order] = len(self.place) + np.arange(len(keys))
        self._add([keys[i] for i in order.tolist()], ids, reached[last] - reached[last - size])
        return places

    def _model(self, rows: list[str], alone: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, and how many each has.

        Those of ``rows`` have a space before them, or begin with a line break, and have no other: where they stand in a row, an id whose
        string begins with the letter of a space, or is that of a line break, begins the next one.
        """
        encode = self.words.encode_batch_fast
        flat = [np.zeros(0, np.int32)]
        for first in range(0, len(rows), _SPELT):
            data = np.frombuffer((" " + " ".join(rows[first : first + _SPELT])).replace(" \n", "\n").encode(), np.uint8)
            size = self.spelt_size[data]
            spelt = self.spelt[data][np.arange(4, dtype=np.uint8) < size[:, None]].tobytes()
            ends = np.cumsum(np.add.reduceat(size, np.flatnonzero((data == 32) | (data == 10))[::_JOINED], dtype=np.int64)).tolist()
            joined = [spelt[a:b].decode() for a, b in zip([0, *ends], ends)]
            flat += [np.array(e.ids, np.int32) for e in encode(joined, add_special_tokens=False)]
        ids = np.concatenate(flat)
        begins = np.flatnonzero(self.opens[ids])
        if len(begins) != len(rows):
            raise ValueError("the tokenizer doesn't keep words apart")
        counts = np.diff(np.append(begins, len(ids)))
        more = [e.ids for e in encode([w.encode().decode("latin-1").translate(self.letters) for w in alone], add_special_tokens=False)]
        return (
            np.concatenate([ids, np.array([i for own in more for i in own], np.int32)]),
            np.concatenate([counts, np.array([len(own) for own in more], np.int64)]),
        )


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED_BYTES) -> Encoder:
    """The encoder of this worker process for a tokenizer file; what it has learned serves later tasks too."""
    if (path, remembered) not in _encoders:
        _encoders.clear()
        _encoders[path, remembered] = Encoder(path, remembered)
    return _encoders[path, remembered]


def public_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)
