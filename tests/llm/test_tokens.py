import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabprep.llm.tokens import Encoder, public_path

PLAIN = Tokenizer.from_file(public_path())
END = PLAIN.token_to_id("<|endoftext|>")
CACHED = Encoder(public_path(), remembered=50)


def check(texts, cached=CACHED, plain=PLAIN):
    expected = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    ids, counts = cached.encode(texts)
    assert counts.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]


ALPHABET = st.sampled_from(list("ab  \n\t.,'s<|>0é  ñ漢😀\x1c\x85_") + ["<|endoftext|>", "don't", "   "])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), max_size=4))
def test_ids_equal_the_librarys(texts):
    check(texts)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    check([text, "", text + " " + text])


def test_corpus(corpus):
    texts = [r.text for r in corpus.collect()]
    check(texts)
    check(texts[::-1])
    check([" ".join(texts)])


def test_other_kinds_of_tokenizers():
    path = public_path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    other = Encoder(path)
    assert not other.by_word
    check(["Hello there, world", "", "çé"], other, plain)


def test_added_tokens():
    texts = ["<|endoftext|>", "<|endoftext|> start", "the <|endoftext|> middle", "end <|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "no token", ""]
    check(texts)
    assert CACHED.encode(["hello <|endoftext|> world"])[0].tolist() == [31373, 220, END, 995]


def test_a_line_break_ends_a_segment():
    """Words are learned once, not once for each pair that a line break joins."""
    cached = Encoder(public_path())
    words = [f"w{'abcdefghij'[n]}rd" for n in range(10)]
    check([" ".join(f"{a}.\n{b},!!" for a in words for b in words)], cached)
    assert len(cached.place) <= 21
    check(["a\nb", "\na", "a\n", "a \nb", "a\n b", "a\n\nb", "a.\r\nb", "a\n\n\nb c", "\n", " \n", "\n\n", "\u2003\na \nb", "\nb!'s", "b'", "b.'s"], cached)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text("ab \n\r.'!\xa0", max_size=20), max_size=4))
def test_line_breaks_and_marks(texts):
    check(texts)


def test_long_segments_are_not_held():
    cached = Encoder(public_path(), remembered=1 << 20)
    for i in range(40):
        dice = np.random.default_rng(i)
        text = "".join(map(chr, dice.integers(0x4E00, 0x9000, 100_000).tolist()))
        cached.encode([text])
        assert cached.held <= 1 << 20 or len(cached.place) <= 2


def test_memory_is_bounded():
    cached = Encoder(public_path(), remembered=100)
    for i in range(50):
        cached.encode([" ".join(f"w{i}x{j}" for j in range(90))])
    assert len(cached.place) <= 290
    assert isinstance(cached.flat, np.ndarray)
