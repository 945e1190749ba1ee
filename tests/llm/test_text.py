from __future__ import annotations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.brute import words as plain_words
from tokenizers import Tokenizer

from tallymart.llm.text import Words, blocks, minima, slide
from tallymart.llm.tokens import Encoder, tokenizer_path

texts = st.lists(st.none() | st.text(alphabet="ab \n\t éß日.,'1"), max_size=6)


@settings(deadline=None, max_examples=60)
@given(texts)
def test_words_are_those_of_the_pattern(some):
    words = Words(pa.array(some, pa.string()))
    found = [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends)]
    assert found == [w for t in some for w in plain_words(t)]
    assert np.diff(words.word_bounds).tolist() == [len(plain_words(t)) for t in some]
    assert len(set(zip(found, words.hashes.tolist()))) == len(set(found))


def test_words_of_a_sliced_array():
    whole = pa.array(["a b", "c", None, "d e f"])
    assert np.diff(Words(whole.slice(1, 3)).word_bounds).tolist() == [1, 0, 3]


def test_grams_hash_alike_only_if_equal():
    words = Words(pa.array(["x y z x y z", "y z x"]))
    grams, inside = words.grams(3)
    names = [("x", "y", "z"), ("y", "z", "x"), ("z", "x", "y"), ("x", "y", "z")]
    assert inside.tolist() == [True] * 4 + [False, False, True]
    assert grams[0] == grams[3] and grams[1] == grams[6] and len(set(grams[:3].tolist())) == len(set(names))


@given(st.lists(st.integers(0, 6), min_size=1, max_size=40), st.integers(1, 9))
def test_minima_hold_one_of_every_window(values, width):
    h = np.array(values, np.uint64) + np.uint64(1)
    chosen = set(minima(h, np.ones(len(h), bool), width).tolist())
    expected = set()
    for a in range(len(h) - width + 1):
        least = h[a : a + width].min()
        expected |= {a + i for i in range(width) if h[a + i] == least}
    assert chosen == expected
    assert slide(np.minimum, h, width).tolist() == [h[a : a + width].min() for a in range(len(h) - width + 1)]


def test_blocks_keep_every_row_once():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 0, 90, 3, 3)] + [None])], ["text"])
    assert [r for b in blocks(batch, "text", 8) for r in b.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert max(b.num_rows for b in blocks(batch, "text", 8)) < 4


@pytest.fixture(scope="module")
def pair():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return Encoder(tokenizer_path()), plain


_ODD = st.lists(st.sampled_from([*"abÀß日 \n\t\r 　\x1c\x85.,'’sdt|<>1²_-", "<|endoftext|>"]), max_size=60).map("".join)


@settings(deadline=None, max_examples=150)
@given(_ODD | st.text(max_size=30))
def test_units_give_the_ids_of_the_whole_text(pair, text):
    own, plain = pair
    got = np.frombuffer(own.encode([text])[0], "<u4").tolist()
    assert got == plain.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=100)
@given(st.lists(st.none() | _ODD, max_size=8))
def test_a_block_gives_the_ids_of_each_of_its_texts(pair, some):
    own, plain = pair
    ids, counts = own.encode_block(pa.array([*some, "cut off"], pa.string())[:-1], 0)
    wanted = [[*plain.encode(text or "", add_special_tokens=False).ids, 0] for text in some]
    assert counts.tolist() == list(map(len, wanted))
    assert ids.tolist() == sum(wanted, [])


def test_a_word_is_encoded_once_whatever_marks_follow(monkeypatch):
    own, asked = Encoder(tokenizer_path()), []
    for units in (own.spaced, own.bare):
        monkeypatch.setattr(units, "tokens", lambda word, do=units.tokens: asked.append(word) or do(word))
        monkeypatch.setattr(units, "_encode", lambda text, do=units._encode: asked.append(text) or do(text))
    own.encode([" wordy wordy, wordy.### wordy!!\nwordy wordy###", " wordy### wordy.\nwordy"] * 2)
    assert sorted(text for text in asked if "wordy" in text) == ["wordy", "\u0120wordy"]
    assert sorted(asked) == sorted(set(asked))


def test_units_in_use_are_not_forgotten(monkeypatch):
    monkeypatch.setattr("tallymart.llm.tokens.REMEMBERED", 4)
    own, asked = Encoder(tokenizer_path()), []
    monkeypatch.setattr(own.spaced, "tokens", lambda word, do=own.spaced.tokens: asked.append(word) or do(word))
    for fresh in ("one", "two", "three", "four", "five", "six"):
        own.encode([f" so on {fresh}"])
    assert sorted(asked) == sorted("\u0120" + word for word in "so on one two three four five six".split())


def test_units_are_forgotten_without_harm(pair, monkeypatch):
    own, plain = pair
    monkeypatch.setattr("tallymart.llm.tokens.REMEMBERED", 2)
    for text in ("a few words here", "a few others there", None, ""):
        got = np.frombuffer(own.encode([text])[0], "<u4").tolist()
        assert got == plain.encode(text or "", add_special_tokens=False).ids
