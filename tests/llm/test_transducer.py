"""The compiled transducer against the library: random texts, cuts anywhere, long runs, forgotten states."""

from __future__ import annotations

import random
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import token_counts, wordbpe


@pytest.fixture(scope="module")
def bpe():
    return wordbpe.word_bpe(wordbpe.default_path())


@pytest.fixture(scope="module")
def machine(bpe):
    return token_counts.Transducer(bpe)


def wanted(bpe, texts):
    return [len(e.ids) for e in bpe.library.encode_batch_fast(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text(alphabet="abcdeést'SrvlmÄ 1.,-<|>endoftx\n", max_size=90), max_size=5))
def test_random_texts(texts):
    bpe = wordbpe.word_bpe(wordbpe.default_path())
    assert token_counts._machine(wordbpe.default_path()).count(texts).tolist() == wanted(bpe, texts)


@pytest.mark.parametrize("piece", [8, 61, 1000])
def test_pieces_cut_anywhere(machine, bpe, piece):
    rng = random.Random(piece)
    texts = ["".join(rng.choice(letters) for _ in range(9000)) + tail for letters in ("ab", "etaoinshr", "aé'1.,", "a") for tail in ("", " and more")]
    assert machine.count(texts, lane=32, piece=piece).tolist() == wanted(bpe, texts)


def test_few_states_are_forgotten_and_met_again(bpe):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdefgh'1") for _ in range(rng.randint(1, 12))) for _ in range(400)) for _ in range(6)] + ["xyz" * 3000]
    machine = token_counts.Transducer(bpe, most_states=600)
    assert machine.count(texts, piece=500).tolist() == wanted(bpe, texts)
    assert len(machine.keys) < 3000


def test_one_long_word_in_bounded_memory(bpe):
    text = "abcdefghij" * 2_000_000
    machine = token_counts.Transducer(bpe)
    machine.count(["warm"])
    tracemalloc.start()
    n = machine.count([text])[0]
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    part = len(bpe.library.encode(text[:200_000], add_special_tokens=False).ids)
    assert abs(n - 100 * part) <= 100 and peak < 16 * len(text)


def test_japanese_without_spaces(machine, bpe):
    text = "日本語の文章です。" * 20_000
    assert machine.count([text, text + " a"]).tolist() == wanted(bpe, [text, text + " a"])
