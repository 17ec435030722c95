"""Words that go to the tokenizers library's model past its normalizer and pre-tokenizer."""

from __future__ import annotations

import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
pytest.importorskip("tokenizers")

from eddyline.llm.tokenfile import Encoder  # noqa: E402


@pytest.fixture(scope="module")
def coder():
    return Encoder(public_tokenizers.path("word_bpe_49k.json"))


def _expected(coder, text):
    return np.array(coder.library.encode(text, add_special_tokens=False).ids, coder.kind).tobytes()


def test_mixed_characters_are_encoded_as_by_the_library(coder):
    pick = random.Random(3)
    letters = "aAeEéÉßÿÞñÇ×÷ªºµ12 .'’-!<|>́ÅİIſK_`*%\n\t\xa0\x1c\x85 "
    texts = ["".join(pick.choices(letters, k=pick.randrange(1, 12))) for _ in range(5_000)]
    texts += ["don't É's. abc's' l'été, a<|endoftext|>b <|endoftext|> É<|x Ångström ÀÖØÞ ÿ!"]
    for text in texts:
        assert coder.encode(text) == _expected(coder, text), repr(text)


def test_accented_words_and_their_punctuation_skip_the_pre_tokenizer(coder, monkeypatch):
    """Each of them cost a call of the whole library: half of the time of encoding."""
    words = ["Élèveñor", "çaéßÿ", "Ñandúes", "ÀÖØÞabc"]
    text = " ".join(f"{word}{rest}" for word in words for rest in ("", ".", "***"))
    expected, asked = _expected(coder, text), []
    library = coder._library
    monkeypatch.setattr(coder, "_library", lambda word: asked.append(word) or library(word))
    assert coder.encode(text) == expected
    assert set(asked) <= {".", "***"}
