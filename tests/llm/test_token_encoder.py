"""The encoder of op1: what it looks up, and that its ids are the library's."""

import random

import pytest

pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from callstrata.llm import token_files  # noqa: E402


@pytest.fixture(scope="module")
def encoder():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as source:
        return token_files.CachedEncoder(source.read(), "<u2")


def test_texts_of_known_pieces_are_looked_up_at_once(encoder, monkeypatch):
    """Line ends and the look for uneven white space cost no step per place."""
    text = "One two,\nthree four\nOne. Éa\nx " * 50 + "end"
    expected = encoder.encode(text)
    assert expected == encoder._library(text)
    asked, piece = [], encoder._piece
    monkeypatch.setattr(encoder, "_piece", lambda *found: asked.append(found[0]) or piece(*found))
    monkeypatch.setattr(token_files, "_UNEVEN", None)
    assert encoder.encode(text) == expected
    assert len(asked) == 1  # the first piece, which follows nothing


def test_texts_of_any_characters_equal_the_library(encoder):
    draw = random.Random(7)
    parts = ["a", "B", "the", "é", "ß", "œ", "ɏ", "漢", "'s", "12", "!", "—", "\t", "\xa0", "\xad",
             "×", "\x00", "\x7f", "😀", "\r", "<|endoftext|>", "x" * 70, *" " * 5, *"\n" * 2]
    for _ in range(4000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(14)))
        assert encoder.encode(text) == (encoder._library(text) if text else b""), repr(text)
        if text and not token_files._NOT_VISIBLE.search(text):
            assert (token_files._uneven(text, True)
                    == bool(token_files._UNEVEN.search(text))), repr(text)


def test_caches_that_fill_up_change_nothing(encoder, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", 3)
    text = "ab cd\nef gh, ij-kl ab\ncd mn"
    assert encoder.encode(text) == encoder._library(text)
    assert len(encoder.pieces) <= 3 and len(encoder.words) <= 3
