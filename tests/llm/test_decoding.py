"""Operator 9 joins pieces itself; only bytes beyond ASCII need the library's decoder."""

import random

import pytest

from cohortlab.llm import op09_sentencepiece as op09


@pytest.fixture(scope="module")
def codec():
    with open(op09.MODEL_PATH, "rb") as f:
        return op09.Codec(f.read())


def test_decode_equals_the_librarys(codec):
    draw, n = random.Random(3), len(codec.model["pieces"])
    low = next(i for i, p in enumerate(codec.model["pieces"]) if p[2] == op09.BYTE)
    lists = [[draw.randrange(n) if draw.random() < 0.6 else low + draw.randrange(draw.choice([128, 256]))
              for _ in range(draw.randint(0, 12))] for _ in range(5000)]
    assert codec.decode(lists) == codec.tok.decode_batch(lists, skip_special_tokens=False)


def test_ascii_text_is_decoded_without_the_library(codec, monkeypatch):
    texts = ["two words\nand a line", "", " spaces  at both ends "]
    ids = [e.ids for e in codec.tok.encode_batch(texts, add_special_tokens=False)]

    class Unused:
        def decode_batch(self, *_, **__):
            raise AssertionError("decoded by the library")

    monkeypatch.setattr(codec, "tok", Unused())
    assert codec.decode(ids) == texts
