import random

import numpy as np
import public_tokenizers
import pytest

from tabwright.llm import encode as E

PARTS = [" ", " ", "\n", "a", "b", "é", "Ñ", "'s", "'re", "'", "1", "²", "½", ".", ",",
         "<|endoftext|>", "\t", "\r\n", "中", "文", "あ", "\xa0", "\u2003", "\x1c", "\x85", "😀", "ß",
         "Σ", "İ", "e\u0301", "-", "–", "«", "the", "World", "\u200b", "ʼ", "_", "\x00", "ª", "Ж", "한",
         "\x7f", "\xad"]


@pytest.mark.parametrize("kept", [600_000, 3])
def test_ids_as_the_library(monkeypatch, kept):
    monkeypatch.setattr(E, "MEMORY_PIECES", kept)
    encoder, rng = E.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(kept)
    assert encoder.by_piece and encoder.encode(None) == b""
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(5000)]
    texts += ["", " ", "\n\n", "a ", "a\n", "x" * 5000, " " * 3000 + "end"]
    for text in texts:
        found = np.frombuffer(encoder.encode(text), encoder.dtype).tolist()
        assert found == encoder.library.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_files_are_encoded_whole():
    encoder = E.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not encoder.by_piece
    ids = np.frombuffer(encoder.encode("Hello  there"), encoder.dtype).tolist()
    assert ids == encoder.library.encode("Hello  there", add_special_tokens=False).ids
