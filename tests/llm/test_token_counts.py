import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabwright.llm.encode import PLAIN_RANGES
from tabwright.llm.token_counts import CountTransducer, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = [" ", " ", "\n", "a", "b", "é", "é", "'s", "'S", "'re", "'", "1", "²", ".", ",",
         "<|endoftext|>", "<|startoftext|>", "\t", "\r\n", "中", "あ", "\xa0", " ", "\x1c",
         "\x85", "😀", "ß", "Σ", "İ", "-", "the", "World", "​", "Ж", "한", "K"]


@pytest.fixture(scope="module")
def transducer():
    return CountTransducer(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("chunk", [1, 3, 1 << 16])
def test_counts_as_the_library(transducer, library, chunk):
    rng = random.Random(chunk)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(16)))
        total, prefixes = transducer.count(text, chunk)
        assert total == len(library.encode(text, add_special_tokens=False).ids), repr(text)
        assert len(prefixes) in (0, max(0, -(-len(text) // chunk) - 1))


def test_words_of_all_plain_characters(transducer):
    plain = [chr(c) for low, high in PLAIN_RANGES[:5] for c in range(low, high + 1) if c != 0x20]
    rng = random.Random(6)
    words = [w for c in plain for w in (c, c + "a", "b" + c, c + "Ə", c + c, c + "7")]
    words += ["".join(rng.choices(plain, k=rng.randrange(2, 10))) for _ in range(10_000)]
    for word in words:
        assert transducer.annotate(word) == transducer.whole(word), word


def test_composition_is_associative(transducer):
    maps = [transducer.chunk_map(c) for c in ("", "ab", " ", "ab c", " d e ", "f'", "s g")]
    compose = transducer.compose
    for a in maps:
        for b in maps:
            for c in maps:
                assert compose(compose(a, b), c) == compose(a, compose(b, c))


def test_scan_gives_all_prefixes(transducer):
    text = "one two  three fourfive six" * 3
    maps = [transducer.chunk_map(text[i:i + 4]) for i in range(0, len(text), 4)]
    for i, done in enumerate(transducer.scan(maps)):
        assert transducer.emitted(done) == transducer.whole(text[:4 * i + 4])


def test_rows(make_docs, library):
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (None, "ok"),
            (4, "many words " * 4000)]
    found = token_counts(make_docs(rows), PATH, limit=2, chunk_chars=1000).collect()
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found] == [
        (i, len((t or "").encode()), n := len(library.encode(t or "").ids), n > 2)
        for i, t in rows]
    assert len(found[-1].chunk_tokens) == 43
    assert token_counts(make_docs([]), PATH).collect() == []
