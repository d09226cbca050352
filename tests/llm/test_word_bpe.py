"""Word-level BPE against the tokenizers library: words, whole texts, borders, decoding, odd rows."""

import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tabwright.llm.word_bpe import compiled, list_of, round_trip

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def random_words(rng, count):
    names = [n.replace("</w>", "") for n in compiled(PATH).vocab]
    odd = "aAbst'.,!?-ÔɄāƆНƏćƦßıİΣςé́ 　\x1c\x85中字😀🇩"
    for _ in range(count):
        kind = rng.randrange(5)
        if kind == 0:
            yield "".join(rng.choices("aeinorst", k=rng.randint(1, 16)))
        elif kind == 1:
            yield "".join(rng.choices(names, k=rng.randint(1, 4)))
        elif kind == 2:
            yield "".join(rng.choices(odd, k=rng.randint(1, 10)))
        elif kind == 3:
            yield rng.choice("ab ") * rng.randint(1, 30)
        else:
            yield rng.choice(("<|endoftext|>", "x<|startoftext|>", "<|EndOfText|>")) \
                + rng.choice(names)


def test_words_have_the_ids_of_the_library(library):
    words = list(random_words(random.Random(5), 8000))
    for word, ids in zip(words, compiled(PATH).encode(words)):
        assert np.frombuffer(ids, "<i4").tolist() == ids_of(library, word), word


def test_a_border_is_crossed_exactly_where_merging_both_tokens_gives_something_else():
    bpe, rng = compiled(PATH), np.random.default_rng(3)
    inner = np.array([i for n, i in bpe.vocab.items() if not n.endswith("</w>")])
    a = rng.choice(inner, 6000)
    b = rng.integers(0, len(bpe.vocab), 6000)
    names = bpe.names.to_pylist()
    # Tokens that begin inside a character cannot follow every other; the merges do not mind.
    for x, y, crossed in zip(a.tolist(), b.tolist(), bpe.crossed(a, b).tolist()):
        whole = names[x] + names[y]
        if whole.endswith("</w>"):
            assert (bpe.merge(whole[:-4]) != [x, y]) == crossed, (names[x], names[y])


def test_some_words_are_taken_as_proposed_and_some_are_merged():
    bpe, merged = compiled(PATH), []
    exact, bpe.merge = bpe.merge, lambda piece: merged.append(piece) or exact(piece)
    try:
        pieces = {p for w in random_words(random.Random(8), 3000) for p in bpe.pieces_of(w)
                  if isinstance(p, str)}
        bpe.encode_pieces(pieces)
    finally:
        del bpe.merge
    assert 0 < len(merged) < len(pieces) / 2


def test_documents_round_trip(spark, sf, library):
    texts = dict(zip(*(pq.read_table(f"{sf}/documents.parquet").column(c).to_pylist()
                       for c in ("doc_id", "text"))))
    rows = round_trip(spark.read.parquet(f"{sf}/documents.parquet"), PATH).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.ids == ids_of(library, texts[row.doc_id])
        assert row.decoded == library.decode(row.ids, skip_special_tokens=False)


def test_odd_rows(spark, make_docs, library):
    long = "Überlänge of words " * 20000 + "x" * 30000
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, long), (5, "same"), (5, "same"), (None, "no id"),
             (6, "a<|endoftext|>b <|startoftext|>"), (7, " ﻿\x00")]
    rows = round_trip(make_docs(texts), PATH)
    assert rows.columns == ["doc_id", "ids", "decoded"]
    got = sorted(((r.doc_id is None, r.doc_id, r.ids, r.decoded) for r in rows.collect()), key=str)
    want = sorted(((i is None, i, ids_of(library, t),
                    library.decode(ids_of(library, t), skip_special_tokens=False))
                   for i, t in texts), key=str)
    assert got == want
    assert round_trip(make_docs([(1, "x")]).limit(0), PATH).count() == 0


def test_lists_with_nulls_and_slices_decode():
    bpe = compiled(PATH)
    lists = list_of(bpe.encode(["one two", "three", "", "four"]))
    assert bpe.decode(lists.slice(1)).to_pylist() == ["three</w>", "", "four</w>"]
    import pyarrow as pa
    assert bpe.decode(pa.array([None, [518]], pa.list_(pa.int32()))).to_pylist() == \
        [None, "the</w>"]
