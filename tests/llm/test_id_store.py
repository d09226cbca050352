import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tabwright.llm import id_store as S

PATH = public_tokenizers.path("byte_bpe_50k.json")


def in_order(row):
    """Null ids first; then by id, the text's 64-bit hash (a null text's is its seed) and text."""
    doc_id, text = row
    digest = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return (doc_id is not None, doc_id or 0, digest - (digest >> 63 << 64), text or "")


def expected_rows(rows):
    library = Tokenizer.from_file(PATH)
    order = sorted(rows, key=in_order)
    out, start = [], 0
    for doc_id, text in order:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def rows():
    made = [(i * 7 % 101 - 20, f"text number {i} " * (i % 9)) for i in range(101)]
    return made + [(5, "again"), (5, "again"), (5, None), (None, "no key"), (None, ""),
                   (1 << 62, "<|endoftext|> end"),
                   *[(50, f"hot {i}") for i in range(60)], (999, "long words " * 3000)]


@pytest.mark.parametrize("size", [0, 1, 2, 3, 17, 1000, 5000])
def test_hash_is_perfect(size):
    hashes = S.mix(np.arange(size, dtype=np.uint64))
    if size:
        spots = S.slots(hashes, S.perfect_seeds(hashes), size)
        assert sorted(spots.tolist()) == list(range(size))


@pytest.mark.parametrize("block", [1 << 18, 50])
def test_round_trip(spark, make_docs, tmp_path, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK_TOKENS", block)
    path = str(tmp_path / "store")
    S.write_store(make_docs(rows()), path, PATH, parts=3)
    found = sorted(map(tuple, S.read_store(spark, path).collect()), key=lambda r: r[1])
    assert found == expected_rows(rows())


def test_look_up(spark, make_docs, tmp_path):
    path = str(tmp_path / "store")
    S.write_store(make_docs(rows()), path, PATH, parts=3)
    asked = [5, 0, -20, 999, 1 << 62, 123456, -500]
    found = sorted(map(tuple, S.look_up(spark, path, asked).collect()), key=lambda r: r[1])
    assert found == [r for r in expected_rows(rows()) if r[0] in asked]
    assert S.look_up(spark, path, []).collect() == []


def test_empty_table(spark, make_docs, tmp_path):
    path = str(tmp_path / "store")
    S.write_store(make_docs([]), path, PATH)
    assert S.read_store(spark, path).collect() == []
    assert S.look_up(spark, path, [1]).collect() == []
