import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tabwright.llm.packing import pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def in_order(row):
    """Null ids first; then by id, the text's 64-bit hash (a null text's is its seed) and text."""
    doc_id, text = row
    digest = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return (doc_id is not None, doc_id or 0, digest - (digest >> 63 << 64), text or "")


@pytest.mark.parametrize("window", [1, 7, 1024])
def test_matches_brute_force(make_docs, window):
    rows = [(i * 7 % 41 - 5, f"text {i} " * (i % 6)) for i in range(41)]
    rows += [(3, "again"), (3, "again"), (None, "no key"), (77, None), (78, ""),
             (79, "many words " * 700)]
    library = Tokenizer.from_file(PATH)
    order = sorted(rows, key=in_order)
    expected, at = [], 0
    for doc_id, text in order:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        start = 0
        while start < len(ids):
            n = min(len(ids) - start, window - at % window)
            expected.append((doc_id, start, n, np.array(ids[start:start + n], "<u4").tobytes(),
                             len(ids), at // window, at % window, start == 0,
                             start + n == len(ids)))
            start, at = start + n, at + n
    found = pack(make_docs(rows), PATH, window=window, parts=3).collect()
    assert sorted(map(tuple, found), key=lambda r: (r[5], r[6])) == expected


def test_empty_table(make_docs):
    assert pack(make_docs([]), PATH).collect() == []
