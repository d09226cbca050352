"""Encoding and decoding with a word-level BPE file: speculate, verify, merge only where that fails.

A word is cut greedily into the longest tokens of the vocabulary. Such a proposal is what the merges
give exactly if every two adjacent tokens are *compatible*, that is if no merge crosses their border
while the merges inside them are under way. Compatibility depends on the two tokens alone, and all
pairs of a batch are checked together in numpy. Words with an incompatible pair are merged exactly.

Why pairs suffice: merges are learned in order, so a symbol exists from the rank of the merge that
made it to the rank of the merge that takes it up. At the border of tokens ``a | b`` stand the nodes
of the right spine of ``a`` and of the left spine of ``b``, each for its span of ranks. A pair of such
nodes that stand there together and have a merge of lower rank than the ends of both spans is merged
over the border; if there is none, the border stays. At equal ranks the leftmost pair goes first.
Tokens that the merges of their own characters do not give back are never proposed; the same check
with their own rank as the end finds them.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import slices, with_field
from tabwright.llm.encode import BYTE_CHARS, LETTERS, NUMBERS, Memory, keep_only
from tabwright.llm.encode import WHITE as SPACE

#: White space on which every library agrees; a word between it may still hold rarer kinds.
WHITE = re.compile("[ \t-\r]+")
#: White space at which ``str.split`` cuts as well, and some library does not.
RARE_WHITE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Words of visible characters up to Latin Extended-B; others are cut by the library's own
#: normaliser and pre-tokeniser.
LATIN = re.compile("[!-~\xa1-\xac\xae-\u024f]*")
#: Fixed value: the pre-tokeniser's pattern, over the plain classes.
PIECE = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^{SPACE}{LETTERS}{NUMBERS}]+")
#: Pairs that are checked together; characters by which the longest possible token is looked up; and
#: symbols up to which a plain list finds the next merge faster than a heap.
PAIRS_AT_ONCE, OPENING, SHORT = 4096, 3, 40
NEVER = np.iinfo(np.int64).max


class WordBpe:
    """A compiled tokenizer file with ``end_of_word_suffix`` and byte characters."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        library = Tokenizer.from_file(path)
        self.normalise, self.cut = library.normalizer.normalize_str, \
            library.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_ids = added
        self.specials = re.compile(
            "(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")" if added
            else "(?!)")
        self.size = max([*self.vocab.values(), *added.values()]) + 1
        names = [""] * self.size
        for name, i in (*self.vocab.items(), *added.items()):
            names[i] = name
        self.names = pa.array(names)
        self.compile_merges([tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
                             for m in model["merges"]])
        #: Ids of words already encoded, as little-endian bytes.
        self.words = Memory(lambda word: self.encode_words([word])[word])

    def compile_merges(self, merges: list[tuple[str, str]]) -> None:
        count = len(merges)
        left = np.fromiter((self.vocab[a] for a, _ in merges), np.int64, count)
        right = np.fromiter((self.vocab[b] for _, b in merges), np.int64, count)
        made = np.fromiter((self.vocab[a + b] for a, b in merges), np.int64, count)
        keys = left * self.size + right
        self.merged = dict(zip(keys.tolist(), zip(range(count), made.tolist())))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        rank_of = np.full(self.size, NEVER)
        rank_of[made[::-1]] = np.arange(count)[::-1]
        self.left_spine, self.left_end = self.spine(left, made, rank_of)
        self.right_spine, self.right_end = self.spine(right, made, rank_of)
        own = ~self.crossed(left, right, np.arange(count))
        reachable = np.ones(self.size, bool)
        for a, b, m, fits in zip(left.tolist(), right.tolist(), made.tolist(), own.tolist()):
            reachable[m] = fits and reachable[a] and reachable[b]
        self.proposed = {name: i for name, i in self.vocab.items() if reachable[i]}
        #: Characters of the longest token that begins so, less the mark of a word's end.
        self.reach: dict[str, int] = {}
        for name in self.proposed:
            name = name.removesuffix(self.end)
            for start in {name[:k] for k in range(1, OPENING + 1)}:
                self.reach[start] = max(self.reach.get(start, 0), len(name))

    def spine(self, child: np.ndarray, made: np.ndarray, rank_of: np.ndarray):
        """For every token its outermost nodes, itself first (-1 where there are no more), and the
        rank at which each is taken up by the one before."""
        step = np.full(self.size, -1)
        step[made[::-1]] = child[::-1]
        nodes, ends = [np.arange(self.size)], [np.full(self.size, NEVER)]
        while True:
            last = nodes[-1]
            below = np.where(last >= 0, step[last], -1)
            if (below < 0).all():
                return np.stack(nodes, 1), np.stack(ends, 1)
            nodes.append(below)
            ends.append(np.where(below >= 0, rank_of[last], -1))

    def crossed(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int = NEVER) -> np.ndarray:
        """Whether a merge of a rank below ``limit`` crosses the border of each pair of tokens."""
        out = np.zeros(len(a), bool)
        limit = np.broadcast_to(limit, a.shape)
        for start in range(0, len(a), PAIRS_AT_ONCE):
            part = slice(start, start + PAIRS_AT_ONCE)
            x, y = self.right_spine[a[part]], self.left_spine[b[part]]
            row, i, j = np.nonzero((x >= 0)[:, :, None] & (y >= 0)[:, None, :])
            key = x[row, i] * self.size + y[row, j]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            row, i, j, rank = row[hit], i[hit], j[hit], self.ranks[at[hit]]
            end_x = np.minimum(self.right_end[a[part]][row, i], limit[part][row])
            end_y = np.minimum(self.left_end[b[part]][row, j], limit[part][row] - 1)
            out[start + row[(rank < end_x) & (rank <= end_y)]] = True
        return out

    def propose(self, piece: str) -> list[int] | None:
        """Longest tokens from the left; None if some place has none."""
        found, at, size = [], 0, len(piece)
        while at < size:
            reach = self.reach.get(piece[at:at + OPENING], OPENING - 1)
            token = None
            if at + reach >= size:
                token = self.proposed.get(piece[at:] + self.end)
                if token is not None:
                    found.append(token)
                    return found
            for end in range(min(size - 1, at + reach), at, -1):
                token = self.proposed.get(piece[at:end])
                if token is not None:
                    break
            if token is None:
                return None
            found.append(token)
            at = end
        return found

    def merge(self, piece: str) -> list[int]:
        """Exact merging: the pair of the lowest rank first, of these the leftmost."""
        symbols = [*piece[:-1], piece[-1] + self.end]
        ids = [self.vocab[s] for s in symbols if s in self.vocab]
        if len(ids) <= SHORT:
            return self.merge_short(ids)
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] >= 0:
                key = ids[at] * self.size + ids[after[at]]
                if key in self.merged:
                    heapq.heappush(heap, (self.merged[key][0], at, key, self.merged[key][1]))

        for at in range(len(ids)):
            offer(at)
        while heap:
            _, at, key, new = heapq.heappop(heap)
            other = after[at]
            if ids[at] < 0 or other < 0 or ids[at] * self.size + ids[other] != key:
                continue
            ids[at], ids[other] = new, -1
            after[at] = after[other]
            if after[other] >= 0:
                before[after[other]] = at
            offer(before[at])
            offer(at)
        return [i for i in ids if i >= 0]

    def merge_short(self, ids: list[int]) -> list[int]:
        """The same for few symbols: the least of a list of the pairs' ranks."""
        merged, size = self.merged, self.size
        none = (NEVER, -1)
        pairs = [merged.get(a * size + b, none) for a, b in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best[1] < 0:
                break
            at = pairs.index(best)
            ids[at:at + 2] = [best[1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = merged.get(best[1] * size + ids[at + 1], none)
            if at:
                pairs[at - 1] = merged.get(ids[at - 1] * size + best[1], none)
        return ids

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, list[int]]:
        """Ids of pre-tokenised pieces (bytes written as characters)."""
        out: dict[str, list[int]] = {}
        several: list[str] = []
        for piece in pieces:
            found = self.propose(piece)
            if found is None:
                out[piece] = self.merge(piece)
            else:
                out[piece] = found
                if len(found) > 1:
                    several.append(piece)
        if several:
            sizes = np.fromiter((len(out[p]) for p in several), np.int64, len(several))
            flat = np.fromiter((i for p in several for i in out[p]), np.int64, int(sizes.sum()))
            owner = np.repeat(np.arange(len(several)), sizes)
            inner = owner[1:] == owner[:-1]
            kinds, which = np.unique(flat[:-1][inner] * self.size + flat[1:][inner],
                                     return_inverse=True)
            bad = self.crossed(kinds // self.size, kinds % self.size)[which]
            for k in np.unique(owner[1:][inner][bad]).tolist():
                out[several[k]] = self.merge(several[k])
        return out

    def pieces_of(self, word: str) -> list[str | int]:
        """Pieces of a word without plain white space; special strings in it are their ids."""
        if "<" not in word and self.simple(word):
            return self.latin_pieces(word)
        out: list[str | int] = []
        for k, part in enumerate(self.specials.split(word)):
            if k % 2:
                out.append(self.special_ids[part])
            elif self.simple(part):
                out += self.latin_pieces(part)
            else:
                out += [p for p, _ in self.cut(self.normalise(part))]
        return out

    def simple(self, word: str) -> bool:
        """Whether the word and its small form are of Latin characters, none of them decomposed."""
        return word.isascii() and word.isprintable() or (
            LATIN.fullmatch(word) is not None and LATIN.fullmatch(word.lower()) is not None
            and unicodedata.is_normalized("NFC", word))

    def latin_pieces(self, word: str) -> list[str]:
        word = word.lower()
        if word.isalpha() and word.isascii():
            return [word]
        found = PIECE.findall(word)
        if word.isascii():
            return found
        return [p.encode().decode("latin-1").translate(BYTE_CHARS) for p in found]

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of words, all verified together."""
        cut = {word: self.pieces_of(word) for word in words}
        ids = self.encode_pieces({p for parts in cut.values() for p in parts
                                  if not isinstance(p, int)})
        return {word: array("i", [i for p in parts for i in (
            (p,) if isinstance(p, int) else ids[p])]).tobytes() for word, parts in cut.items()}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts; words that no earlier text held are verified in one go."""
        known = self.words.get
        split = [t.split() if not RARE_WHITE.search(t) else [w for w in WHITE.split(t) if w]
                 for t in (t or "" for t in texts)]
        found = [list(map(known, words)) for words in split]
        fresh = self.encode_words({w for words, ids in zip(split, found) if None in ids
                                   for w, i in zip(words, ids) if i is None})
        for word, ids in fresh.items():
            self.words.keep(word, ids)
        return [b"".join(ids) if None not in ids else b"".join(
            [fresh[w] if i is None else i for w, i in zip(words, ids)])
            for words, ids in zip(split, found)]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts of lists of ids: the tokens' names with a blank between, as a file without a decoder
        has it. Null lists give null."""
        counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        named = pa.ListArray.from_arrays(offsets, self.names.take(ids.flatten()))
        return pc.if_else(ids.is_null(), None, pc.binary_join(named, " "))


_COMPILED: dict[str, WordBpe] = {}


def compiled(path: str) -> WordBpe:
    """One compiled file a worker, so that its words last over tasks."""
    if path not in _COMPILED:
        _COMPILED[path] = WordBpe(path)
    return _COMPILED[path]


def list_of(ids: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(ids), "<i4"))


def encode_texts(docs: DataFrame, tokenizer: str, name: str = "ids") -> DataFrame:
    """Adds to every row of ``docs`` (any columns, among them ``text``) the token ids of the whole
    text, as the tokenizers library gives them without special tokens around.

    ``tokenizer`` is a word-level BPE file; special strings inside a text become their ids. A null or
    empty text, or one of white space, has no ids. Every row counts on its own; a column called
    ``name`` is replaced; an empty table gives no rows. A long text costs time in proportion.
    """
    rows = docs.drop(name)

    def run(batches):
        bpe = compiled(tokenizer)
        keep_only(bpe.words)
        for batch in slices(batches):
            ids = list_of(bpe.encode(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids],
                                             names=[*batch.schema.names, name])

    return rows.mapInArrow(run, with_field(rows, name, "array<int>"))


def decode_ids(rows: DataFrame, tokenizer: str, ids: str = "ids",
               name: str = "decoded") -> DataFrame:
    """Adds the text of the column ``ids`` (arrays of token ids) as the library decodes them, special
    tokens kept. No ids give an empty text, a null array gives null; ids must be of the file."""
    rows = rows.drop(name)

    def run(batches):
        bpe = compiled(tokenizer)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, bpe.decode(batch.column(ids))],
                                             names=[*batch.schema.names, name])

    return rows.mapInArrow(run, with_field(rows, name, "string"))


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return decode_ids(encode_texts(texts, tokenizer).drop("text"), tokenizer)
