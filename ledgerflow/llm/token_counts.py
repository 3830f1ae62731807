"""Token counts of whole texts by byte-pair merging with a heap and a linked list.

The symbols of a word form a linked list; a heap holds the adjacent pairs that
the vocabulary can merge, lowest rank first. Popping a pair merges it and
pushes the (at most two) new pairs at its ends. The count is the number of
initial symbols minus the number of merges: no token id is ever emitted.
Counts equal those of the ``tokenizers`` library for the same file.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import kernels as K
from ledgerflow.llm.common import ship, text_and_id
from ledgerflow.llm.tokens import PIECE_ENTRIES as CACHE_ENTRIES
from ledgerflow.llm.tokens import _word_pattern, resolve, text_pieces, to_alphabet

_SHIFT = 20  # a pair of symbols is one number: left << 20 | right
_MASK = (1 << 40) - 1
#: Unicode's White_Space, as it stands inside a character class.
_WHITE = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class MergeCounter(dict):
    """White-space separated chunk -> number of tokens, counted once and kept (bounded)."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pattern = _word_pattern(spec)
        if pattern is None or spec["model"]["type"] != "BPE" or spec["model"].get("byte_fallback"):
            raise ValueError("counting by merges needs a BPE file with word ends that drops white space")
        self.find = regex.compile(pattern.replace(r"\s", _WHITE)).findall
        special = [regex.escape(t["content"]) for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(sorted(special, key=len, reverse=True))) if special else None
        self.blank = regex.compile(f"[{_WHITE}]+")
        vocab = spec["model"]["vocab"]
        self.end = spec["model"].get("end_of_word_suffix") or ""
        self.symbol = vocab
        self.rank: dict[int, int] = {}
        self.merged: dict[int, int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            a, b = vocab[left], vocab[right]
            key = a << _SHIFT | b
            if key not in self.rank:
                self.rank[key] = r
                self.merged[key] = vocab[left + right]
        self.words: dict[str, int] = {}

    def __missing__(self, chunk: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        got = self[chunk] = self.count(chunk.decode())
        return got

    def count(self, text: str) -> int:
        """Tokens of a text (any text: special strings, scripts and white space included)."""
        total = 0
        if self.special is not None and "<" in text:
            found = self.special.findall(text)
            if found:
                return len(found) + sum(self.count(part) for part in self.special.split(text) if part)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            text = "".join([c.lower() for c in text]) if "Σ" in text else text.lower()
        else:
            text = text.lower()
        words = self.words
        for word in self.find(self.blank.sub(" ", text)):
            n = words.get(word)
            if n is None:
                if len(words) >= CACHE_ENTRIES:
                    words.clear()
                n = self.merge(to_alphabet(word))
                if len(word) <= 64:
                    words[word] = n
            total += n
        return total

    def merge(self, word: str) -> int:
        """Initial symbols minus merges of one word."""
        rank, merged, vocab = self.rank, self.merged, self.symbol
        sym = [vocab[c] for c in word[:-1]]
        sym.append(vocab[word[-1] + self.end])
        n = len(sym)
        if n == 1:
            return 1
        heap = []
        for i in range(n - 1):
            r = rank.get(sym[i] << _SHIFT | sym[i + 1])
            if r is not None:
                heap.append(r << 40 | i)
        if not heap:
            return n
        heapify(heap)
        after = list(range(1, n + 1))  # linked list: the next live symbol, n at the end
        before = list(range(-1, n - 1))
        left = n
        while heap:
            top = heappop(heap)
            i = top & _MASK
            a = sym[i]
            if a < 0:
                continue
            j = after[i]
            if j == n:
                continue
            key = a << _SHIFT | sym[j]
            if rank.get(key) != top >> 40:  # the pair here is another one by now
                continue
            new = sym[i] = merged[key]
            sym[j] = -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                r = rank.get(new << _SHIFT | sym[k])
                if r is not None:
                    heappush(heap, r << 40 | i)
            h = before[i]
            if h >= 0:
                r = rank.get(sym[h] << _SHIFT | new)
                if r is not None:
                    heappush(heap, r << 40 | h)
        return left


_COUNTERS: dict[str, MergeCounter] = {}


def counter(path: str) -> MergeCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = MergeCounter(path)
    return _COUNTERS[path]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = counter(path).__getitem__
        for batch in batches:
            data, offs = K.text_buffers(batch.column("text"))
            n = [
                sum(sum(map(get, piece.split())) for piece in text_pieces(data, lo, hi))
                for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)
            ]
            counts = pa.array(n, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(offs[1:] - offs[:-1]), counts], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row.

    One scan, no shuffle. Null and empty texts have 0 bytes and 0 tokens; ids
    may be null or repeated; extra columns are ignored; a very long text is
    counted piece by piece.
    """
    ship(docs.sparkSession)
    out = text_and_id(docs, id_col, text_col).mapInArrow(_count(resolve(tokenizer)), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
