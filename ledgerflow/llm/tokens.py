"""Token ids of whole texts by the ``tokenizers`` library, with a bounded word cache per worker.

``word_bpe``-style tokenizers drop white space and encode each word on its own, so a text's ids
are the ids of its white-space separated chunks, one after the other. A worker finds the
distinct chunks of many texts at once, encodes a chunk once and keeps its ids; other tokenizers encode each text as a whole.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import compress
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks of one generation of a Python worker's cache (two are kept at most), and word pieces (about 100 MB).
CACHE_ENTRIES, PIECE_ENTRIES = 200_000, 400_000
#: Long texts are handed on in pieces of about this many bytes, cut at ASCII white space.
PIECE_BYTES = 1 << 20
#: Texts are cut into distinct chunks in windows of about this many bytes.
WINDOW_BYTES = 1 << 21

#: The printable part of the first Unicode blocks: stable under NFC and lower-cased letter by letter.
_PLAIN = re.compile("[!-~¡-¬®-ɏ]*").fullmatch
#: Stands between plain chunks, which never hold it; no chunk holds a blank.
_MARK = "\0"
_BETWEEN = f" {_MARK} "
#: Plain chunks, joined.
_PLAIN_ALL = re.compile("[!-~¡-¬®-ɏ \0]*").fullmatch
_ID = attrgetter("id")
#: Whether a pattern names letters and digits only as members of bracketed classes.
_CLASSES_ONLY = re.compile(r"(?:[^\[\]\\]|\\[^pP]|\[(?:[^\[\]\\]|\\[^pP]|\\p\{[LN]\})*\])*").fullmatch
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def byte_alphabet() -> str:
    """The printable character that stands for each byte (a table for ``str.translate``)."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return "".join(chr(b if b in keep else next(spare)) for b in range(256))


_BYTES = byte_alphabet()


def to_alphabet(piece: str) -> str:
    return piece if piece.isascii() and piece.isprintable() and " " not in piece else piece.encode().decode("latin-1").translate(_BYTES)


def text_pieces(data: np.ndarray, lo: int, hi: int) -> Iterator[bytes]:
    """The bytes lo:hi, whole if short, else cut at white space into pieces of about PIECE_BYTES."""
    while lo < hi:
        end = min(lo + PIECE_BYTES, hi)
        while end < hi:
            gap = np.flatnonzero(_SPACES[data[end : end + 4096]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + 4096, hi)
        yield data[lo:end].tobytes()
        lo = end


def text_windows(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Whole texts of at most WINDOW_BYTES in all; a longer text alone, cut at ASCII white space into about as much."""
    lo, end = int(offs[0]), int(offs[-1])
    while lo < end:
        hi = int(offs[np.searchsorted(offs, lo + WINDOW_BYTES, "right") - 1])
        if hi <= lo:
            text_end = int(offs[np.searchsorted(offs, lo, "right")])
            hi = min(lo + WINDOW_BYTES, text_end)
            while hi < text_end:
                gap = np.flatnonzero(_SPACES[data[hi : min(hi + 4096, text_end)]])
                if len(gap):
                    hi += int(gap[0])
                    break
                hi = min(hi + 4096, text_end)
        yield lo, hi
        lo = hi


def _gather(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[begin[i] : begin[i] + sizes[i]]``, one after the other."""
    ends = np.cumsum(sizes)
    shift = (begin - (ends - sizes)).astype(np.int32)  # a window has far fewer than 2^31 ids, the cache too
    return flat[np.repeat(shift, sizes) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]


def _plain_of(category: str) -> str:
    """The characters of a Unicode category (its first letter) in lower-cased plain text."""
    plain = {c for i in range(33, 0x250) for c in chr(i).lower()}
    return "".join(sorted(c for c in plain if unicodedata.category(c)[0] == category))


def _joined(chunks: pa.BinaryArray) -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), _BETWEEN.encode())[0].as_py().decode()


def _lengths(ids: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, ids), np.int64, len(ids)) // 4


def _id_bytes(ids: Iterable[int]) -> bytes:
    """Little-endian uint32 (an array of a few numbers costs less than numpy's)."""
    got = array("I", ids)
    if sys.byteorder == "big":
        got.byteswap()
    return got.tobytes()


class _Pieces(dict):
    """Piece of a plain word -> its ids as little-endian uint32 bytes, by the library's BPE model; the mark has none."""

    def __init__(self, model) -> None:
        self.tokenize = model.tokenize

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= PIECE_ENTRIES:
            self.clear()
        word = piece if piece.isascii() else to_alphabet(piece)
        got = self[piece] = _id_bytes(map(_ID, self.tokenize(word))) if piece != _MARK else b""
        return got


class _Chunks:
    """White-space separated chunks and their ids, as Arrow and numpy arrays: no Python object a chunk.

    A window of text is cut into chunks and these into distinct ones at once; only those not in the cache are
    encoded. Up to two generations of chunks are kept; beyond that the most used make one generation.
    """

    def __init__(self, tokenizer, pattern: str, entries: int | None = None) -> None:
        import regex

        self.entries = entries
        self.tokenizer, self.pieces = tokenizer, _Pieces(tokenizer.model)
        if _CLASSES_ONLY(pattern):  # plain text has these letters and digits only
            self.find = re.compile(pattern.replace(r"\p{L}", _plain_of("L")).replace(r"\p{N}", _plain_of("N"))).findall
        else:
            self.find = regex.compile(pattern).findall
        self.keys = pa.array([], pa.binary())
        self.flat = np.empty(0, "<u4")  # the ids of all keys, one key after the other
        self.sizes = self.uses = np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    @property
    def generation(self) -> int:
        return self.entries or CACHE_ENTRIES

    @property
    def old(self) -> int:
        """Chunks beyond one generation."""
        return max(0, len(self) - self.generation)

    def rest(self) -> None:
        """Keep the most used chunks, one generation of them."""
        if not self.old:
            return
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: self.generation])
        self.flat = _gather(self.flat, (np.cumsum(self.sizes) - self.sizes)[keep], self.sizes[keep])
        self.keys, self.sizes, self.uses = self.keys.take(pa.array(keep)), self.sizes[keep], self.uses[keep] // 2

    def ids(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a window of texts, and how many of them lie before each of ``bounds`` (where texts begin and end)."""
        word = ~_SPACES[data]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        begins, ends = bounds[bounds < len(data)], bounds[bounds > 0] - 1
        first[begins], last[ends] = word[begins], word[ends]
        first = np.flatnonzero(first)
        offsets = np.concatenate(([0], np.cumsum(np.flatnonzero(last) + 1 - first))).astype(np.int32)
        chunks = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[word])]).dictionary_encode()
        code, at = chunks.indices.to_numpy(), self._places(chunks.dictionary)
        self.uses[at] += np.bincount(code, minlength=len(at))
        sizes = self.sizes[at][code]
        ids = _gather(self.flat, (np.cumsum(self.sizes) - self.sizes)[at][code], sizes)
        if len(self) >= 2 * self.generation:
            self.rest()
        return ids, np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(first, bounds)]

    def _places(self, chunks: pa.BinaryArray) -> np.ndarray:
        """Where each of these distinct chunks is in the cache; new ones are encoded and added."""
        at = pc.index_in(chunks, value_set=self.keys).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            text = _joined(chunks.take(pa.array(new)))
            if _PLAIN_ALL(text) and text.count(_MARK) == len(new) - 1 and "<|" not in text:
                ids, sizes = self._encode_plain(text, len(new))
            else:
                texts = text.split(_BETWEEN)
                plain = np.fromiter((bool(_PLAIN(t)) and "<|" not in t for t in texts), bool, len(texts))
                new = np.concatenate((new[plain], new[~plain]))
                ids, sizes = self._encode_plain(_BETWEEN.join(compress(texts, plain)), int(plain.sum()))
                # other scripts, control characters, special tokens: the library does it all
                others = [_id_bytes(self.tokenizer.encode(t, add_special_tokens=False).ids) for t in compress(texts, ~plain)]
                ids, sizes = b"".join([ids, *others]), np.concatenate((sizes, _lengths(others)))
            at[new] = len(self) + np.arange(len(new))
            self.keys = pa.concat_arrays([self.keys, chunks.take(pa.array(new))])
            self.flat = np.concatenate((self.flat, np.frombuffer(ids, "<u4")))
            self.sizes = np.concatenate((self.sizes, sizes))
            self.uses = np.concatenate((self.uses, np.zeros(len(new), np.int64)))
        return at

    def _encode_plain(self, text: str, n: int) -> tuple[bytes, np.ndarray]:
        """The ids of ``n`` plain chunks, one after the other, and each one's number of ids."""
        if not n:
            return b"", np.empty(0, np.int64)
        text = text.lower()
        found = self.find(text)  # one search for the words of all chunks; the mark between chunks is a word of its own
        marks = [i for i, f in enumerate(found) if f == _MARK]
        if len(marks) != n - 1:  # the pattern has no place for the mark
            got = [b"".join([self.pieces[f] for f in self.find(c)]) for c in text.split(_BETWEEN)]
            return b"".join(got), _lengths(got)
        got = list(map(self.pieces.__getitem__, found))
        before = np.concatenate(([0], np.cumsum(_lengths(got))))
        return b"".join(got), np.diff(before[marks], prepend=0, append=before[-1])


class Encoder:
    """Encodes texts as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str, entries: int | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pattern = _word_pattern(spec)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.chunks = _Chunks(self.tokenizer, pattern, entries) if pattern else None

    def rest(self) -> None:
        """Keep only one generation of the cache: Spark holds idle workers, and later jobs need their memory."""
        if self.chunks is not None:
            self.chunks.rest()
        pa.default_memory_pool().release_unused()

    def texts(self, data: np.ndarray, offs: np.ndarray) -> Iterator[bytes]:
        """The ids of each text ``offs[i]:offs[i + 1]``, in order, as little-endian uint32 bytes."""
        if self.chunks is None:
            for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                text = data[lo:hi].tobytes().decode()
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if text else b""
            return
        text, begun = 0, []  # the text whose end is still to come, and its ids from earlier windows
        for lo, hi in text_windows(data, offs):
            stop = int(np.searchsorted(offs[1:], hi, "right"))
            ids, ends = self.chunks.ids(data[lo:hi], offs[text + 1 : stop + 1] - lo)
            at, raw = 0, ids.tobytes()
            for end in (4 * ends).tolist():
                yield b"".join([*begun, raw[at:end]])
                begun.clear()
                at = end
            begun.append(raw[at:])
            text = stop
        for _ in range(text, len(offs) - 1):  # empty texts, if all are
            yield b""

    def ids(self, data: np.ndarray, lo: int, hi: int) -> Iterator[bytes]:
        """The ids of one text as little-endian uint32 bytes."""
        return self.texts(data, np.array([lo, hi]))


def _word_pattern(spec: dict) -> str | None:
    """The split pattern of a tokenizer that encodes white-space separated chunks one by one."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    norms = (spec.get("normalizer") or {}).get("normalizers") or []
    added = [t for t in spec.get("added_tokens", []) if not t["content"].startswith("<|") or t.get("normalized") or t.get("lstrip") or t.get("rstrip") or t.get("single_word")]
    fits = (
        [n.get("type") for n in norms] == ["NFC", "Replace", "Lowercase"]
        and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
        and steps[0].get("behavior") == "Removed"
        and steps[0].get("invert")
        and not steps[1].get("add_prefix_space")
        and not steps[1].get("use_regex")
        and not added
    )
    return steps[0]["pattern"]["Regex"] if fits else None


_ENCODERS: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, entries: int | None = None) -> Encoder:
    """The worker's encoder for a tokenizer file; Spark reuses the worker for later tasks. ``entries``: chunks of a cache generation."""
    if (path, entries) not in _ENCODERS:
        _ENCODERS[path, entries] = Encoder(path, entries)
    return _ENCODERS[path, entries]


def resolve(name: str) -> str:
    """A path as it is; a bare file name is looked up among the installed public tokenizers."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
