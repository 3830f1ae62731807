"""Vectorised text kernels (numpy over Arrow buffers) shared by the llm operators.

Everything here is a small helper that runs inside Spark tasks on a bounded
slice of an Arrow batch: no Spark, no global state, no randomness beyond the
fixed seeds below, so every executor computes the same hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: A slice handed to the kernels holds at most this many text bytes (a longer text is a slice of its own).
SLICE_BYTES = 1 << 20

_U = np.uint64


def _odd(rng: np.random.Generator, n: int) -> np.ndarray:
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1)


_RNG = np.random.default_rng(20240131)
#: One random value a byte; ASCII white space is 0, and A-Z share the values of a-z.
_BYTE = _odd(_RNG, 256)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_SPACE] = 0
#: As above with A-Z apart from a-z.
_BYTE_CASE = _BYTE.copy()
_BYTE[65:91] = _BYTE[97:123]
#: As above with every ASCII character that is no letter or digit as a separator.
_BYTE_ALNUM = np.where([b >= 128 or chr(b).isalnum() for b in range(256)], _BYTE, 0).astype(np.uint64)
_BASE = int(_odd(_RNG, 1)[0])
_BASE_INV = pow(_BASE, -1, 1 << 64)
_LANE = _odd(_RNG, 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * _U(pow(base, have, 1 << 64))
        have += more
    return out


_POW = _powers(_BASE, 1 << 12)
_POW_INV = _powers(_BASE_INV, 1 << 12)


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, grown (and kept) up to twice a slice."""
    global _POW, _POW_INV
    if n > len(_POW):
        if n > 2 * SLICE_BYTES:
            return _powers(_BASE, n), _powers(_BASE_INV, n)
        _POW, _POW_INV = _powers(_BASE, 2 * SLICE_BYTES), _powers(_BASE_INV, 2 * SLICE_BYTES)
    return _POW, _POW_INV


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit over the result."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is an empty one. No Python string is made."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offs


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [lo, hi) of rows with at most ``limit`` text bytes (one row at least)."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def _words(data: np.ndarray, offs: np.ndarray, byte: np.ndarray = _BYTE) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and word start bytes of the rows in ``data``; ``offs`` starts at 0."""
    value = byte[data]
    word = value != 0
    first = word.copy()
    first[1:] &= ~word[:-1]
    heads = offs[:-1][offs[:-1] < offs[1:]]
    first[heads] = word[heads]  # a row never continues the word before it
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    up, down = _pow_tables(len(data))
    sums = np.add.reduceat(value * up[: len(data)], starts)
    return mix(sums * down[starts]), starts


def word_hashes(data: np.ndarray, offs: np.ndarray, alnum: bool = False, case: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) of some rows.

    alnum: all ASCII punctuation separates words, too. case: A-Z stay as they are.

    Returns (hashes, bounds): row i has the words bounds[i]:bounds[i+1]. A row
    longer than a slice is cut at white space, so the working memory stays a
    few slices plus eight bytes a word.
    """
    byte = _BYTE_ALNUM if alnum else _BYTE_CASE if case else _BYTE
    base = offs[0]
    if offs[-1] - base > 2 * SLICE_BYTES and len(offs) == 2:
        parts, lo, end = [], int(base), int(offs[-1])
        while lo < end:
            hi = min(lo + SLICE_BYTES, end)
            if hi < end:  # go on to the end of the word at the cut
                step = 4096
                while hi < end:
                    gap = np.flatnonzero(_SPACE[data[hi : hi + step]])
                    if len(gap):
                        hi += int(gap[0])
                        break
                    hi = min(hi + step, end)
            parts.append(_words(data[lo:hi], np.array([0, hi - lo]), byte)[0])
            lo = hi
        hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return hashes, np.array([0, len(hashes)])
    local = offs - base
    hashes, starts = _words(data[base : offs[-1]], local, byte)
    return hashes, np.searchsorted(starts, local)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; element i is the run that begins at word i."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - n + 1] * _LANE[0]
    for k in range(1, n):
        out = out + words[k : len(words) - n + 1 + k] * _LANE[k]
    return mix(out + _U(n))


def whole_hash(words: np.ndarray) -> np.ndarray:
    """One hash of a whole (short) word sequence; empty for no words."""
    return window_hashes(words, len(words)) if 0 < len(words) <= len(_LANE) else np.zeros(0, np.uint64)


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word ``k``-shingles of each row, sorted, as (hashes, bounds).

    A row with fewer than ``k`` words has its whole sequence as the only
    shingle, and none without words.
    """
    words, bounds = word_hashes(data, offs)
    runs = window_hashes(words, k)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        out.append(np.unique(runs[a : b - k + 1]) if b - a >= k else whole_hash(words[a:b]))
    ends = np.concatenate(([0], np.cumsum([len(x) for x in out]))).astype(np.int64)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), ends


def signatures(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit signature a set (int64): equal sets have equal signatures; 0 for an empty set."""
    n = len(bounds) - 1
    out = np.zeros(n, np.uint64)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        lo = bounds[:-1][full]
        total = np.add.reduceat(mix(sets ^ _LANE[60]), lo)
        other = np.add.reduceat(mix(sets ^ _LANE[61]), lo)
        size = (bounds[1:] - bounds[:-1])[full].astype(np.uint64)
        out[full] = mix(total * _LANE[62] + other * _LANE[63] + size) | _U(1)
    return out.view(np.int64)


def gram_counts(raw: np.ndarray, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse counts of the hashed n-grams of one text's bytes or code points: (buckets, counts).

    Runs of the given orders are hashed to ``2**bits`` buckets. A long text is
    counted slice by slice with an overlap, so memory does not grow with it.
    """
    total = np.zeros(1 << bits, np.int64)
    for lo in range(0, max(len(raw), 1), SLICE_BYTES):
        x = raw[lo : lo + SLICE_BYTES + max(orders) - 1].astype(np.uint32)
        for n in orders:
            m = min(SLICE_BYTES, len(raw) - lo - n + 1)
            if m <= 0:
                continue
            h = x[:m] * np.uint32(_GRAM[0])
            for k in range(1, n):
                h = h + x[k : k + m] * np.uint32(_GRAM[k])
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(n)
            total += np.bincount(h >> np.uint32(32 - bits), minlength=1 << bits)
    at = np.flatnonzero(total)
    return at, total[at]


_GRAM = [int(v) & 0xFFFFFFFF | 1 for v in _odd(_RNG, 8)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_points(raw: np.ndarray) -> np.ndarray:
    """Code points of a UTF-8 text in lower case (uint32), or its bytes if all are ASCII: these are the same numbers."""
    if not len(raw) or raw.max() < 128:
        return lower_bytes(raw)
    parts, lo = [], 0
    while lo < len(raw):
        hi = min(lo + SLICE_BYTES, len(raw))
        while hi < len(raw) and hi > lo + 1 and raw[hi] & 0xC0 == 0x80:  # not within a character
            hi -= 1
        text = raw[lo:hi].tobytes().decode("utf-8", "replace").lower()
        parts.append(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
        lo = hi
    return np.concatenate(parts)


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    """ASCII letters in lower case, everything else as it is."""
    return _LOWER[raw]
