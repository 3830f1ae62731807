"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Seeds are all word ``SEED``-grams of the test items (letters and digits only, A-Z
lower-cased), however many documents have them. One scan joins the documents to the items on the
seeds and aligns the passage around each match with the whole item; the local alignment score, as
a share of the item's best possible score, finds exact, edited and paraphrased copies.
Before it is aligned, a passage is left out only if its words alone show that it cannot
reach the threshold (an upper bound of the score), so common word runs cost little and lose nothing.

The item index is broadcast in blocks of at most ``BLOCK_BYTES`` of item text; a larger
benchmark takes more scans, not more memory. Texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import kernels as K
from ledgerflow.llm.common import filter_rows, pick, position, ship, text_and_id

SEED = 3
MATCH, MISMATCH, GAP = 2, -1, 1
#: Share of the item's best score from which a document counts as contaminated.
THRESHOLD = 0.5
#: Item text in one broadcast.
BLOCK_BYTES = 8 << 20
#: Seed matches, and words of passages, that are looked at together (a larger single one is taken whole).
POSTINGS, CELLS = 1 << 20, 1 << 18

SCHEMA = "doc_id long, item_id long, score double, first_word long, n_words long, exact boolean"


@dataclass
class Index:
    """Seeds of a block of items: sorted hashes, and for each the (item, offset) pairs that have it."""

    ids: list[int]
    words: list[np.ndarray]
    seeds: np.ndarray
    begin: np.ndarray
    item: np.ndarray
    offset: np.ndarray

    def __post_init__(self) -> None:
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.seeds & np.uint64((1 << 20) - 1)] = True
        self.size = np.array([len(w) for w in self.words], np.int64)
        #: Seed number and item of each posting, in rising order.
        self.key = np.repeat(np.arange(len(self.seeds)), np.diff(self.begin)) * len(self.ids) + self.item

    @staticmethod
    def build(items: list[tuple[int, np.ndarray]]) -> Index:
        """Of (item id, words)."""
        hashes, item, offset = [], [], []
        for i, (_, words) in enumerate(items):
            h = K.window_hashes(words, SEED)
            hashes.append(h)
            item.append(np.full(len(h), i))
            offset.append(np.arange(len(h)))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        at, off = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (item, offset))
        order = np.argsort(h, kind="stable")
        seeds, begin = np.unique(h[order], return_index=True)
        return Index([i for i, _ in items], [w for _, w in items], seeds, np.append(begin, len(h)), at[order], off[order])

    def matches(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, word position in the flat list, seed number) of each seed in the rows."""
        runs = K.window_hashes(words, SEED)
        at = np.flatnonzero(self.sieve[runs & np.uint64((1 << 20) - 1)])
        if not len(at) or not len(self.seeds):
            none = np.zeros(0, np.int64)
            return none, none, none
        s = np.searchsorted(self.seeds, runs[at])
        s[s == len(self.seeds)] = 0
        hit = self.seeds[s] == runs[at]
        at, s = at[hit], s[hit]
        row = np.searchsorted(bounds, at, side="right") - 1
        inside = at + SEED <= bounds[row + 1]
        return row[inside], at[inside], s[inside]


def align(item: np.ndarray, windows: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman of one item with several windows (rows; padding is not valid).

    Returns the best local scores and where they end (item word, window word).
    """
    m, n = windows.shape
    ramp = GAP * np.arange(n + 1)
    prev = np.zeros((m, n + 1), np.int64)
    best, end_i, end_j = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
    for i, w in enumerate(item):
        row = np.zeros((m, n + 1), np.int64)
        step = np.where(valid & (windows == w), MATCH, MISMATCH)
        np.maximum(prev[:, :-1] + step, prev[:, 1:] - GAP, out=row[:, 1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + ramp, axis=1) - ramp  # gaps along the window
        j = row.argmax(1)
        top = row[np.arange(m), j]
        up = top > best
        best[up], end_i[up], end_j[up] = top[up], i + 1, j[up]
        prev = row
    return best, end_i, end_j


def _candidates(
    index: Index, row: np.ndarray, at: np.ndarray, seed: np.ndarray, bounds: np.ndarray, some: tuple[int, int] | None = None
) -> Iterator[np.ndarray]:
    """Rows of (row, item, window from, window to) around the matches of each row with each item (of ``some`` positions).

    In pieces of at most ``POSTINGS`` matches, unless one row has more with one item.
    """
    lo, hi = some or (0, len(index.ids))
    begin = np.searchsorted(index.key, seed * len(index.ids) + lo)
    n = np.searchsorted(index.key, seed * len(index.ids) + hi) - begin
    use = n > 0
    row, at, seed, begin, n = row[use], at[use], seed[use], begin[use], n[use]
    if not len(row):
        return
    if n.sum() > POSTINGS and row[0] != row[-1]:
        cut = np.searchsorted(row, row[len(row) // 2]) or np.searchsorted(row, row[0], side="right")
        for part in (slice(cut), slice(cut, None)):
            yield from _candidates(index, row[part], at[part], seed[part], bounds, (lo, hi))
        return
    if n.sum() > POSTINGS and hi - lo > 1:
        for part in ((lo, (lo + hi) // 2), ((lo + hi) // 2, hi)):
            yield from _candidates(index, row, at, seed, bounds, part)
        return
    post = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    r, i = np.repeat(row, n), index.item[post]
    diagonal = np.repeat(at, n) - index.offset[post]
    order = np.lexsort((diagonal, i, r))
    r, i, diagonal = r[order], i[order], diagonal[order]
    slack = index.size[i] // 2 + 4
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (i[1:] != i[:-1]) | (diagonal[1:] - diagonal[:-1] > slack[1:])
    first = np.flatnonzero(new)
    high = diagonal[np.append(first[1:], len(r)) - 1]
    r, i, low, slack = r[first], i[first], diagonal[first], slack[first]
    yield np.column_stack([r, i, np.maximum(bounds[r], low - slack), np.minimum(bounds[r + 1], high + index.size[i] + slack)])


def _possible(item: np.ndarray, windows: np.ndarray, valid: np.ndarray, least: float) -> np.ndarray:
    """Which windows may score ``least``: the others cannot, whatever the order of their words.

    A window word that the item lacks costs a mismatch or a gap and any other gains a match at
    most, so no score is above the largest sum of a run of these; nor above a match for each word in common.
    """
    known, times = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(known, windows), len(known) - 1)
    shared = valid & (known[at] == windows)
    total = np.cumsum(np.where(shared, MATCH, -min(GAP, -MISMATCH)), axis=1)
    run = (total - np.minimum(np.minimum.accumulate(total, axis=1), 0)).max(1)
    have = np.bincount((np.arange(len(windows))[:, None] * len(known) + at)[shared], minlength=len(windows) * len(known))
    common = np.minimum(have.reshape(len(windows), len(known)), times).sum(1)
    return np.minimum(run, MATCH * common) >= least


def _blocks(words: np.ndarray, wins: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(windows of one item, their words, what is no padding), windows of like width together."""
    wins = wins[np.argsort(wins[:, 3] - wins[:, 2], kind="stable")]
    width = np.maximum(wins[:, 3] - wins[:, 2], size)
    lo = 0
    while lo < len(wins):
        hi = lo + 1
        while hi < len(wins) and (hi + 1 - lo) * width[hi] <= CELLS:
            hi += 1
        some = wins[lo:hi]
        place = some[:, 2:3] + np.arange((some[:, 3] - some[:, 2]).max())
        valid = place < some[:, 3:4]
        yield some, np.where(valid, words[np.minimum(place, len(words) - 1)], np.uint64(0)), valid
        lo = hi


def find(index: Index, data: np.ndarray, offs: np.ndarray, threshold: float) -> list[tuple[int, int, float, int, int, bool]]:
    """(row, item id, score, first word, words, exact) of the contaminated rows, best passage per item."""
    best: dict[tuple[int, int], tuple[float, int, int, bool]] = {}
    for lo, hi in K.slices(offs):
        words, bounds = K.word_hashes(data, offs[lo : hi + 1], alnum=True)
        for wins in _candidates(index, *index.matches(words, bounds), bounds):
            wins = wins[np.argsort(wins[:, 1], kind="stable")]
            for mine in np.split(wins, np.flatnonzero(np.diff(wins[:, 1])) + 1):
                i = int(mine[0, 1])
                item = index.words[i]
                full = MATCH * len(item)
                for some, block, valid in _blocks(words, mine, len(item)):
                    use = np.flatnonzero(_possible(item, block, valid, threshold * full))
                    if not len(use):
                        continue
                    some, block = some[use], block[use]
                    score, end_i, end_j = align(item, block, valid[use])
                    for q in np.flatnonzero(score >= threshold * full):
                        r, a = int(some[q, 0]), int(some[q, 2])
                        back = block[q : q + 1, : end_j[q]][:, ::-1]
                        n = int(align(item[: end_i[q]][::-1], back, np.ones_like(back, bool))[2][0])
                        first = a + int(end_j[q]) - n
                        key, value = (lo + r, index.ids[i]), (float(score[q]) / full, first - int(bounds[r]), n, bool(score[q] == full))
                        if key not in best or (value[0], -value[1]) > (best[key][0], -best[key][1]):
                            best[key] = value
    return [(r, i, *v) for (r, i), v in sorted(best.items())]


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The items with at least SEED words, in blocks of about BLOCK_BYTES of text."""
    items = pick(benchmark, item_id=(id_col, "long"), text=(text_col, "string")).where("item_id is not null and text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    for b in range(blocks):
        got = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").toArrow()
        data, offs = K.text_buffers(got.column("text"))
        ids = got.column("item_id").to_pylist()
        out = []
        for i, item_id in enumerate(ids):
            words, _ = K.word_hashes(data, offs[i : i + 2], alnum=True)
            if len(words) >= SEED:
                out.append((item_id, words))
        if out:
            yield out


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row for each (document, test item) whose best passage scores ``threshold`` or more.

    doc_id, item_id, score (1 for a whole copy), first_word and n_words of the passage in the
    document (words of letters and digits), exact (the whole item, word for word).

    Defined cases: null and empty texts match nothing; items with fewer than three words, a null id or a
    null text are no test items; a null doc_id is kept as null; repeated documents each get their
    rows, repeated items count once; an item id with several texts is matched by each; a tie goes to the
    first passage; extra columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = text_and_id(docs, id_col, text_col)
    out = None
    for items in _item_blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(Index.build(items))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offs = K.text_buffers(batch.column("text"))
                found = find(shared.value, data, offs, threshold)
                if found:
                    row, item, score, first, n, exact = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(row)), *[pa.array(x) for x in (item, score, first, n, exact)]],
                        names=["doc_id", "item_id", "score", "first_word", "n_words", "exact"],
                    )

        part = texts.mapInArrow(run, SCHEMA)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else spark.createDataFrame([], SCHEMA)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """The rows (all columns) that hold no passage of a test item; see ``contaminated``.

    Defined cases: null and empty texts hold none and stay, whatever their id; repeated rows go or stay together; a
    very long text is searched whole; without items all rows stay; other columns, also with clashing names, come back as they are.
    """
    ship(docs.sparkSession)
    at = position(docs, text_col)
    for items in _item_blocks(benchmark, item_col, "text"):
        shared = docs.sparkSession.sparkContext.broadcast(Index.build(items))

        def keep(batch: pa.RecordBatch, shared=shared) -> np.ndarray:
            data, offs = K.text_buffers(batch.column(at))
            good = np.ones(batch.num_rows, bool)
            good[[f[0] for f in find(shared.value, data, offs, threshold)]] = False
            return good

        docs = filter_rows(docs, keep)
    return docs
