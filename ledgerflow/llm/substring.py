"""Substring dedup by suffix automata: words of passages that an earlier document holds go.

A *window* is a run of ``window`` words of one document. A word goes if a window over it also
starts in a document with a smaller id. The decision is made by suffix automata over words: a *reference
shard* goes to every task that holds documents for it and becomes its automaton there; the documents stream
through it for their matching statistics, and a match of ``window`` words or more whose smallest owner is an
earlier document marks the span.

The corpus is its own reference, so the automata must not hold all of it, and not every
document can visit every automaton. Two bounds keep both in proportion to what is repeated:

1. *Seeds.* Every window names its least hash among its runs of half a window (winnowing): equal windows name
   equal seeds, and a document has about one seed in 14 words. Seeds of one document only are done with. A shared seed has
   a *home*: its first document and the block of that document's words where it lies.
2. *Reference spans.* Of the windows with a shared seed, equal ones (by a 64-bit hash) are counted; of those in two documents or more
   the first document's text is reference. So a passage is reference once, however many documents share it.

A window goes to the shard of its seed's home, both as reference and as query, so a copied document
visits the automaton of its original and few others. Shards hold about ``SHARD_WINDOWS`` windows; documents
for one shard are dealt over as many parts as their words need, each with the whole shard. Hashes only
select; words are compared as they are in the automaton.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import kernels as K
from ledgerflow.llm.common import materialize, pick, ship, small_batches

WINDOW = 50
#: Words of a home document that make one block.
BLOCK_WORDS = 1 << 16
#: Reference windows of a shard, on average, and query words that one task streams through it.
SHARD_WINDOWS, PART_WORDS = 1 << 15, 1 << 19
#: Bytes of rows that a task collects before it hands them on.
OUT_BYTES = 1 << 21
_SPAN = "unit long, doc_id long, version long, first long, words binary"


def _least_seeds(words: np.ndarray, window: int) -> np.ndarray:
    """For every window start the least hash of the runs of half a window inside it."""
    half = (window + 1) // 2
    low, have, want = K.window_hashes(words, half), 1, window - half + 1
    while have < want:
        step = min(have, want - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


def _document_seeds(window: int):
    """mapInArrow function: (doc_id, version, text) -> (seed, doc_id, at), a row for each change of seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offs = K.text_buffers(batch.column(1))
            for lo, hi in K.slices(offs):
                words, bounds = K.word_hashes(data, offs[lo : hi + 1], case=True)
                if len(words) < window:
                    continue
                low = _least_seeds(words, window)
                size = np.diff(bounds)
                row = np.repeat(np.arange(hi - lo), size)[: len(low)]
                inside = np.arange(len(low)) + window <= bounds[1:][row]
                at, low, row = np.flatnonzero(inside), low[inside], row[inside]
                new = np.ones(len(low), bool)
                new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1])
                at, low, row = at[new], low[new], row[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low.view(np.int64)), pa.array(ids[lo:hi][row]), pa.array(at - bounds[:-1][row])], names=["seed", "doc_id", "at"]
                )

    return run


class _Text:
    """One candidate document: its words, and the unit of each window (0: no shared seed)."""

    def __init__(self, raw: bytes, seeds: np.ndarray, units: np.ndarray, window: int):
        data = np.frombuffer(raw, np.uint8)
        self.hashes, _ = K.word_hashes(data, np.array([0, len(data)]), case=True)
        self.raw, self.window = raw, window
        low = _least_seeds(self.hashes, window).view(np.int64) if len(self.hashes) >= window else np.zeros(0, np.int64)
        order = np.argsort(seeds)
        seeds, units = seeds[order], units[order]
        place = np.minimum(np.searchsorted(seeds, low), len(seeds) - 1)
        self.unit = np.where(seeds[place] == low, units[place], 0)

    def window_hashes(self) -> np.ndarray:
        return K.window_hashes(self.hashes, self.window).view(np.int64)

    def spans(self, chosen: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        """(unit, first word, text) of the runs of chosen windows of one unit."""
        if not chosen.any():
            return
        words = self.raw.split()
        value = np.where(chosen, self.unit, 0)
        cuts = np.concatenate(([0], np.flatnonzero(value[1:] != value[:-1]) + 1, [len(value)]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if value[a]:
                yield int(value[a]), a, b" ".join(words[a : b + self.window - 1])


def _texts(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, int, _Text, dict]]:
    """The candidate documents of a batch (doc_id, version, text, seeds, units, more)."""
    for row in range(batch.num_rows):
        one = {n: batch.column(i)[row] for i, n in enumerate(batch.schema.names)}
        seeds, units = (one[c].values.to_numpy(zero_copy_only=False) for c in ("seeds", "units"))
        yield one["doc_id"].as_py(), one["version"].as_py(), _Text(one["text"].as_buffer().to_pybytes(), seeds, units, window), one


def _candidate_windows(window: int):
    """mapInArrow function: candidate documents -> (hash, doc_id), one row for each window with a shared seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes)), pa.array(np.concatenate(ids))], names=["hash", "doc_id"])

        for batch in batches:
            hashes, ids, size = [], [], 0
            for doc_id, _, text, _ in _texts(batch, window):
                found = text.window_hashes()[text.unit != 0]
                hashes.append(found)
                ids.append(np.full(len(found), doc_id))
                size += 16 * len(found)
                if size > OUT_BYTES:
                    yield out()
                    hashes, ids, size = [], [], 0
            if hashes:
                yield out()

    return run


def _span_rows(window: int, reference: bool):
    """mapInArrow function: candidate documents -> spans; all windows with a shared seed, or the reference ones (column hashes)."""

    kinds = {"unit": pa.int64(), "doc_id": pa.int64(), "version": pa.int64(), "first": pa.int64(), "words": pa.binary()}

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for doc_id, version, text, one in _texts(batch, window):
                chosen = text.unit != 0
                if reference:
                    chosen &= np.isin(text.window_hashes(), one["hashes"].values.to_numpy(zero_copy_only=False))
                for unit, first, words in text.spans(chosen):
                    out.append((unit, doc_id, version, first, words))
                    size += len(words)
                if size > OUT_BYTES:
                    yield rows(out)
                    out, size = [], 0
            if out:
                yield rows(out)

    return run


class SuffixAutomaton:
    """Suffix automaton over words of some (owner, words) spans; a state knows its smallest owner.

    Spans are joined by separators that occur once, so no match runs over an end.
    """

    def __init__(self, spans: list[tuple[int, list[bytes]]]):
        self.symbols: dict[bytes, int] = {}
        symbols = self.symbols
        nxt: list[dict[int, int]] = [{}]
        link, length, owner = [-1], [0], [0]
        none = (1 << 63) - 1
        last, separator = 0, -1
        for who, words in spans:
            text = [symbols.setdefault(w, len(symbols)) for w in words]
            text.append(separator)
            separator -= 1
            for symbol in text:
                now = len(nxt)
                nxt.append({})
                length.append(length[last] + 1)
                link.append(0)
                owner.append(who if symbol >= 0 else none)
                p = last
                while p >= 0 and symbol not in nxt[p]:
                    nxt[p][symbol] = now
                    p = link[p]
                if p >= 0:
                    q = nxt[p][symbol]
                    if length[p] + 1 == length[q]:
                        link[now] = q
                    else:
                        clone = len(nxt)
                        nxt.append(nxt[q].copy())
                        length.append(length[p] + 1)
                        link.append(link[q])
                        owner.append(none)
                        while p >= 0 and nxt[p].get(symbol) == q:
                            nxt[p][symbol] = clone
                            p = link[p]
                        link[q] = link[now] = clone
                last = now
        owner[0] = none
        for state in np.argsort(-np.array(length), kind="stable").tolist():  # longer states hand their owner to their links
            up = link[state]
            if up >= 0 and owner[state] < owner[up]:
                owner[up] = owner[state]
        self.nxt, self.link, self.length, self.owner = nxt, link, length, owner

    def matches(self, words: list[bytes], window: int) -> Iterator[tuple[int, int]]:
        """(end word, smallest owner) wherever the matching statistic reaches ``window``."""
        nxt, link, length, owner, symbols = self.nxt, self.link, self.length, self.owner, self.symbols
        state = matched = 0
        for i, word in enumerate(words):
            symbol = symbols.get(word)
            if symbol is None:
                state = matched = 0
                continue
            to = nxt[state].get(symbol)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nxt[state].get(symbol)
            if to is None:
                continue
            state = to
            matched += 1
            if matched >= window:
                while length[link[state]] >= window:  # the state of the last ``window`` words: all their occurrences
                    state = link[state]
                    matched = length[state]
                yield i, owner[state]


def _stream(window: int):
    """Cogrouped function: query spans of a (shard, part) and the shard's reference spans -> word spans to remove."""

    def run(queries: pa.Table, reference: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if queries.num_rows and reference.num_rows:
            owners, texts = reference.column("doc_id").to_pylist(), reference.column("words").to_pylist()
            automaton = SuffixAutomaton([(who, text.split()) for who, text in zip(owners, texts, strict=True)])
            for row in range(queries.num_rows):
                doc_id, version, first, text = (queries.column(c)[row].as_py() for c in ("doc_id", "version", "first", "words"))
                begin = end = -1
                for last, owner in automaton.matches(text.split(), window):
                    if owner >= doc_id:
                        continue
                    if last - window + 1 > end:
                        if end >= 0:
                            out.append((doc_id, version, first + begin, first + end))
                        begin = last - window + 1
                    end = last + 1
                if end >= 0:
                    out.append((doc_id, version, first + begin, first + end))
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("doc_id", "version", "from", "to"), columns, strict=True)})

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, version, text[, spans from, to]) -> (doc_id, version, n_words, n_removed, kept_sha256)."""
    for batch in batches:
        cut = batch.num_columns > 3
        n, gone, sha = [], [], []
        for row in range(batch.num_rows):
            raw = batch.column(2)[row].as_buffer()
            words = raw.to_pybytes().split() if raw is not None else []
            kept = words
            if cut:
                away = np.zeros(len(words) + 1, np.int32)
                np.add.at(away, batch.column(3)[row].values.to_numpy(), 1)
                np.add.at(away, batch.column(4)[row].values.to_numpy(), -1)
                kept = [w for w, covered in zip(words, np.cumsum(away[:-1]).tolist(), strict=True) if not covered]
            n.append(len(words))
            gone.append(len(words) - len(kept))
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)],
            names=["doc_id", "version", "n_words", "n_removed", "kept_sha256"],
        )


def repeated_spans(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Word spans [from, to) of candidate documents (``candidates``) that an earlier document holds: doc_id, version, from, to."""
    windows = texts.mapInArrow(_candidate_windows(window), "hash long, doc_id long")
    counted = windows.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    firsts = materialize(counted.groupBy(F.col("first").alias("doc_id")).agg(F.collect_list("hash").alias("hashes")), "substring-firsts")
    total = firsts.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]
    shard = F.pmod("unit", F.lit(max(1, -(-total // SHARD_WINDOWS)))).alias("shard")

    queries = texts.mapInArrow(_span_rows(window, False), _SPAN).select(shard, "doc_id", "version", "first", "words")
    queries = materialize(queries, "substring-queries")
    n_words = F.sum(F.octet_length("words")) / 5  # words of four bytes and a blank
    parts = queries.groupBy("shard").agg(F.ceil(n_words / PART_WORDS).cast("long").alias("parts")).where("parts > 0")
    parts = materialize(parts, "substring-parts")
    dealt = queries.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("doc_id", "first"), "parts")).drop("parts")
    reference = texts.join(firsts, "doc_id").mapInArrow(_span_rows(window, True), _SPAN).select(shard, "doc_id", "words")
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    reference = reference.join(parts, "shard").select("shard", "doc_id", "words", everywhere)
    return (
        dealt.groupBy("shard", "part").cogroup(reference.groupBy("shard", "part"))
        .applyInArrow(_stream(window), "doc_id long, version long, from long, to long")
    )


def candidates(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents (doc_id, version, text) with a seed that another document has, with those seeds and their units."""
    docs = docs.where("doc_id is not null and text is not null")
    seeds = materialize(docs.select("doc_id", "text").mapInArrow(_document_seeds(window), "seed long, doc_id long, at long"), "substring-seeds")
    home = F.xxhash64(F.col("first"), F.floor(F.col("at") / BLOCK_WORDS))
    shared = (
        seeds.groupBy("seed")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.min_by("at", "doc_id").alias("at"))
        .where("first < last")
        .select("seed", F.when(home == 0, 1).otherwise(home).alias("unit"))
    )
    own = seeds.join(shared, "seed").groupBy("doc_id").agg(F.collect_set(F.struct("seed", "unit")).alias("s"))
    return docs.join(own, "doc_id").select("doc_id", "version", "text", F.col("s.seed").alias("seeds"), F.col("s.unit").alias("units"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document without the words of passages that an earlier one holds: doc_id, n_words, n_removed, kept_sha256.

    Words are runs of bytes other than ASCII white space, as they are; windows are
    judged on the input. kept_sha256 is over the kept words joined by one blank.

    Defined cases: a null text has no words; a null id comes before and after nothing, so such a row
    loses no words and costs no other row any; rows that share an id are one document as an owner
    (they never cost each other words) and each give a row; texts of any length are taken whole; extra
    columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    text = F.col("text").cast("binary")
    slim = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string")).select("doc_id", F.xxhash64("text").alias("version"), "text")
    result = "doc_id long, version long, n_words long, n_removed long, kept_sha256 string"
    with small_batches(docs.sparkSession):
        whole = materialize(slim.withColumn("text", text).mapInArrow(_digests, result), "substring-digests")
        texts = materialize(candidates(slim, window).withColumn("text", text), "substring-texts")
        spans = repeated_spans(texts, window).groupBy("doc_id", "version").agg(F.collect_list("from").alias("from"), F.collect_list("to").alias("to"))
        changed = texts.join(spans, ["doc_id", "version"]).select("doc_id", "version", "text", "from", "to").mapInArrow(_digests, result)
        changed = materialize(changed.dropDuplicates(["doc_id", "version"]), "substring-changed")
    left = changed.select("doc_id", "version", F.col("n_removed").alias("gone"), F.col("kept_sha256").alias("kept"))
    return whole.join(left, ["doc_id", "version"], "left").select(
        "doc_id", "n_words", F.coalesce("gone", "n_removed").alias("n_removed"), F.coalesce("kept", "kept_sha256").alias("kept_sha256")
    )
