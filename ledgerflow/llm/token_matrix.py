"""Packed token-id matrices: best-fit-decreasing with a segment-tree search.

Documents longer than a sequence are split at its capacity, losslessly. The
rest goes, longest first, to the open sequence with the least remaining
capacity that still holds it; a new one is opened when none does. The search is
a segment tree over remaining capacities: each leaf keeps the open sequences with
that much room, each inner node whether any leaf below it is in use. Rows are full id
matrices (one row a sequence) with cumulative segment lengths and positions that
restart with every segment.

As in ``packing``, a task packs its own rows in bounded blocks during one scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ledgerflow.llm import kernels as K
from ledgerflow.llm.common import ship, text_and_id
from ledgerflow.llm.tokens import encoder, resolve

SCHEMA = (
    "sequence_id long, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<long>, doc_starts array<long>"
)
OUT_BYTES = 1 << 22


class RoomTree:
    """Open sequences by remaining capacity 0..capacity, searched for the least that is enough."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.used = bytearray(2 * self.size)
        self.at: dict[int, list[int]] = {}

    def put(self, room: int, sequence: int) -> None:
        self.at.setdefault(room, []).append(sequence)
        i = room + self.size
        while i and not self.used[i]:
            self.used[i] = 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) of an open sequence with the least room >= need, removed; None if none has it."""
        i, used = need + self.size, self.used
        while not used[i]:
            while i & 1:  # a right child: nothing larger below this parent
                i >>= 1
            if not i:
                return None
            i += 1
            if i & (i - 1) == 0:  # past the last node of its level
                return None
        while i < self.size:
            i = 2 * i if used[2 * i] else 2 * i + 1
        room = i - self.size
        here = self.at[room]
        sequence = here.pop()
        if not here:
            used[i] = 0
            while i > 1 and not used[i ^ 1]:
                i >>= 1
                used[i] = 0
        return room, sequence


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences as lists of pieces, by best fit over descending lengths (each 1..capacity)."""
    tree, out = RoomTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        if found is None:
            room, s = capacity, len(out)
            out.append([])
        else:
            room, s = found
        out[s].append(i)
        if room > lengths[i]:
            tree.put(room - lengths[i], s)
    return out


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), values)


def _matrix_column(matrix: np.ndarray) -> pa.Array:
    """One binary value a row, over the matrix as it lies in memory."""
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix[0].nbytes
    return pa.BinaryArray.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(matrix)])


class _Rows:
    """Sequences on their way out: pieces are only listed, and written into one matrix when a batch of rows is full."""

    def __init__(self, capacity: int, kind: str, pad_id: int) -> None:
        self.capacity, self.kind, self.pad = capacity, np.dtype(kind), pad_id
        self.clear()

    def clear(self) -> None:
        self.seq, self.counts = [], []
        self.docs, self.starts, self.ids = [], [], []

    def add(self, seq: int, pieces: list[tuple]) -> None:
        """pieces: (doc, start, ids as little-endian uint32)."""
        self.seq.append(seq)
        self.counts.append(len(pieces))
        for doc, start, ids in pieces:
            self.docs.append(doc)
            self.starts.append(start)
            self.ids.append(ids)

    def full(self) -> bool:
        return len(self.seq) * self.capacity * 4 >= OUT_BYTES

    def take(self) -> pa.RecordBatch:
        n, counts = len(self.seq), np.array(self.counts)
        sizes = np.array([len(x) // 4 for x in self.ids])
        first = np.cumsum(counts) - counts  # each row's first piece
        begin = np.cumsum(sizes) - sizes  # of each piece, in all ids of the batch
        row = np.repeat(np.arange(n), counts)
        inside = begin - begin[first][row]  # of each piece, in its row
        at = np.arange(sizes.sum())
        place = at + np.repeat(row * self.capacity + inside - begin, sizes)
        ids = np.full((n, self.capacity), self.pad, self.kind)
        ids.ravel()[place] = np.frombuffer(b"".join(self.ids), "<u4")
        positions = np.zeros((n, self.capacity), "<u2" if self.capacity <= 65536 else "<u4")
        positions.ravel()[place] = at - np.repeat(begin, sizes)
        ends = np.zeros(n + len(sizes), np.int32)  # a row has a 0 and the end of each piece
        ends[np.arange(len(sizes)) + row + 1] = inside + sizes
        used = np.add.reduceat(sizes, first)
        columns = {
            "sequence_id": pa.array(self.seq, pa.int64()),
            "n_tokens": pa.array(used, pa.int32()),
            "input_ids": _matrix_column(ids),
            "position_ids": _matrix_column(positions),
            "cu_seqlens": _lists(counts + 1, pa.array(ends)),
            "doc_ids": _lists(counts, pa.array(self.docs, pa.int64())),
            "doc_starts": _lists(counts, pa.array(self.starts, pa.int64())),
        }
        self.clear()
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _pack(path: str, capacity: int, final_id: int | None, pad_id: int, block_tokens: int):
    tail = b"" if final_id is None else np.array([final_id], "<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        rows = _Rows(capacity, id_type(enc.vocab_size, pad_id, final_id), pad_id)
        context = TaskContext.get()
        seq = (context.partitionId() if context else 0) << 40
        block: list[tuple] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal seq, held
            for members in best_fit([len(p[2]) // 4 for p in block], capacity):
                rows.add(seq, [block[i] for i in members])
                seq += 1
                if rows.full():
                    yield rows.take()
            block.clear()
            held = 0

        for batch in batches:
            data, offs = K.text_buffers(batch.column("text"))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), enc.texts(data, offs), strict=True):
                ids += tail
                whole = len(ids) - len(ids) % width
                for at in range(0, whole, width):
                    rows.add(seq, [(doc, at // 4, ids[at : at + width])])
                    seq += 1
                    if rows.full():
                        yield rows.take()
                if whole < len(ids):
                    block.append((doc, whole // 4, ids[whole:]))
                    held += (len(ids) - whole) // 4
                    if held >= block_tokens:
                        yield from flush()
        yield from flush()
        if rows.seq:
            yield rows.take()

    return run


def id_type(vocab_size: int, pad_id: int = 0, final_id: int | None = None) -> str:
    """Little-endian unsigned type of a matrix's ids: two bytes while they suffice."""
    return "<u2" if max(vocab_size - 1, pad_id, final_id or 0) < 1 << 16 else "<u4"


def pack_matrices(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    capacity: int = 2048,
    final_id: int | None = 1,
    pad_id: int = 0,
    block_tokens: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack every document into rows of a token-id matrix; one row a sequence.

    sequence_id; n_tokens without padding; input_ids (``capacity`` ids, little-endian,
    ``id_type`` wide, padded with ``pad_id``); position_ids (little-endian, two bytes up to a capacity
    of 65,536; from 0 in each segment, 0 in the padding); cu_seqlens (0 and each segment's end);
    doc_ids and doc_starts (a segment's document, and that document's ids before the segment).

    Defined cases: a null or empty text is the final id alone (without one, it is
    in no sequence); repeated rows are packed as often as they occur; ids may be
    null; extra columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    return text_and_id(docs, id_col, text_col).mapInArrow(_pack(resolve(tokenizer), capacity, final_id, pad_id, block_tokens), SCHEMA)


def write_matrices(packed: DataFrame, path: str) -> None:
    """Write the packed rows as Parquet, as they lie in the tasks (no shuffle)."""
    packed.write.mode("errorifexists").parquet(path)
