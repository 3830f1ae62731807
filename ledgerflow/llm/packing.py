"""Cost-balanced packing of documents into token sequences of a fixed capacity.

A piece of ``n`` tokens costs ``linear * n + quadratic * n**2`` (projections grow
with the tokens, attention with their square). Whole capacities of a long document
are sequences of their own; the rest of it, and each short document, is a
piece to be packed. Pieces gather in blocks of about ``block_tokens``; a block gets
the fewest sequences that can hold it, and its pieces go, by descending
cost, to the lowest-cost sequence with remaining capacity for them. A
piece that fits nowhere whole is cut at the lowest-cost sequence that has
room, so only the block's last tokens are padded: under one sequence a block.

Everything happens in one scan: a task tokenizes its rows and packs them
block by block, with memory bounded by the block, whatever the size of a source
or of a group of copies. Nothing is shuffled. A sequence number is
the task's partition number and a count within it, so feed the operator a stored
table (as here) for numbers that repeat from run to run.
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

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Rows handed to Spark hold about this many bytes of ids at a time.
OUT_BYTES = 1 << 22
#: Chunks of one generation of a worker's cache here: packing ends the pipeline, beside the heap of all its stages.
CHUNKS = 100_000


def balance(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Place pieces (each below ``capacity``) in the fewest sequences that hold them all.

    Returns (piece, start, length, sequence, offset): a piece may be cut into several parts.
    """
    total = sum(lengths)
    if not total:
        return []
    n = -(-total // capacity)
    room = np.full(n, capacity, np.int64)
    cost = np.zeros(n)
    out = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start, left = 0, lengths[i]
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            s = int(np.argmin(np.where(fits, cost, np.inf)))
            take = min(left, int(room[s]))
            out.append((i, start, take, s, capacity - int(room[s])))
            room[s] -= take
            cost[s] += linear * take + quadratic * take * take
            start += take
            left -= take
    return out


class _Out:
    """Piece rows on their way to Spark, handed on in bounded batches."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, doc, start: int, ids: bytes, total: int, seq: int, offset: int) -> None:
        self.rows.append((doc, start, len(ids) // 4, ids, total, seq, offset))
        self.bytes += len(ids) + 64

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True))
        self.rows, self.bytes = [], 0
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )


def _pack(path: str, capacity: int, final_id: int | None, linear: float, quadratic: float, block_tokens: int):
    tail = b"" if final_id is None else np.array([final_id], "<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, CHUNKS)
        context = TaskContext.get()
        seq = (context.partitionId() if context else 0) << 40
        out = _Out()
        block: list[tuple] = []  # (doc, start, ids, doc_tokens)
        held = 0

        def flush() -> None:
            nonlocal seq, held
            placed = balance([len(p[2]) // 4 for p in block], capacity, linear, quadratic)
            for i, start, n, s, offset in placed:
                doc, at, ids, total = block[i]
                out.add(doc, at + start, ids[4 * start : 4 * (start + n)], total, seq + s, offset)
            seq += 1 + max((p[3] for p in placed), default=-1)
            block.clear()
            held = 0

        for batch in batches:
            data, offs = K.text_buffers(batch.column("text"))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), enc.texts(data, offs), strict=True):
                ids += tail
                total = len(ids) // 4
                whole = len(ids) - len(ids) % width
                for at in range(0, whole, width):
                    out.add(doc, at // 4, ids[at : at + width], total, seq, 0)
                    seq += 1
                    if out.bytes >= OUT_BYTES:
                        yield out.take()
                if whole < len(ids):
                    block.append((doc, whole // 4, ids[whole:], total))
                    held += (len(ids) - whole) // 4
                    if held >= block_tokens:
                        flush()
                if out.bytes >= OUT_BYTES:
                    yield out.take()
        flush()
        if out.rows:
            yield out.take()
        enc.rest()

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    capacity: int = 2048,
    final_id: int | None = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 6144,
    block_tokens: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack every document; one row a piece.

    doc_id, start (the document's ids before the piece), length, ids (little-endian uint32),
    doc_tokens (with the final id), sequence_id, offset (gapless from 0 in its sequence).
    Each id of a document lies in exactly one piece.

    Defined cases: a null or empty text is the final id alone (without one, no
    row); repeated rows are packed as often as they occur; ids may be null;
    extra columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    run = _pack(resolve(tokenizer), capacity, final_id, linear, quadratic, block_tokens)
    return text_and_id(docs, id_col, text_col).mapInArrow(run, SCHEMA)
