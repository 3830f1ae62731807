"""Minimax contiguous sharding: the smallest largest shard over ordered atomic groups.

Rows with equal texts are one atomic group. Groups are ordered by a hash of
their text and cut into ``shards`` contiguous runs whose largest size is as small as
possible: a binary search over the shard capacity, each candidate checked greedily (fill
a shard until the next group would not fit), then cut at the capacity found.

The groups never come to the driver. Spark sums the sizes of *cells* (runs of hash
values), and the greedy check over cells brackets the answer: taking cells of several
groups as divisible gives a lower bound, taking them as whole an upper one. Only
cells in which a cut can still fall are split further, until they hold one
group each; then both bounds meet and the search is exact. A round brings at most
about ``MAX_SUMS`` sums to the driver, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize, text_and_id

#: Hash bits in use, and those that number the cells of the first round.
KEY_BITS = 63
FIRST_BITS = 16
#: Cell sums of one round.
MAX_SUMS = 1 << 19
#: Slots are numbered inside small parts of a shard: a hash prefix and a salt of the row, which spreads a group of copies.
SLOT_PREFIX_BITS = 10
SLOT_SALTS = 256


class _Cells:
    """Ordered cells: total size, largest group, and whether there are several groups."""

    def __init__(self, sizes: np.ndarray, largest: np.ndarray, several: np.ndarray) -> None:
        self.sizes, self.largest, self.several = sizes, largest, several
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        self.total = int(self.ends[-1])

    def fits(self, capacity: int, shards: int, divisible: bool = False, at: int = 0) -> bool:
        for _ in range(shards):
            at = self._next(at, capacity, divisible)
            if at >= self.total:
                return True
        return at >= self.total

    def _next(self, at: int, capacity: int, divisible: bool) -> int:
        reach = at + capacity
        if reach >= self.total:
            return self.total
        i = int(np.searchsorted(self.ends, reach, side="right")) - 1
        if self.ends[i] != reach and divisible and self.several[i]:
            return reach
        return int(self.ends[i]) if self.ends[i] > at else at

    def smallest(self, shards: int, divisible: bool) -> int:
        """Binary search of the smallest capacity that passes the greedy check."""
        lo, hi = max(-(-self.total // shards), int(self.largest.max())), self.total
        while lo < hi:
            mid = (lo + hi) // 2
            if self.fits(mid, shards, divisible):
                hi = mid
            else:
                lo = mid + 1
        return lo

    def undecided(self, low: int, high: int, shards: int) -> np.ndarray:
        """Cells of several groups in which a cut for a capacity in low..high can fall."""
        early = late = 0
        found = np.zeros(len(self.sizes), bool)
        for _ in range(shards):
            reach = min(early + low, self.total)
            i = min(int(np.searchsorted(self.ends, reach, side="right")) - 1, len(self.sizes) - 1)
            early = max(int(self.ends[i]), reach - int(self.largest[i]))
            late = min(late + high, self.total)
            a = int(np.searchsorted(self.ends, early, side="right")) - 1
            found[a : int(np.searchsorted(self.ends, late))] = True
        return np.flatnonzero(found & self.several)

    def cuts(self, capacity: int, shards: int) -> list[int]:
        """Indices of the cells at which the second and later shards begin.

        No shard exceeds the capacity. Within that, a shard ends next to an equal share of
        what is left, as long as the greedy check still succeeds behind it; so the slack
        is spread and not left to the last shard.
        """
        at, out = 0, []
        for left in range(shards, 1, -1):
            share = at + (self.total - at) / left
            i = int(np.searchsorted(self.ends, share))
            for j in (i, i - 1) if i and self.ends[min(i, len(self.ends) - 1)] - share < share - self.ends[i - 1] else (i - 1, i):
                end = int(self.ends[min(j, len(self.ends) - 1)])
                if at < end <= at + capacity and self.fits(capacity, left - 1, at=end):
                    break
            else:
                end = self._next(at, capacity, False)
            at = end
            if at >= self.total:
                break
            out.append(int(np.searchsorted(self.ends, at)))
        return out


def cut_keys(rows: DataFrame, shards: int) -> list[int]:
    """Keys at which the second and later shards begin.

    ``rows`` has key (the group's hash, 0 to 2**63 - 1) and size. With fewer groups than
    shards fewer keys come back; the last shards stay empty.
    """
    spark = rows.sparkSession
    groups = materialize(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")

    def cells(some: DataFrame, bits: int) -> dict[int, tuple[int, int, int, int]]:
        at = F.shiftright("key", KEY_BITS - bits)
        sums = some.groupBy(at.alias("cell")).agg(F.sum("size"), F.max("size"), F.min("key"), F.max("key"))
        return {r[0] << (KEY_BITS - bits): tuple(r[1:]) for r in sums.collect()}

    bits = FIRST_BITS
    have = cells(groups, bits)
    while have:
        order = sorted(have)
        size, largest, first, last = (np.array(x, np.int64) for x in zip(*[have[c] for c in order], strict=True))
        now = _Cells(size, largest, first != last)
        low, high = now.smallest(shards, divisible=True), now.smallest(shards, divisible=False)
        split = now.undecided(low, high, shards)
        if not len(split):
            return [int(first[i]) for i in now.cuts(high, shards)]
        ranges = [(int(first[i]), int(last[i])) for i in split]
        more = max(1, int(np.log2(MAX_SUMS / len(split))))
        deeper = min(KEY_BITS, bits + min(more, 12))
        # at most MAX_SUMS ranges; every range lies in one cell of the first round
        first_cell = KEY_BITS - FIRST_BITS
        parents = spark.createDataFrame([(a >> first_cell, a, b) for a, b in ranges], "parent long, a long, b long")
        inside = groups.join(F.broadcast(parents), F.shiftright("key", first_cell) == F.col("parent")).where("key between a and b")
        for i in split:
            del have[order[i]]
        have |= cells(inside.select("key", "size"), deeper)
        bits = deeper
    return []


def shard_documents(docs: DataFrame, shards: int = 40, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every row into one of ``shards`` shards, equal texts together, the largest shard as small as possible.

    Returns doc_id, size (UTF-8 bytes of the text plus ``overhead``), text_crc32 (unsigned),
    law (``bytes``), shard, slot (gapless from 0 within the shard) and grown_shard (null: the cuts
    depend on all sizes, not on an id and a shard count).

    Defined cases: null texts are one group of size ``overhead`` each, with the checksum of no
    bytes (0), apart from empty texts; repeated rows and null ids are placed like any
    other row; extra columns are ignored; an empty table gives no rows.
    """
    base = text_and_id(docs, id_col, text_col)
    rows = materialize(
        base.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
            F.xxhash64("text").bitwiseAND(F.lit((1 << KEY_BITS) - 1)).alias("key"),
        ),
        "rows",
    )
    cuts = cut_keys(rows, shards)
    starts = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    placed = rows.withColumn("shard", F.size(F.filter(starts, lambda c: c <= F.col("key"))))
    placed = placed.withColumn("part", F.shiftright("key", KEY_BITS - SLOT_PREFIX_BITS)).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOT_SALTS)).cast("int")
    )
    # at most (2**SLOT_PREFIX_BITS + shards) * SLOT_SALTS counts, whatever the number of rows
    counts = placed.groupBy("shard", "part", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part", "salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "part", "salt").orderBy("key", "doc_id", "text_crc32", "size")
    return (
        placed.withColumn("rn", F.row_number().over(inside))
        .join(offsets, ["shard", "part", "salt"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("offset") + F.col("rn") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
