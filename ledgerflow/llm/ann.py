"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``TABLES`` tables hashes a vector to the cell of M quantised Gaussian
projections. A query visits, in every table, its own bucket and then the perturbed
buckets in order of estimated success: a perturbation set costs the squared distances from
the query's projections to the cell borders it crosses, and a heap yields the sets by rising cost.
Candidates of all tables are merged and ranked by their exact distance.

Width, M and the number of probes are fitted on a bounded sample (``FIT_ROWS`` rows): the
width from its distances, M from the number of vectors, and the least number of
probes that reaches ``TARGET`` recall against brute force on the sample. If none does, M is
lowered, and at two projections the cells are widened until one does. All rows are indexed.

Buckets and queries meet in *search cells* (hashes of bucket keys). A bucket
with more than ``BUCKET_ROWS`` rows, or visited by more than ``BUCKET_QUERIES`` queries, is cut into
a grid of blocks, so no task gets a hot bucket whole. A cell keeps only the k
nearest candidates of each of its queries. Queries that end up with fewer than k candidates are
searched exactly, in blocks over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm import kernels as K
from ledgerflow.llm.common import materialize, pick, ship

TABLES = 4
#: Rows and sample queries of the fit, and the most numbers its sample may hold.
FIT_ROWS, FIT_QUERIES, FIT_VALUES = 4096, 128, 1 << 22
TARGET = 0.97
MAX_PROBES = 512
BUCKET_ROWS, BUCKET_QUERIES = 1 << 14, 1 << 14
#: Index rows of a search cell, on average.
CELL_ROWS = 1 << 16
#: Survivors that a task keeps before it reduces them to each query's k nearest.
BUFFER = 1 << 18


@dataclass(frozen=True)
class Hashing:
    """Projections (tables x dim x M), offsets and width of the tables, and the probes to visit in each."""

    lines: np.ndarray
    shift: np.ndarray
    width: float
    probes: int

    def project(self, x: np.ndarray, table: int) -> np.ndarray:
        return x @ self.lines[table] / self.width + self.shift[table]

    def keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        """64-bit bucket keys of rows of quantised projections."""
        h = np.full(len(cells), np.uint64(table + 1))
        for m in range(cells.shape[1]):
            h = K.mix(h * np.uint64(0x9E3779B97F4A7C15) + cells[:, m].astype(np.int64).view(np.uint64))
        return h.view(np.int64)

    def index_keys(self, x: np.ndarray) -> np.ndarray:
        """Bucket keys (rows x tables)."""
        return np.column_stack([self.keys(np.floor(self.project(x, t)), t) for t in range(len(self.lines))])

    def probe_keys(self, q: np.ndarray, table: int, probes: int) -> np.ndarray:
        """Keys of the buckets that one query visits in a table, most promising first."""
        p = self.project(q[None, :], table)[0]
        home = np.floor(p)
        cells = np.tile(home, (probes, 1))
        n = 0
        for moves in perturbations(p - home, probes):
            for m, d in moves:
                cells[n, m] += d
            n += 1
        return self.keys(cells[:n], table)


def perturbations(inside: np.ndarray, most: int) -> Iterator[list[tuple[int, int]]]:
    """Perturbation sets [(projection, -1 or 1), ...] by rising cost, the empty set first.

    ``inside`` is the position within the home cell, 0 to 1, of each projection.
    """
    yield []
    m = len(inside)
    cost = np.concatenate([inside**2, (1 - inside) ** 2])
    order = np.argsort(cost, kind="stable")
    rank = cost[order].tolist()
    move = [(int(i) % m, -1 if i < m else 1) for i in order]
    heap = [(rank[0], (0,))]
    found = 1
    while heap and found < most:
        total, chosen = heappop(heap)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heappush(heap, (total - rank[last] + rank[last + 1], (*chosen[:-1], last + 1)))  # exchange the last border for the next
            heappush(heap, (total + rank[last + 1], (*chosen, last + 1)))  # cross the next border as well
        moves = [move[i] for i in chosen]
        if len({p for p, _ in moves}) == len(moves):  # never both borders of one projection
            found += 1
            yield moves


def _neighbours(d: np.ndarray, ids: np.ndarray, k: int) -> list[list[int]]:
    """For each row of distances the sample rows of its k nearest other ids, each id by its nearest row."""
    near = []
    for i, row in enumerate(np.argsort(d, axis=1, kind="stable")):
        chosen: dict[int, int] = {}
        for j in row.tolist():
            if ids[j] != ids[i] and ids[j] not in chosen:
                chosen[ids[j]] = j
                if len(chosen) == k:
                    break
        near.append(list(chosen.values()))
    return near


def fit(sample: np.ndarray, rows: int, k: int, ids: np.ndarray | None = None, seed: int = 8) -> Hashing:
    """Choose width, projections and probes for the vectors of ``rows`` ids like those of the sample (``ids``: whose they are)."""
    rng = np.random.default_rng(seed)
    n, dim = sample.shape
    some = sample[: min(n, FIT_QUERIES)]
    d = np.sqrt(np.maximum((some**2).sum(1)[:, None] + (sample**2).sum(1) - 2 * some @ sample.T, 0))
    positive = d[d > 1e-9]
    width = 1.06 * float(np.median(positive)) if len(positive) else 1.0
    near = _neighbours(d, np.arange(n) if ids is None else ids, k)
    m = int(np.clip(round(np.log2(max(rows, 2)) / 2.6), 2, 16))
    while True:
        tables = Hashing(rng.normal(size=(TABLES, dim, m)), rng.uniform(size=(TABLES, m)), width, MAX_PROBES)
        keys = tables.index_keys(sample)
        rank = []
        for i, js in enumerate(near):
            seen = [{key: r for r, key in reversed(list(enumerate(tables.probe_keys(sample[i], t, MAX_PROBES).tolist())))} for t in range(TABLES)]
            rank += [min(seen[t].get(int(keys[j, t]), MAX_PROBES) for t in range(TABLES)) for j in js]
        need = np.sort(rank)[max(0, int(np.ceil(TARGET * len(rank))) - 1)] + 1 if rank else 1
        if need <= MAX_PROBES or not np.isfinite(width):
            return Hashing(tables.lines, tables.shift, width, int(min(need, MAX_PROBES)))
        if m > 2:
            m -= 1
        else:
            width *= 2  # in the end all of a table's rows are in reach


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _index(shared, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = shared.value.index_keys(_matrix(batch.column("vec"), dim))
            for t in range(keys.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, t]), batch.column("id"), batch.column("vec")], names=["key", "id", "vec"])

    return run


def _index_keys(shared, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = shared.value.index_keys(_matrix(batch.column("vec"), dim))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel())], names=["key"])

    return run


def _probes(shared, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(queries))], names=["key", "query"])

        h = shared.value
        for batch in batches:
            keys, queries = [], []
            for query, q in zip(batch.column("query").to_pylist(), _matrix(batch.column("vec"), dim), strict=True):
                keys.append(np.unique(np.concatenate([h.probe_keys(q, t, h.probes) for t in range(len(h.lines))])))
                queries.append(np.full(len(keys[-1]), query))
                if sum(map(len, keys)) >= BUFFER:
                    yield out()
                    keys, queries = [], []
            if keys:
                yield out()

    return run


class _Best:
    """The k nearest candidates of each query of a cell."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, k: int) -> None:
        self.q, self.ids, self.k = queries, ids, k
        self.norm = (queries**2).sum(1)
        self.worst = np.full(len(ids), np.inf)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def offer(self, at: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Candidates ``rows`` for the queries at positions ``at``."""
        for lo in range(0, len(rows), 2048):
            for qlo in range(0, len(at), 512):
                self._block(at[qlo : qlo + 512], ids[lo : lo + 2048], rows[lo : lo + 2048])

    def _block(self, at: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        norm = (rows**2).sum(1)
        rough = self.norm[at][:, None] + norm - 2 * self.q[at] @ rows.T
        slack = 1e-9 * (self.norm[at][:, None] + norm)
        a, b = np.nonzero((rough <= self.worst[at][:, None] + slack) & (self.ids[at][:, None] != ids))
        if len(a):
            for lo in range(0, len(a), 1 << 16):
                i, j = at[a[lo : lo + (1 << 16)]], b[lo : lo + (1 << 16)]
                exact = ((self.q[i] - rows[j]) ** 2).sum(1)
                self.held.append((i, ids[j], exact))
                self.n += len(i)
                if self.n > BUFFER:
                    self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0)
        q, ids, d = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort((d, ids, q))
        q, ids, d = q[order], ids[order], d[order]
        new = np.ones(len(q), bool)  # the nearest of an id: it comes from several tables, or has several vectors
        new[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
        q, ids, d = q[new], ids[new], d[new]
        order = np.lexsort((ids, d, q))
        q, ids, d = q[order], ids[order], d[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        last = place == self.k - 1
        self.worst[q[last]] = d[last]
        self.held = [(q[keep], ids[keep], d[keep])]
        self.n = int(keep.sum())
        return self.held[0]


def _search(dim: int, k: int):
    """mapInArrow over rows sorted by (cell, kind): a cell's queries (kind 0, with the keys they visit), then its index rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts, best, sort, queries = None, [], None, None, None

        def begin() -> None:
            nonlocal best, sort, queries
            ids, vecs, keys, visited = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys, kind="stable")
            sort, queries = keys[order], np.repeat(np.arange(len(ids)), visited)[order]
            best = _Best(vecs, ids, k)

        def finish() -> Iterator[pa.RecordBatch]:
            if best is not None:
                q, ids, d = best.reduce()
                if len(q):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(best.ids[q]), pa.array(ids), pa.array(np.sqrt(d))], names=["query_id", "vec_id", "score"]
                    )

        for batch in batches:
            cells, kind = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero((cells[1:] != cells[:-1]) | (kind[1:] != kind[:-1])) + 1, [len(cells)]))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if cells[a] != cell:
                    yield from finish()
                    cell, parts, best = cells[a], [], None
                some = batch.slice(a, b - a)
                ids, vecs = some.column("id").to_numpy(), _matrix(some.column("vec"), dim)
                keys = some.column("keys")
                flat = keys.flatten().to_numpy()
                if kind[a] == 0:
                    parts.append((ids, vecs, flat, keys.value_lengths().to_numpy()))
                    continue
                if not parts:
                    continue  # no query visits this cell
                if best is None:
                    begin()
                order = np.argsort(flat, kind="stable")
                runs = np.concatenate(([0], np.flatnonzero(np.diff(flat[order])) + 1, [len(order)]))
                for x, y in zip(runs[:-1], runs[1:], strict=True):
                    key = flat[order[x]]
                    lo, hi = np.searchsorted(sort, key), np.searchsorted(sort, key, side="right")
                    if lo < hi:
                        best.offer(queries[lo:hi], ids[order[x:y]], vecs[order[x:y]])
        yield from finish()

    return run


def _meet(probes: DataFrame, index: DataFrame, vectors: DataFrame, cells: int, dim: int, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the nearest candidates of each query in each cell.

    probes: key, part, query; index: key, part, id, vec (a row for each block it is in); vectors: query, id, vec.
    """
    cell = F.pmod(F.xxhash64("key", "part"), F.lit(cells)).cast("int")
    visits = probes.withColumn("cell", cell).groupBy("cell", "query").agg(F.collect_set(F.xxhash64("key", "part")).alias("keys"))
    left = visits.join(vectors, "query").select("cell", F.lit(0).alias("kind"), "id", "vec", "keys")
    right = index.select(cell.alias("cell"), F.lit(1).alias("kind"), "id", "vec", F.array(F.xxhash64("key", "part")).alias("keys"))
    return (
        left.unionAll(right)
        .repartition("cell")
        .sortWithinPartitions("cell", "kind")
        .mapInArrow(_search(dim, k), "query_id long, vec_id long, score double")
    )


def _top(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k nearest vectors (Euclidean) that are found for each query row: query_id, rank, vec_id, score.

    ``is_query`` is a condition on the column ``id``. Candidates are all rows but those with the
    query's own id; with fewer than k candidates all of them come back. score is the distance in
    double precision of the vectors as they are; ties go to the smaller id.

    Defined cases: null ids, null, empty and zero vectors, and vectors with a null, NaN or infinite component take no part;
    vectors of different lengths are no candidates for each other (each length is searched by itself);
    repeated rows count once, in the fit as well, and an id with several vectors, asking or found, counts with the nearest
    pair of them; extra columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema[vec_col].dataType
    element = kind.elementType.simpleString() if isinstance(kind, T.ArrayType) else "double"
    element = "float" if element == "float" else "double"
    good = pick(vectors, id=(id_col, "long"), vec=(vec_col, f"array<{element}>")).where(
        "id is not null and vec is not null and forall(vec, v -> v is not null and not isnan(v) and abs(v) < double('infinity')) and exists(vec, v -> v <> 0)"
    )
    sizes = good.groupBy(F.size("vec").alias("dim")).agg(F.count_distinct("id").alias("ids")).orderBy("dim").collect()  # a row a length
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = [_nearest(good.where(F.size("vec") == dim), is_query, dim, ids, k, element) for dim, ids in sizes]
    if len(found) == 1:
        return found[0]
    every = found[0]
    for part in found[1:]:
        every = every.unionAll(part)
    return _top(every, k)


def _nearest(good: DataFrame, is_query: Column, dim: int, rows: int, k: int, element: str) -> DataFrame:
    """The result for the vectors (id, vec) of one length; ``rows``: how many ids they have."""
    spark = good.sparkSession
    once = good.dropDuplicates(["id", "vec"])
    sample = once.orderBy(F.xxhash64("id"), "id", "vec").limit(min(FIT_ROWS, max(FIT_VALUES // dim, 256))).toArrow()
    hashing = fit(_matrix(sample.column("vec"), dim), rows, k, sample.column("id").to_numpy())
    shared = spark.sparkContext.broadcast(hashing)
    # every vector of an id asks for itself; should two have one hash, both visit what either does
    asked = once.where(is_query).withColumn("query", F.xxhash64("id", "vec"))

    index = good.mapInArrow(_index(shared, dim), f"key long, id long, vec array<{element}>")
    spread = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "query")  # few bytes, much work
    probes = materialize(spread.mapInArrow(_probes(shared, dim), "key long, query long"), "probes")
    filled = good.mapInArrow(_index_keys(shared, dim), "key long").groupBy("key").agg(F.count("*").alias("n"))
    asking = probes.groupBy("key").agg(F.count("*").alias("m"))
    grid = materialize(
        filled.join(asking, "key").select(
            "key", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("across"), F.ceil(F.col("m") / BUCKET_QUERIES).cast("int").alias("down")
        ),
        "grid",
    )
    row, col = F.pmod(F.xxhash64("query"), F.col("down")), F.pmod(F.xxhash64("id"), F.col("across"))
    blocks = probes.join(grid, "key").select(
        "key", "query", F.explode(F.transform(F.sequence(F.lit(0), F.col("across") - 1), lambda c: row * F.col("across") + c)).alias("part")
    )
    placed = index.join(grid, "key").select(
        "key", "id", "vec", F.explode(F.transform(F.sequence(F.lit(0), F.col("down") - 1), lambda r: r * F.col("across") + col)).alias("part")
    )
    cells = max(1, -(-rows * TABLES // CELL_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    best = materialize(_top(_meet(blocks, placed, asked, cells, dim, k), k), "nearest")
    # too few found: an exact search of those queries, in blocks over all rows
    counted = asked.select("id").distinct().join(best.groupBy("query_id").agg(F.count("*").alias("n")).withColumnRenamed("query_id", "id"), "id", "left")
    short = materialize(counted.where(F.coalesce("n", F.lit(0)) < min(k, rows - 1)).select("id"), "short")
    if short.isEmpty():
        return best
    spread = max(1, -(-rows // CELL_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    again = asked.join(short, "id", "left_semi")
    everywhere = again.select(F.lit(0).cast("long").alias("key"), "query", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"))
    all_rows = good.select(F.lit(0).cast("long").alias("key"), "id", "vec", F.pmod(F.xxhash64("id"), F.lit(spread)).cast("int").alias("part"))
    exact = _top(_meet(everywhere, all_rows, again, spread, dim, k), k)
    return best.join(short.withColumnRenamed("id", "query_id"), "query_id", "left_anti").unionAll(exact)
