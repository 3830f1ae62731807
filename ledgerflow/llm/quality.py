"""Quality classifier by co-training a text view and a metadata view.

Two logistic classifiers see different sides of a document: its content (hashed
byte n-grams of the whole text) and its page metadata (source, language tag,
length). Both start from labelled documents. In every round each view labels the
unlabelled documents it is most sure of and hands these pseudo-labels to the other
view for its next fit. At the end each view is calibrated on labelled documents it has
not been fitted on, and the calibrated views are combined into one probability for every document.

Fitting uses a bounded sample: at most ``MAX_LABELLED`` labelled rows and about ``POOL``
unlabelled ones, picked by a hash of the id over the whole table. Scoring covers all
rows and whole texts in one scan.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm import kernels as K
from ledgerflow.llm.common import filter_rows, pick, position, ship

#: Most labelled rows that a fit uses, and about how many unlabelled ones.
MAX_LABELLED = 3000
POOL = 2000
ROUNDS = 3
#: A view hands on labels for at most this share of the pool a round, and only where it is this sure.
SHARE = 0.1
SURE = 0.95
#: Clean labelled documents that the threshold must keep, and its ceiling.
KEEP_CLEAN = 0.995
CEILING = 0.3

TEXT_ORDERS = (1, 2, 3)
TEXT_BITS = 14
#: Classes of repetition (distinct share of the n-grams) for each class of length.
REPEAT_BINS = 16
TEXT_DIM = (1 << TEXT_BITS) + 64 * REPEAT_BINS
META_BITS = 12
META = ("source", "lang", "n_chars")


@dataclass
class Sparse:
    """Rows of (column, value) pairs."""

    ends: np.ndarray
    cols: np.ndarray
    vals: np.ndarray

    def dot(self, w: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(w[self.cols] * self.vals)))
        return sums[self.ends[1:]] - sums[self.ends[:-1]]

    def rows(self, at: np.ndarray) -> Sparse:
        size = np.diff(self.ends)[at]
        ends = np.concatenate(([0], np.cumsum(size)))
        pick = np.repeat(self.ends[:-1][at] - ends[:-1], size) + np.arange(ends[-1])
        return Sparse(ends, self.cols[pick], self.vals[pick])


def _stack(parts: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
    ends = np.concatenate(([0], np.cumsum([len(c) for c, _ in parts]))).astype(np.int64)
    if not parts:
        return Sparse(ends, np.zeros(0, np.int64), np.zeros(0))
    return Sparse(ends, np.concatenate([c for c, _ in parts]), np.concatenate([v for _, v in parts]))


def text_features(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a whole text as a unit vector of dampened counts, and how much it repeats itself."""
    at, n = K.gram_counts(raw, TEXT_ORDERS, TEXT_BITS)
    if not len(at):
        return at, n.astype(float)
    v = np.log1p(n)
    spread = int(REPEAT_BINS * min(0.999, np.sqrt(len(at) / n.sum())))
    kind = (1 << TEXT_BITS) + min(int(n.sum()).bit_length(), 63) * REPEAT_BINS + spread
    return np.append(at, kind), np.append(v / np.sqrt((v * v).sum()), 1.0)


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed categories of the metadata: source, language, length class and source with language."""
    size = str(n_chars.bit_length()) if isinstance(n_chars, int) and n_chars >= 0 else ""
    names = (f"s={source}", f"l={lang}", f"n={size}", f"sl={source}|{lang}")
    at = np.array(sorted({crc32(x.encode()) >> (32 - META_BITS) for x in names}), np.int64)
    return at, np.full(len(at), 0.5)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: Sparse, y: np.ndarray, weight: np.ndarray, dim: int, steps: int = 50, rate: float = 0.4, ridge: float = 1e-5) -> np.ndarray:
    """Weights of a logistic regression (the last one is the constant), by Adam on the whole sample."""
    w, m, v = np.zeros(dim + 1), np.zeros(dim + 1), np.zeros(dim + 1)
    row = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(x.ends))
    total = max(weight.sum(), 1e-9)
    for t in range(1, steps + 1):
        r = weight * (_sigmoid(x.dot(w[:-1]) + w[-1]) - y) / total
        g = np.append(np.bincount(x.cols, x.vals * r[row], minlength=dim), r.sum()) + ridge * w
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def _platt(logits: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Calibration (weights and constant) of the columns of ``logits`` by a few damped Newton steps."""
    scale = max(float(np.abs(logits).max(initial=0)), 1e-6)
    x = np.column_stack([logits / scale, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = _sigmoid(x @ w)
        g = x.T @ (p - y) + 1e-2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    w[:-1] /= scale
    return w


@dataclass
class QualityModel:
    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    both: np.ndarray
    threshold: float

    def score(self, text: Sparse, meta: Sparse) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated logits of both views, and the combined probability of good quality."""
        a = (text.dot(self.text[:-1]) + self.text[-1]) * self.text_scale[0] + self.text_scale[1]
        b = (meta.dot(self.meta[:-1]) + self.meta[-1]) * self.meta_scale[0] + self.meta_scale[1]
        return a, b, _sigmoid(np.column_stack([a, b]) @ self.both[:-1] + self.both[-1])


def co_train(text: Sparse, meta: Sparse, label: np.ndarray, fold: np.ndarray, rounds: int = ROUNDS) -> QualityModel | None:
    """Fit from rows with label 1, 0 or -1 (unlabelled); labelled rows of fold 0 only calibrate.

    None if a class is missing among the rows to fit or to calibrate on.
    """
    fit, held, pool = np.flatnonzero((label >= 0) & (fold > 0)), np.flatnonzero((label >= 0) & (fold == 0)), np.flatnonzero(label < 0)
    if len(set(label[fit])) < 2 or len(set(label[held])) < 2:
        return None
    dims = {"text": TEXT_DIM, "meta": 1 << META_BITS}
    views = {"text": text, "meta": meta}
    given: dict[str, dict[int, int]] = {"text": {}, "meta": {}}  # pseudo-labels each view has been handed
    good = label[fit].mean()

    def train(view: str) -> np.ndarray:
        at = np.concatenate([fit, np.fromiter(given[view], np.int64, len(given[view]))])
        y = np.concatenate([label[fit], np.fromiter(given[view].values(), np.int64, len(given[view]))])
        weight = np.concatenate([np.ones(len(fit)), np.full(len(given[view]), 0.5)])
        return fit_logistic(views[view].rows(at), y, weight, dims[view])

    def hand_on(view: str, other: str) -> None:
        z = views[view].rows(pool).dot(models[view][:-1]) + models[view][-1]
        scale = _platt((views[view].rows(fit).dot(models[view][:-1]) + models[view][-1])[:, None], label[fit])
        p = _sigmoid(z * scale[0] + scale[1])
        most = int(SHARE * len(pool))
        for y, sure, room in ((1, p, most * good), (0, 1 - p, most * (1 - good))):
            order = np.argsort(-sure, kind="stable")
            new = [int(pool[i]) for i in order if sure[i] >= SURE and int(pool[i]) not in given[other]]
            given[other].update(dict.fromkeys(new[: int(room) + 1], y))

    models = {v: train(v) for v in views}
    for _ in range(rounds if len(pool) else 0):
        hand_on("text", "meta")
        hand_on("meta", "text")
        models = {v: train(v) for v in views}
    logits = {v: views[v].rows(held).dot(models[v][:-1]) + models[v][-1] for v in views}
    scale = {v: _platt(logits[v][:, None], label[held]) for v in views}
    calibrated = np.column_stack([logits[v] * scale[v][0] + scale[v][1] for v in ("text", "meta")])
    both = _platt(calibrated, label[held])
    p = _sigmoid(calibrated @ both[:-1] + both[-1])
    clean = np.sort(p[label[held] == 1])
    threshold = min(CEILING, float(clean[int((1 - KEEP_CLEAN) * len(clean))]))
    return QualityModel(models["text"], models["meta"], scale["text"], scale["meta"], both, threshold)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and the metadata columns (null where the input has none, or a length that is no whole number)."""
    kinds = {f.name.lower(): f.dataType for f in docs.schema.fields}
    usable = {c for c in META if c in kinds and (c != "n_chars" or isinstance(kinds[c], T.IntegralType))}
    cols = {"doc_id": (id_col, "long"), "text": (text_col, "string")}
    cols |= {c: (c, "long" if c == "n_chars" else "string") for c in META if c in usable}
    out = pick(docs, **cols)
    for c in META:
        if c not in usable:
            out = out.withColumn(c, F.lit(None).cast("long" if c == "n_chars" else "string"))
    return out.select("doc_id", "text", *META)


def _features(batch: pa.RecordBatch, text: int, meta: tuple[int | None, ...]) -> Iterator[tuple[int, int, Sparse, Sparse]]:
    data, offs = K.text_buffers(batch.column(text))
    cols = [batch.column(i).to_pylist() if i is not None else [None] * batch.num_rows for i in meta]
    for lo in range(0, batch.num_rows, 512):
        hi = min(lo + 512, batch.num_rows)
        yield (
            lo,
            hi,
            _stack([text_features(data[offs[i] : offs[i + 1]]) for i in range(lo, hi)]),
            _stack([meta_features(*(c[i] for c in cols)) for i in range(lo, hi)]),
        )


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label, fold = batch.column("label").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy(zero_copy_only=False)
        at = {c: batch.schema.get_field_index(c) for c in ("text", *META)}
        for lo, hi, text, meta in _features(batch, at["text"], tuple(at[c] for c in META)):
            cells = [
                [s.cols[a:b].astype("<i4").tobytes() + s.vals[a:b].astype("<f4").tobytes() for a, b in zip(s.ends[:-1], s.ends[1:], strict=True)]
                for s in (text, meta)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(label[lo:hi], pa.int32()), pa.array(fold[lo:hi], pa.int32()), *[pa.array(c, pa.binary()) for c in cells]],
                names=["label", "fold", "text", "meta"],
            )


def _unpack(cells: list[pa.Array]) -> Sparse:
    """The packed rows as one matrix, without a Python object for each number."""
    flat = [c for part in cells for c in part]
    size = np.array([len(c.as_buffer()) // 8 for c in flat], np.int64)
    ends = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    cols, vals = np.empty(ends[-1], np.int32), np.empty(ends[-1], np.float32)
    for c, a, b in zip(flat, ends[:-1], ends[1:], strict=True):
        raw = np.frombuffer(c.as_buffer(), np.uint8)
        cols[a:b] = raw[: 4 * (b - a)].view("<i4")
        vals[a:b] = raw[4 * (b - a) :].view("<f4")
    return Sparse(ends, cols, vals)


def _co_train_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task over the whole (bounded) sample: the fitted model as one pickled row."""
    kept = list(batches)
    if not kept:
        return
    label, fold = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in kept]) for c in ("label", "fold"))
    # by content, so that the fit does not depend on the order in which the rows arrive
    key = [(c.as_py(), a, b) for k in kept for c, a, b in zip(k.column("text"), k.column("label").to_pylist(), k.column("fold").to_pylist(), strict=True)]
    order = np.array(sorted(range(len(key)), key=key.__getitem__))
    text, meta = (_unpack([b.column(c) for b in kept]).rows(order) for c in ("text", "meta"))
    model = co_train(text, meta, label[order], fold[order])
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel | None:
    """Co-train on the labelled documents and a pool of unlabelled ones; None without both classes.

    An id labelled both ways, a null id or a null label is no label.
    """
    ship(docs.sparkSession)
    rows = _rows(docs, id_col, text_col)
    known = (
        pick(labels, doc_id=(id_col, "long"), label=(label_col, "int"))
        .where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("high"))
        .where("label = high")
        .select("doc_id", "label")
    )
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    # the pool is picked by id (a row without one by its text), out of all that differ in it
    who = F.coalesce(F.xxhash64("doc_id", F.lit(4)), F.lit(0))
    who = F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.lit(4))).otherwise(who)
    different = rows.select(F.count_distinct(who)).first()[0]
    part = F.pmod(who, F.lit(1 << 24)) < int((1 << 24) * min(1.0, POOL / max(different, 1)))
    sample = rows.join(F.broadcast(ids), "doc_id", "left").where(F.col("label").isNotNull() | part)
    sample = sample.withColumn("unlabelled", F.col("label").isNull())
    # an unlabelled row whose id is labelled beyond the sample is as good for the pool as any other
    sample = sample.withColumn("label", F.coalesce("label", F.lit(-1))).withColumn("fold", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)).cast("int"))
    sample = sample.withColumn("fold", F.coalesce("fold", F.lit(1)))
    # repeated rows once; should ids have many texts, the bound takes the same rows in whatever order they lie
    columns = ["doc_id", "label", "fold", "text", *META]
    order = [F.xxhash64("doc_id", "text"), *[F.col(c) for c in columns]]
    sample = sample.select(*columns).distinct().orderBy(*order).limit(2 * (MAX_LABELLED + POOL))
    features = sample.select("label", "fold", "text", *META).mapInArrow(_sample_features, "label int, fold int, text binary, meta binary")
    fitted = features.repartition(1).mapInArrow(_co_train_sample, "model binary").collect()
    return pickle.loads(fitted[0].model) if fitted else None


def score(docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_logit, meta_logit, quality (probability of good quality) and keep of every row.

    Defined cases: null and empty texts have no n-grams and are scored by the constant and their
    metadata; null metadata is a category of its own; without a model (no labels, or one class only)
    the logits are null, quality is 1 and every row is kept; repeated rows and null ids come out as they went
    in; extra columns are ignored; a very long text is counted slice by slice.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for lo, hi, text, meta in _features(batch, 1, (2, 3, 4)):
                n = hi - lo
                a, b, p = m.score(text, meta) if m else (np.full(n, np.nan), np.full(n, np.nan), np.ones(n))
                keep = p >= m.threshold if m else np.ones(n, bool)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), *[pa.array(x, from_pandas=True) for x in (a, b)], pa.array(p), pa.array(keep)],
                    names=["doc_id", "text_logit", "meta_logit", "quality", "keep"],
                )

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_logit double, meta_logit double, quality double, keep boolean")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Co-train and score all documents."""
    return score(docs, train(docs, labels, id_col, text_col), id_col, text_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows (all columns) that the classifier does not reject.

    Defined cases as in ``score``: null and empty texts are judged by the constant and their metadata, null ids and
    repeated rows like any other, very long texts whole; without a model all rows stay;
    other columns, also with clashing names, come back as they are; an empty table stays empty.
    """
    model = train(docs, labels, id_col, text_col)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c.lower() for c in docs.columns]
    text = position(docs, text_col)
    meta = tuple(names.index(c) if c in names else None for c in META)

    def keep(batch: pa.RecordBatch) -> np.ndarray:
        m = shared.value
        parts = [m.score(t, x)[2] >= m.threshold for _, _, t, x in _features(batch, text, meta)]
        return np.concatenate(parts) if parts else np.zeros(0, bool)

    return filter_rows(docs, keep)
