"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training sums n-gram counts per language: every task adds up its own rows and emits one
row a language and filled bucket, and Spark sums those; the model is a (languages x buckets)
matrix of log probabilities, so its size does not depend on the corpus. Scoring
broadcasts the matrix and scores whole texts as sparse count batches in numpy.
Only the text is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import kernels as K
from ledgerflow.llm.common import filter_rows, materialize, pick, position, ship, text_and_id

#: Orders (characters in lower case) and buckets of the n-grams.
ORDERS = (2, 3)
BITS = 14
#: Added to every count.
SMOOTHING = 0.5
#: Answer for texts without a letter.
UNDETERMINED = "und"
#: Languages a model can hold: the only bound on its size (languages * 2**BITS numbers).
MAX_LANGUAGES = 512

_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # buckets x languages, log probabilities
    prior: np.ndarray

    def scores(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Log joint of sparse count rows (buckets, counts) with each language."""
        sizes = np.array([len(b) for b, _ in counts])
        out = np.tile(self.prior, (len(counts), 1))
        full = np.flatnonzero(sizes)
        if len(full):
            at = np.concatenate([counts[i][0] for i in full])
            n = np.concatenate([counts[i][1] for i in full]).astype(np.float64)
            begin = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
            out[full] += np.add.reduceat(self.weights[at] * n[:, None], begin, axis=0)
        return out


def _sums():
    """mapInArrow function: lang, text -> lang, bucket, n summed over the task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            data, offs = K.text_buffers(batch.column("text"))
            for lang, lo, hi in zip(batch.column("lang").to_pylist(), offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                at, n = K.gram_counts(K.lower_points(data[lo:hi]), ORDERS, BITS)
                if lang not in total:
                    total[lang] = np.zeros(1 << BITS, np.int64)
                total[lang][at] += n
                texts[lang] = texts.get(lang, 0) + 1
        for lang, sums in total.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(sums[at], texts[lang]))],
                names=["lang", "bucket", "n"],
            )

    return run


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """Fit on all rows with a language and a text; None if there are none."""
    ship(labelled.sparkSession)
    rows = pick(labelled, lang=(lang_col, "string"), text=(text_col, "string")).where("lang is not null and text is not null")
    sums = rows.mapInArrow(_sums(), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = materialize(sums, "langid")
    texts = sums.where("bucket < 0").select("lang", "n").limit(MAX_LANGUAGES + 1).collect()
    if len(texts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return None if not texts else _fit(sums.where("bucket >= 0").toArrow(), {r.lang: r.n for r in texts})


def _fit(sums: pa.Table, texts: dict[str, int]) -> LanguageModel:
    langs = sorted(texts)
    at = {lang: i for i, lang in enumerate(langs)}
    counts = np.zeros((1 << BITS, len(langs)))
    col = np.array([at[lang] for lang in sums.column("lang").to_pylist()], int)
    counts[sums.column("bucket").to_numpy(), col] = sums.column("n").to_numpy()
    counts += SMOOTHING
    prior = np.array([texts[lang] for lang in langs], float)
    return LanguageModel(langs, np.log(counts / counts.sum(0)), np.log(prior / prior.sum()))


def has_letter(raw: bytes) -> bool:
    return _LETTER.search(raw.decode()) is not None


def _some_letter(data: np.ndarray, lo: int, hi: int) -> bool:
    head = data[lo : min(hi, lo + 4096)]
    if (((head | 32) >= 97) & ((head | 32) <= 122)).any():
        return True
    return has_letter(data[lo:hi].tobytes())


def predict_arrow(model: LanguageModel | None, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text: the most probable language and its posterior."""
    data, offs = K.text_buffers(column)
    langs, score = [UNDETERMINED] * len(column), np.zeros(len(column))
    if model is None:
        return langs, score
    for lo, hi in K.slices(offs):
        known = [i for i in range(lo, hi) if offs[i + 1] > offs[i] and _some_letter(data, offs[i], offs[i + 1])]
        if not known:
            continue
        joint = model.scores([K.gram_counts(K.lower_points(data[offs[i] : offs[i + 1]]), ORDERS, BITS) for i in known])
        best = joint.argmax(1)
        joint -= joint.max(1, keepdims=True)
        score[known] = 1 / np.exp(joint).sum(1)
        for i, b in zip(known, best.tolist(), strict=True):
            langs[i] = model.languages[b]
    return langs, score


def predict(
    docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, lang_pred and score (posterior, 0 to 1) of every row, in one scan.

    Defined cases: a null or empty text, or one without a letter, is ``und`` with score 0,
    and so is every row when there was nothing to learn from; a tie goes to the language first in
    order; repeated rows and null ids come out as they went in; extra columns are ignored;
    a very long text is counted slice by slice.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, score = predict_arrow(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return text_and_id(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Held-out documents: crc32 of the id as text leaves 1 when divided by 3 (never for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train_split(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """Fit on the rows that are not held out and name a language."""
    rows = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"), lang=(lang_col, "string"))
    return train(rows.where(~held_out(F.col("doc_id"))))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the rows that are not held out and predict all rows: doc_id, held_out, lang_pred, score."""
    found = predict(docs, train_split(docs, id_col, text_col, lang_col), id_col, text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows (all columns) whose language the model can tell.

    Rows without a letter, and rows whose best language has a posterior below
    ``min_score``, go; the language named in the input has no say in it.

    Defined cases: null and empty texts have no letter and go; null ids and a null lang are no reason to go; of
    equally likely languages the first by name counts; repeated rows go or stay together; very long
    texts count whole; other columns, also with clashing names, come back as they are; an empty table stays empty.
    """
    model = train_split(docs, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = position(docs, text_col)

    def keep(batch: pa.RecordBatch) -> np.ndarray:
        langs, score = predict_arrow(shared.value, batch.column(at))
        return np.array([lang != UNDETERMINED for lang in langs], bool) & (score >= min_score)

    return filter_rows(docs, keep)
