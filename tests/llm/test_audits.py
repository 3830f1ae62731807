"""Filter interactions, substring dedup and whitening against brute force."""

import hashlib
import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from ledgerflow.llm import filter_audit, queries, substring, whitening


def _rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# ---- op11 -------------------------------------------------------------------
def _brute_audit(docs, labels):
    def mask(doc_id, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        same = [d for d, t, _ in docs if (t or "") == text and d is not None]
        return {
            c
            for c, failed in zip(
                "ABCDE",
                [
                    len(words) < 100,
                    100 * len(set(words)) < 80 * len(words),
                    100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                    re.search(r"[#$%&*|]", text) is not None,
                    doc_id is not None and min(same) < doc_id,
                ],
                strict=True,
            )
            if failed
        }

    marked = {}
    for d, q, t in labels:
        good, toxic = marked.get(d, (False, False))
        marked[d] = (good or q == 1, toxic or t == 1)
    judged = [(lang or "", mask(d, t or ""), *marked.get(d if d is not None else "none", (False, False))) for d, t, lang in docs]
    out = []
    for part in {p for p, *_ in judged}:
        mine, removed = [x[1:] for x in judged if x[0] == part], {}
        rows = []
        for order in map("".join, permutations("ABCDE")):
            for i, c in enumerate(order):
                alive = [x for x in mine if not x[0] & set(order[:i])]
                here = [x for x in alive if c in x[0]]
                removed[c] = removed.get(c, 0) + len(here)
                rows.append((part, order, i + 1, len(alive) - len(here), len(here), sum(c in x[0] for x in mine) - len(here),
                             sum(x[0] == {c} for x in mine), sum(x[1] for x in here), sum(x[2] for x in here), c))
        out += [(*r[:-1], removed[r[-1]]) for r in rows]
    return sorted(out)


def test_audit_matches_brute_force(spark):
    rng = random.Random(3)
    pool = ["alpha", "Beta", "GAMMA", "d#", "über", "x"]
    docs = []
    for i in range(60):
        words = [rng.choice(pool) + (str(rng.randrange(400)) if rng.random() < 0.9 else "") for _ in range(rng.choice([0, 5, 99, 100, 130]))]
        docs.append((i, rng.choice([" ", "\t", " \n "]).join(words), rng.choice(["en", "de", None, ""])))
    docs += [(100 + i, docs[i % 7][1], "en") for i in range(10)] + [(None, docs[0][1], "de"), (3, docs[3][1], docs[3][2]), (200, None, "en"), (201, None, "en")]
    docs += [(300, "wort eins \x0b\x0c " + "x" * 200_000, "fr"), (301, " ".join(["long"] * 30_000), "fr")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 310, 2)] + [(2, 1, 1), (None, 1, 1), (5, None, None), (999, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("N", F.lit(1)).withColumn("part", F.lit("z"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(0))
    got = _rows(filter_audit.audit(d, lab), "part", "filter_order", "step", *filter_audit.COUNTS, "shapley")
    assert got == _brute_audit(docs, labels)


def test_audit_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert filter_audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_audit_matches_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    result = con.execute(filter_audit.ORACLE_SQL)
    names = [c[0] for c in result.description]
    df = queries.op11_filter_interactions(spark, SF_ORACLE)
    assert df.columns == names and _rows(df, *names) == sorted(result.fetchall())


# ---- op12 -------------------------------------------------------------------
def _brute_repeats(rows, window):
    first = {}
    split = [(d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for d, t in rows]
    for d, words in split:
        if d is not None:
            for i in range(len(words) - window + 1):
                key = tuple(words[i : i + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, words in split:
        away = set()
        if d is not None:
            for i in range(len(words) - window + 1):
                if first[tuple(words[i : i + window])] < d:
                    away.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in away)
        out.append((-1 if d is None else d, len(words), len(away), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _texts(seed, n=120):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passages = [[word() for _ in range(rng.choice([49, 50, 51, 60, 130]))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(0, 160))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages)
        rows.append((rng.randrange(2 * n), rng.choice([" ", "  ", "\t", "\n"]).join(words)))
    copy = rows[5][1]
    rows += [(1000 + i, copy) for i in range(30)]  # exact copies
    rows += [(2000 + i, copy.replace("w1", "W1", i)) for i in range(30)]  # edited copies, case counts
    rows += [(3000, "a " * 400), (3001, "a " * 300), (7, "a " * 120), (3002, " "), (3003, ""), (3004, None), (None, copy), (None, None)]
    rows += [(50, rows[3][1]), (50, rows[3][1]), (50, rows[4][1] + " x")]
    long = " ".join(word() for _ in range(30_000))
    return rows + [(4000, long), (4001, "head " + long + " tail"), (4002, long[: len(long) // 2])]


@pytest.mark.parametrize("small", [False, True])
def test_substring_dedup_matches_brute_force(spark, monkeypatch, small):
    if small:  # many shards, parts and home blocks
        monkeypatch.setattr(substring, "SHARD_WINDOWS", 500)
        monkeypatch.setattr(substring, "PART_WORDS", 300)
        monkeypatch.setattr(substring, "BLOCK_WORDS", 64)
    rows = _texts(7)
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"Text2": F.lit("x"), "version": F.lit("v"), "unit": F.lit(3)})
    got = substring.remove_repeats(docs.repartition(7)).select(F.coalesce("doc_id", F.lit(-1)), "n_words", "n_removed", "kept_sha256")
    assert sorted(tuple(r) for r in got.collect()) == _brute_repeats(rows, 50)


def test_other_windows(spark):
    rows = _texts(11, 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (2, 7):
        got = substring.remove_repeats(docs, window).select(F.coalesce("doc_id", F.lit(-1)), "n_words", "n_removed", "kept_sha256")
        assert sorted(tuple(r) for r in got.collect()) == _brute_repeats(rows, window)


def test_no_repeats_and_no_rows(spark):
    one = spark.createDataFrame([(1, "just one text")], "doc_id long, text string")
    assert [tuple(r) for r in substring.remove_repeats(one).select("n_words", "n_removed").collect()] == [(3, 0)]
    assert substring.remove_repeats(one.limit(0)).count() == 0


def test_registered_substring_dedup(spark):
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    rows = list(zip(docs.doc_id.tolist(), docs.text.tolist(), strict=True))
    got = queries.op12_substring_dedup(spark, SF_SMALL).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(tuple(r) for r in got.collect()) == _brute_repeats(rows, 50)


def test_automaton_finds_the_smallest_owner():
    a = b"x y z x y".split()
    automaton = substring.SuffixAutomaton([(5, a), (2, b"y z q".split()), (9, b"z x".split())])
    assert list(automaton.matches(b"y z x y z".split(), 2)) == [(1, 2), (2, 5), (3, 5), (4, 2)]


# ---- op13 -------------------------------------------------------------------
def _brute_whiten(rows, k=4):
    kept = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, total = len(fit), fit.sum(0)
    centred = fit - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    first = np.argsort(-values)[:k]
    trace = values.sum()
    out = {}
    for i, x in kept:
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, total, strict=True))
        for c, at in enumerate(first):
            if values[at] > 1e-9 * trace:
                out.setdefault((i, c + 1), []).append((n, deviation, (x - total / n) @ vectors[:, at] / np.sqrt(values[at]), values[at] / trace))
    return out


def _check_whitened(df, rows):
    want = _brute_whiten(rows)
    got = {}
    for r in df.collect():
        got.setdefault((r.vec_id, r.component), []).append(r)
        assert r.identity_error < 1e-6
    assert got.keys() == want.keys()
    signs = {}
    for key, mine in got.items():
        theirs = sorted(want[key])
        assert len(mine) == len(theirs)
        for r, (n, deviation, whitened, explained) in zip(sorted(mine, key=lambda r: r.deviation), theirs, strict=True):
            assert (r.n, r.deviation) == (n, deviation) and abs(r.explained / explained - 1) < 1e-9
            if abs(whitened) > 1e-3:
                assert signs.setdefault(key[1], np.sign(whitened * r.whitened)) == np.sign(whitened * r.whitened)
            assert abs(abs(r.whitened) - abs(whitened)) < 1e-7


def test_whitening_matches_numpy(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.2])
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(5, rows[9][1]), (None, rows[8][1])]
    rows += [(2000, None), (2001, []), (2002, [None] * 6), (2003, [float("nan")] * 6), (2004, [float("inf")] + [0.0] * 5), (2005, [-0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"x": F.lit(1), "At": F.lit(2), "n": F.lit(3)})
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 64)  # many blocks
    _check_whitened(whitening.whiten(df.repartition(5)), rows)


def test_whitening_edges(spark):
    kind = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).count() == 0  # no variance
    rows = [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0])]
    got = whitening.whiten(spark.createDataFrame(rows + [(4, [1.0] * 3), (5, [2.0, 1.0, 1.0])], kind))  # two lengths, one component each
    _check_whitened(got.where("vec_id < 4"), rows)
    assert _rows(got.where("vec_id > 3"), "vec_id", "component", "n") == [(4, 1, 2), (5, 1, 2)]


def test_registered_whitening(spark):
    pdf = pd.read_parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(int(i), None if v is None else [float(c) for c in v]) for i, v in zip(pdf.vec_id, pdf.embedding, strict=True)]
    _check_whitened(queries.op13_embedding_whitening(spark, SF_SMALL), rows)
