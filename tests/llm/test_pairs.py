"""Near duplicates, decontamination, neighbours and shards against brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import ann, components, decontam, minhash, sharding
from ledgerflow.llm import kernels as K


def _components(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def _brute_components(rows, k, num):
    """rows of (doc_id, text): {(doc_id, set size): component}."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]
    root = _components(len(rows), links)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root[i]] = min(low.get(root[i], doc), doc)
    return [(doc, len(sets[i]), low.get(root[i])) for i, (doc, _) in enumerate(rows)]


def _copies(seed, families=12, size=14):
    rnd = random.Random(seed)
    rows = []
    for f in range(families):
        base = [rnd.choice("aa bb cc dd ee ff gg hh").strip() + str(rnd.randint(0, 40)) for _ in range(rnd.choice([4, 30, 80]))]
        for _ in range(rnd.randint(1, size)):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 6])):
                words[rnd.randrange(len(words))] = f"edit{rnd.randint(0, 99)}"
            rows.append((" ".join(words).upper() if rnd.random() < 0.2 else "  ".join(words)))
    rows += ["", None, " \t", "one", "one", "ONE two", "one  two"]
    rnd.shuffle(rows)
    return [(1000 - 3 * i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("k,num,leaf,block", [(3, 85, 128, 2_000_000), (5, 80, 3, 100)])
def test_components_equal_brute_force(spark, k, num, leaf, block):
    rows = _copies(num)
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, "nobody else says this")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"kept": F.lit("x"), "class_id": F.lit(1)})
    got = minhash.near_duplicates(docs, k, num, 100, leaf=leaf, block_shingles=block).collect()
    want = _brute_components(rows, k, num)
    key = lambda t: tuple(-1 if x is None else x for x in t)
    assert sorted(key((r.doc_id, r.n_shingles, r.component_id)) for r in got) == sorted(map(key, want))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_a_hot_group_of_copies_in_blocks(spark):
    rnd = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(260):
        words = list(base)
        words[rnd.randrange(60)] = f"e{i}"
        rows.append((i, " ".join(words)))
    rows += [(300 + i, rows[0][1]) for i in range(100)] + [(500, "something else " + rows[1][1][:20])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = minhash.near_duplicates(docs, 3, 85, 100, leaf=16, block_shingles=800).collect()
    want = _brute_components(rows, 3, 85)
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((d, c) for d, _, c in want)


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "a b c d e f"), (3, "A b c d e f"), (3, "A b c d e f"), (9, ""), (10, None), (None, "x y z"), (None, None), (7, "q r s t u v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("times", F.lit("t")).select("times", "text", "doc_id")
    kept = minhash.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["10", "3", "7", "9", "None", "None"]
    assert minhash.drop_duplicates(docs.limit(0)).count() == 0


def test_texts_that_share_an_id_are_judged_by_themselves(spark):
    say = lambda w, n=30: " ".join(f"{w}{i}" for i in range(n))
    rows = [(1, say("a")), (3, say("a")), (3, say("b")), (3, say("b")), (3, say("c")), (3, ""), (3, None), (4, say("c") + " more")]
    rows += [(5, say("d")), (5, say("d") + " more"), (6, say("d").upper()), (7, say("e")), (None, say("a")), (2, say("f")), (8, say("f")), (8, say("g"))]
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).repartition(parts)
        got = sorted((r.doc_id or -1, (r.text or "").split()[:1]) for r in minhash.drop_duplicates(docs).collect())
        first = {-1: "a", 1: "a", 2: "f", 5: "d", 7: "e", 8: "g"}
        assert got == sorted([(i, [w + "0"]) for i, w in first.items()] + [(3, ["b0"]), (3, ["c0"]), (3, [])])


def test_connected_components_of_chains_and_hubs(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(7, 7), (300, 301), (301, 300)]
    edges += [(rnd.randint(400, 480), rnd.randint(400, 480)) for _ in range(60)]
    got = {r.node: r.label for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = _components(500, edges)
    assert got == {v: root[v] for e in edges if e[0] != e[1] for v in e}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _plain_alignment(item, text):
    best = 0
    prev = [0] * (len(text) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(text, 1):
            row.append(max(0, prev[j - 1] + (2 if a == b else -1), prev[j] - 1, row[-1] - 1))
        best, prev = max(best, max(row)), row
    return best


def test_alignment_equals_the_plain_recursion():
    rnd = np.random.default_rng(4)
    for _ in range(60):
        item = rnd.integers(0, 6, rnd.integers(1, 20)).astype(np.uint64)
        windows = rnd.integers(0, 6, (3, 25)).astype(np.uint64)
        score, _, _ = decontam.align(item, windows, np.ones_like(windows, bool))
        assert score.tolist() == [_plain_alignment(item.tolist(), w.tolist()) for w in windows]


def test_planted_passages_are_found_and_clean_documents_left_alone(spark):
    rnd = random.Random(5)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    say = lambda n: [rnd.choice(["the", "of", "and", *vocabulary]) for _ in range(n)]
    items = [(i, say(rnd.randint(15, 50))) for i in range(30)]
    rows, planted = [], set()
    for d in range(300):
        text = say(rnd.randint(5, 200))
        if d % 5 == 0:
            i, words = items[rnd.randrange(30)]
            words = list(words)
            edits = rnd.choice([0, 1, len(words) // 8])
            for _ in range(edits):
                p = rnd.randrange(len(words))
                words[p : p + 1] = rnd.choice([[], ["edited"], [words[p], "more"]])
            at = rnd.randrange(len(text) + 1)
            text[at:at] = [w.upper() + "," for w in words] if rnd.random() < 0.3 else words
            planted.add((d, i))
        rows.append((d, " ".join(text)))
    rows += [(1000 + i, " ".join(items[0][1])) for i in range(200)]  # one item has leaked very often
    planted |= {(1000 + i, 0) for i in range(200)}
    rows += [(2000, None), (2001, ""), (None, " ".join(items[3][1])), (2002, "two words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("x")).repartition(4)
    bench = [(i, " ".join(w)) for i, w in items] + [(90, None), (91, ""), (92, "two words"), (None, "no id for this item")]
    bench = spark.createDataFrame(bench, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = decontam.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.doc_id is not None} == planted
    assert [r.item_id for r in got if r.doc_id is None] == [3]
    assert all(0.5 <= r.score <= 1 and r.exact == (r.score == 1) for r in got)
    clean = decontam.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    bad = {d for d, _ in planted}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _ in rows if d is not None and d not in bad)
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("copies", [5, 50, 5000])
def test_partial_and_edited_copies_are_found_however_often_they_leaked(spark, copies):
    rnd = random.Random(copies)
    items = [[f"i{k}w{j}" for j in range(40)] for k in range(2)]
    passage = items[0][7:33]  # 26 of 40 words
    edited = [f"edit{j}" if j % 8 == 4 else w for j, w in enumerate(items[1])]
    say = lambda: [f"z{rnd.randint(0, 999)}" for _ in range(rnd.randint(0, 30))]
    rows = [(d, " ".join(say() + (passage if d % 2 else edited) + say())) for d in range(2 * copies)]
    rows += [(-1 - d, " ".join(say() + items[0][d : d + 6])) for d in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(docs, bench).collect()}
    assert set(got) == {(d, 0 if d % 2 else 1) for d in range(2 * copies)}
    assert {round(s, 9) for (_, i), s in got.items() if i == 0} == {0.65}
    assert sorted(r.doc_id for r in decontam.drop_contaminated(docs, bench).collect()) == list(range(-30, 0))


def test_no_passage_that_scores_enough_is_ruled_out(monkeypatch):
    rnd = np.random.default_rng(7)
    item = [rnd.integers(0, 9, rnd.integers(3, 20)).astype(np.uint64) for _ in range(60)]
    for w in item:
        windows = rnd.integers(0, 12, (20, 30)).astype(np.uint64)
        valid = np.arange(30) < rnd.integers(3, 31, (20, 1))
        score, _, _ = decontam.align(w, windows, valid)
        for least in (len(w) * 0.6, len(w), len(w) * 1.6):
            assert decontam._possible(w, windows, valid, least)[score >= least].all()
    texts = [" ".join(f"w{v}" for v in rnd.integers(0, 6, n)) for n in rnd.integers(0, 90, 40)]
    data, offs = K.text_buffers(pa.array(texts))
    index = decontam.Index.build(list(enumerate(item[:20])) + [(50, K.word_hashes(data, offs[9:11], alnum=True)[0])])
    want = decontam.find(index, data, offs, 0.5)
    monkeypatch.setattr(decontam, "POSTINGS", 40)
    monkeypatch.setattr(decontam, "CELLS", 200)
    assert decontam.find(index, data, offs, 0.5) == want and want


def test_item_blocks_give_the_same_pairs(spark, monkeypatch):
    rnd = random.Random(2)
    items = [(i, " ".join(f"w{rnd.randint(0, 500)}" for _ in range(20))) for i in range(12)]
    docs = spark.createDataFrame([(d, f"before {items[d % 12][1]} after") for d in range(24)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(tuple(r) for r in decontam.contaminated(docs, bench).collect())
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 300)
    assert sorted(tuple(r) for r in decontam.contaminated(docs, bench).collect()) == want and len(want) == 24


def _brute_nearest(ids, x, query, k):
    at = np.flatnonzero(ids == query)
    best = {}
    for a in at:
        for v, d in zip(ids, np.sqrt(((x - x[a]) ** 2).sum(1)), strict=True):
            if v != query:
                best[v] = min(best.get(v, np.inf), d)
    return sorted((d, v) for v, d in best.items())[:k]


def test_neighbours_reach_the_recall_and_give_exact_scores(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(1500, 16)), 3 + 0.01 * rng.normal(size=(400, 16)), np.tile(rng.normal(size=16), (300, 1))])
    ids = np.arange(len(x)) * 2
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(ids, x, strict=True)]
    odd = [(101, None), (103, []), (105, [0.0] * 16), (107, [float("nan")] + [1.0] * 15), (109, [None] + [1.0] * 15), (111, [1.0] * 5), (None, [1.0] * 16)]
    odd += [(113, [float("inf")] + [1.0] * 15), rows[0], rows[1]]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    got = ann.nearest(frame, F.col("id") % 100 == 0).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert set(found) == {int(i) for i in ids if i % 100 == 0}
    hits = total = 0
    for q, near in found.items():
        near.sort()
        assert [n[0] for n in near] == list(range(1, 11)) and [n[1:] for n in near] == sorted(n[1:] for n in near)
        for _, d, v in near:
            assert abs(d - np.sqrt(((x[q // 2] - x[v // 2]) ** 2).sum())) < 1e-12
        want = _brute_nearest(ids, x, q, 10)
        hits += sum(d <= want[-1][0] + 1e-12 for _, d, _ in near)
        total += 10
    assert hits / total >= 0.9


@pytest.mark.parametrize("few", [False, True])
def test_an_id_with_several_vectors_takes_one_place(spark, monkeypatch, few):
    if few:  # too few candidates: the exact search
        monkeypatch.setattr(ann.Hashing, "probe_keys", lambda self, q, table, probes: np.array([-1 - table]))
    rng = np.random.default_rng(11)
    ids = np.concatenate([np.repeat(np.arange(1, 5), 40), np.arange(5, 80), [0, 0, 0, 100, 100]])
    x = np.concatenate([0.01 * rng.normal(size=(160, 4)), rng.normal(size=(75, 4)), np.zeros((1, 4)) + 0.02, rng.normal(size=(4, 4))])
    frame = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(frame.unionAll(frame.limit(50)).repartition(3), F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    assert set(got) == {0, 100}
    for q, near in got.items():
        want = _brute_nearest(ids, x, q, 10)
        assert sorted(near) == [(n, int(v), round(float(d), 9)) for n, (d, v) in enumerate(want, 1)]


@pytest.mark.parametrize("copies", [1, 12])
def test_repeated_rows_do_not_cost_recall(spark, copies):
    rng = np.random.default_rng(21)
    x = rng.normal(size=(3000, 8))
    ids = np.arange(len(x))
    frame = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    frame = frame.withColumn("copy", F.explode(F.lit(list(range(copies))))).drop("copy")
    found = {}
    for r in ann.nearest(frame, F.col("id") % 20 == 0).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    hits = [len(set(found[q]) & {v for _, v in _brute_nearest(ids, x, q, 10)}) / 10 for q in range(0, 3000, 20)]
    assert all(len(v) == len(set(v)) == 10 for v in found.values()) and np.mean(hits) >= 0.95


def test_each_length_is_searched_by_itself(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 5.0]), (0, [1.0, 1.0, 1.0]), (2, [1.0, 1.0, 1.5]), (1, [1.0, 1.0, 3.0]), (3, [1.0])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") == 0)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 2, 0.5), (0, 2, 1, 2.0)]


def test_outliers_beside_a_tight_cluster_reach_the_recall(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([0.01 * rng.normal(size=(1500, 8)), 0.2 * rng.normal(size=(500, 8))])
    ids = rng.permutation(len(x))
    frame = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.nearest(frame, F.col("id") % 10 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = [len(found[q] & {v for _, v in _brute_nearest(ids, x, q, 10)}) / 10 for q in range(0, 2000, 10)]
    assert len(found) == 200 and np.mean(hits) >= 0.95
    far = [h for q, h in zip(range(0, 2000, 10), hits, strict=True) if np.flatnonzero(ids == q)[0] >= 1500]
    assert np.mean(far) >= 0.85


def test_few_vectors_give_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 5.0]), (2, [100.0, 3.0]), (100, [-7.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(frame, F.col("id") % 100 == 0).collect()
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    for q in (0, 100):
        want = _brute_nearest(ids, x, q, 10)
        assert [(r.vec_id, round(r.score, 9)) for r in sorted(got) if r.query_id == q] == [(v, round(d, 9)) for d, v in want]
    assert ann.nearest(frame.limit(0), F.col("id") % 100 == 0).count() == 0
    assert ann.nearest(frame.where("vec_id = 0"), F.col("id") % 100 == 0).count() == 0


def test_hot_buckets_are_searched_in_a_grid(spark, monkeypatch):
    monkeypatch.setattr(ann, "BUCKET_ROWS", 16)
    monkeypatch.setattr(ann, "BUCKET_QUERIES", 2)
    rng = np.random.default_rng(2)
    x = np.concatenate([np.tile(np.ones(8), (150, 1)) + 1e-3 * rng.normal(size=(150, 8)), rng.normal(size=(150, 8))])
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(frame, F.col("id") % 10 == 0).collect()
    ids = np.arange(300)
    hits = sum(len({r.vec_id for r in got if r.query_id == q} & {v for _, v in _brute_nearest(ids, x, q, 10)}) for q in range(0, 300, 10))
    assert len(got) == 300 and hits >= 270


def test_perturbations_come_in_order_of_cost():
    rng = np.random.default_rng(3)
    for _ in range(20):
        inside = rng.uniform(size=4)
        sets = list(ann.perturbations(inside, 81))
        cost = [sum(inside[p] ** 2 if d < 0 else (1 - inside[p]) ** 2 for p, d in s) for s in sets]
        assert len(sets) == 81 == len({tuple(sorted(s)) for s in sets}) and np.all(np.diff(cost) > -1e-12)


def _smallest_capacity(sizes, shards):
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid, used, full = (lo + hi) // 2, 1, 0
        for s in sizes:
            if full + s > mid:
                used, full = used + 1, 0
            full += s
        lo, hi = (lo, mid) if used <= shards else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("first,sums", [(3, 32), (16, 1 << 19)])
def test_shards_have_the_smallest_largest_size(spark, monkeypatch, first, sums):
    monkeypatch.setattr(sharding, "FIRST_BITS", first)
    monkeypatch.setattr(sharding, "MAX_SUMS", sums)
    rng = np.random.default_rng(first)
    for shards in (3, 7, 40):
        keys = np.sort(rng.integers(0, 1 << 63, 700))
        sizes = (rng.pareto(1.2, 700) * 50 + 16).astype(int).tolist()
        frame = spark.createDataFrame([(int(k), int(s)) for k, s in zip(keys, sizes, strict=True)], "key long, size long")
        cuts = sharding.cut_keys(frame, shards)
        assert len(cuts) < shards and cuts == sorted(cuts)
        total = [0] * (len(cuts) + 1)
        for k, s in zip(keys.tolist(), sizes, strict=True):
            total[sum(c <= k for c in cuts)] += s
        assert max(total) == _smallest_capacity(sizes, shards)


def test_sharded_documents(spark):
    rnd = random.Random(3)
    rows = [(i, "hot copy" if i % 3 == 0 else "".join(rnd.choices("abé ", k=rnd.randint(0, 400)))) for i in range(600)]
    rows += [(5, rows[5][1]), (None, "x"), (7000, None), (7001, None), (7002, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"shard": F.lit("s"), "KEY": F.lit(1)}).repartition(5)
    got = sharding.shard_documents(docs, 8).collect()
    assert len(got) == len(rows)
    size = lambda t: len((t or "").encode()) + 16
    want = sorted((d or -1, size(t), zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == want
    by_shard, home = {}, {}
    for r in got:
        assert 0 <= r.shard < 8 and r.law == "bytes" and r.grown_shard is None
        by_shard.setdefault(r.shard, []).append(r)
    for part in by_shard.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    where = {r.doc_id: r.shard for r in got}
    for d, t in rows:
        home.setdefault(t, set()).add(where[d])
    assert all(len(s) == 1 for s in home.values())
    groups = {}
    for d, t in rows:
        groups[t] = groups.get(t, 0) + size(t)
    assert max(sum(r.size for r in p) for p in by_shard.values()) <= max(max(groups.values()), 1.3 * sum(groups.values()) / 8)
    assert sharding.shard_documents(docs.limit(0)).count() == 0
