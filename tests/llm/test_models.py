"""Language identification, quality classifier and URL filter."""

import random
import zlib

import numpy as np

from ledgerflow.llm import langid, quality, url_filter
from ledgerflow.llm import queries as Q
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
WORDS = {"en": "the of and that with this there which", "fr": "le les des que dans pour être était", "de": "der die und nicht eine über für ist"}


def _lang_docs(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices(WORDS[lang].split(), k=12)), lang) for i, lang in enumerate(["en", "fr", "de"] * 40)]
    rows += [(1000, None, "en"), (1001, "", "fr"), (1002, "12 34 !!", "de"), (None, "the of and that", None), (5, "der die und", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit("x"), "LANG_PRED": F.lit(0)})


def test_language_of_texts(spark):
    got = {(r.doc_id, r.lang_pred): r for r in langid.identify(_lang_docs(spark)).collect()}
    rows = _lang_docs(spark).collect()
    for r in rows:
        if r.doc_id is not None and r.doc_id < 1000 and r.lang:
            row = got[(r.doc_id, r.lang)]
            assert 0.5 < row.score <= 1 and row.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    for i in (1000, 1001, 1002):
        assert got[(i, "und")].score == 0
    assert (None, "en") in got and (5, "de") in got
    kept = langid.keep_identified(_lang_docs(spark))
    assert kept.columns == _lang_docs(spark).columns
    assert kept.count() == len(rows) - 3


def test_language_without_rows_or_labels(spark):
    docs = _lang_docs(spark)
    assert langid.identify(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_language_score_is_the_brute_force_posterior(spark):
    docs = _lang_docs(spark)
    model = langid.train_split(docs)
    text = "the que der und les of"
    raw = np.frombuffer(text.encode(), np.uint8)
    at, n = langid.K.gram_counts(raw, langid.ORDERS, langid.BITS)
    joint = model.prior + sum(c * model.weights[b] for b, c in zip(at, n, strict=True))
    want = np.exp(joint - joint.max())
    import pyarrow as pa

    langs, score = langid.predict_arrow(model, pa.array([text]))
    assert langs == [model.languages[int(want.argmax())]]
    assert abs(score[0] - want.max() / want.sum()) < 1e-12


def test_language_grams_are_runs_of_characters(monkeypatch):
    def grams(text):
        at, n = langid.K.gram_counts(langid.K.lower_points(np.frombuffer(text.encode(), np.uint8)), langid.ORDERS, langid.BITS)
        return dict(zip(at.tolist(), n.tolist(), strict=True))

    for text in ("ÉTÉ ПРИВЕТ Ελλάδα", "今日は晴れ😀です", "ASCII only", "", "é"):
        points = np.array([ord(c) for c in text.lower()], np.uint32)
        at, n = langid.K.gram_counts(points, langid.ORDERS, langid.BITS)
        assert grams(text) == dict(zip(at.tolist(), n.tolist(), strict=True))
        assert sum(grams(text).values()) == sum(max(0, len(text) - k + 1) for k in langid.ORDERS)
    assert grams("ПРИВЕТ ÉTÉ") == grams("привет été")
    whole = grams("привет 今日は été 😀 " * 50)
    monkeypatch.setattr(langid.K, "SLICE_BYTES", 7)
    assert grams("привет 今日は été 😀 " * 50) == whole


def test_capitals_of_other_scripts_tell_the_language(spark):
    import pyarrow as pa

    rnd = random.Random(4)
    words = {"ru": "что это как его для все".split(), "uk": "що це як його для всі".split(), "el": "και το της για από με".split()}
    rows = [(" ".join(rnd.choices(words[lang], k=12)), lang) for lang in ("ru", "uk", "el") * 20]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    plain = langid.predict_arrow(model, pa.array([t for t, _ in rows]))
    loud = langid.predict_arrow(model, pa.array([t.upper() for t, _ in rows]))
    assert plain[0] == [lang for _, lang in rows] == loud[0]
    assert [s for s, (_, lang) in zip(loud[1], rows, strict=True) if lang != "el"] == [s for s, (_, lang) in zip(plain[1], rows, strict=True) if lang != "el"]


def test_held_out_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Q.QUERIES["op1_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 200 and (got.lang == got.lang_pred).mean() > 0.98


def _quality_docs(spark):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = rnd.choices("plain words make good text here and there".split(), k=rnd.randint(20, 60))
        text = " ".join(f"{w}###" if bad else w for w in words)
        rows.append((i, text, "en", "spam" if bad and i % 8 else "site", len(text)))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1))
    rows += [(900, None, None, None, None), (901, "", "en", "site", 0), (None, "plain words", "en", "site", 11)]
    labels += [(3, 0), (3, 1), (None, 1), (5, None)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("keep", F.lit("k")),
        spark.createDataFrame(labels, "doc_id long, quality int").withColumn("LABEL", F.lit(9)),
    )


def test_co_training_separates_and_keeps_clean_rows(spark):
    docs, labels = _quality_docs(spark)
    got = quality.classify(docs, labels).toPandas()
    assert len(got) == 403
    known = got[got.doc_id < 400]
    bad = known.doc_id % 4 == 0
    assert not known[bad].keep.any() and known[~bad].keep.all()
    assert got.quality.between(0, 1).all()
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(-1 if d != d else int(d) for d in got[got.keep].doc_id)


def test_quality_without_labels_keeps_everything(spark):
    docs, labels = _quality_docs(spark)
    assert quality.train(docs, labels.limit(0)) is None
    assert quality.score(docs, None).where("keep").count() == 403
    assert quality.keep_good(docs, labels.where("quality = 1")).count() == 403
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_pseudo_labels_cross_the_views():
    rnd = np.random.default_rng(3)
    label = np.array([1, 0] * 30 + [-1] * 200)
    truth = np.concatenate([label[:60], rnd.integers(0, 2, 200)])
    text = quality._stack([(np.array([int(t)]), np.array([1.0])) for t in truth])
    meta = quality._stack([(np.array([int(t) + 10]), np.array([0.5])) for t in truth])
    model = quality.co_train(text, meta, label, np.arange(260) // 2 % 4)
    assert ((model.score(text, meta)[2] > 0.5) == (truth == 1)).all()


def test_quality_on_the_labelled_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("good"))
    got = Q.QUERIES["op4_co_trained_quality"](spark, SF).join(labels, "doc_id").toPandas()
    assert got[got.good == 1].keep.mean() > 0.98 and got[got.good == 0].keep.mean() < 0.3


URLS = [
    (1, None), (2, "nope"), (3, "http://A.ExAmple.com"), (4, "x://É.COM?x#y"), (5, "http://a.net/es/"), (6, "http://net/fr/x#q/"),
    (7, "HTTP://www.example.com/en/"), (8, "a://b://c/d"), (9, "http://example.com/en"), (10, "http://h\n/p\nq?z"), (11, "://"),
    (12, "http://xnet/es/"), (13, "http://www.www.example.com/en/1"), (None, "http://b.example.com/en/?a"), (5, "http://a.net/es/"),
]


def _brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([len(rest)] + [rest.index(c) for c in "?#" if c in rest])
        rest = rest[:cut]
        host, slash, tail = rest.partition("/")
        path = slash + tail
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for r in Q.URL_RULES:
        name, _, tail = r.rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail) and (best is None or len(r.rule) > len(best.rule)):
            best = r
    return host, path, best


def test_urls_are_split_and_ruled_as_by_hand(spark):
    pages = spark.createDataFrame([(i, u, "<p>some words of text</p>") for i, u in URLS], "page_id long, url string, html string")
    pages = pages.withColumn("Rule", F.lit("x"))
    got = url_filter.judge(pages, url_filter.train(pages), Q.URL_RULES).collect()
    assert sorted((r.page_id or -1, r.host, r.path, r.rule or "") for r in got) == sorted(
        (i or -1, *_brute(u)[:2], _brute(u)[2].rule if _brute(u)[2] else "") for i, u in URLS
    )
    for r in got:
        if r.rule:
            assert r.verdict == next(x.verdict for x in Q.URL_RULES if x.rule == r.rule)
    assert all(r.verdict == "allow" for r in got if not r.host and not r.path)
    empty = pages.limit(0)
    assert url_filter.judge(empty, url_filter.train(empty), []).count() == 0


def test_viterbi_equals_all_segmentations():
    rnd = random.Random(7)
    lex = url_filter.Lexicon.of({"a": 5, "ab": 9, "abc": 2, "b": 1, "cab": 4, "bets": 3})

    def best(name):
        out = [(0.0, ())] if not name else []
        for n in range(1, len(name) + 1):
            c = lex.cost.get(name[:n], lex.unknown if n == 1 else None)
            if c is not None:
                tail, words = best(name[n:])
                out.append((c + tail, (name[:n], *words)))
        return min(out)

    def cost(words):
        return sum(lex.cost.get(w, lex.unknown * len(w)) for w in words)

    for _ in range(300):
        name = "".join(rnd.choices("abcx", k=rnd.randint(1, 9)))
        got = lex.split(name)
        assert "".join(got) == name and abs(cost(got) - best(name)[0]) < 1e-9


def test_concatenated_names_are_blocked_by_their_words(spark):
    rnd = random.Random(8)
    hosts = ["free-bets.org", "casino-win.org", "garden.org", "news.net", "books.org", "win-casino.net"]
    pages = [(i, f"http://{rnd.choice(hosts)}/x/{i}", "<p>garden news books win free bets casino</p>") for i in range(300)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    model = url_filter.train(frame)
    assert model.lexicon.split("freebets") == ["free", "bets"]
    assert model.block_odds("wincasino.org", "/x/1") > 0 > model.block_odds("gardenbooks.org", "/x/1")


def test_long_path_words_are_segmented_whole(spark):
    filler = "gardennewsbooks" * 20  # 300 letters
    pages = [(i, f"http://example.org/{'books' if i % 2 else 'casino'}/{i}", "<p>garden news books win free bets casino</p>") for i in range(200)]
    pages += [(1000, f"http://example.org/{filler}freebetscasino", "<p>news</p>"), (1001, f"http://example.org/{filler}", "<p>news</p>")]
    pages += [(1002, "http://example.org/" + "xq" * 200_000 + "casino", "<p>news</p>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    model = url_filter.train(frame)
    assert url_filter.url_words(model.lexicon, "", "/" + filler + "freebetscasino")[-3:] == ["free", "bets", "casino"]
    assert url_filter.url_words(model.lexicon, "", "/" + "xq" * 200_000 + "casino") == ["xq" * 200_000, "casino"]
    got = {r.page_id: r for r in url_filter.judge(frame, model, []).collect()}
    assert got[1000].block_odds > got[1001].block_odds and got[1002].verdict == "block"
    assert not any(len(label) > url_filter.CACHE_LENGTH for label in model.lexicon.seen)
    # in training, too: the URL with a seed word after 256 letters counts as one to block
    late = spark.createDataFrame([(i, f"http://example.org/{filler}{'casino' if i < 3 else ''}", "<p>garden news books</p>") for i in range(9)], frame.schema)
    assert abs(url_filter.train(late).prior - np.log((3 + 1) / (6 + 1))) < 1e-12


def test_quality_does_not_depend_on_the_order_of_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).select("doc_id", "text", "lang", "source", "n_chars")
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    many = docs.withColumn("copy", F.explode(F.lit(list(range(60)))))
    one, other = (many.orderBy(c).drop("copy") for c in ("copy", F.desc("doc_id")))
    scores = []
    for d in (docs, one, other):
        rows = quality.classify(d, labels).select("doc_id", F.round("quality", 9), "keep").distinct().collect()
        scores.append(sorted(map(tuple, rows)))
    assert scores[0] == scores[1] == scores[2] and len(scores[0]) == 300


def test_quality_with_null_ids_clashing_names_and_long_texts(spark):
    rows = [(i, ("good plain words " if i % 2 else "buy $$$ now !!! ") * (i % 9 + 1), i) for i in range(60)] + [(None, "x", 1), (None, None, 2), (70, "word " * 400_000, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra long").withColumns({"keep": F.lit("k"), "quality": F.lit(9)})
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 50)], "doc_id long, quality int")
    assert quality.classify(docs, labels).count() == len(rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.extra for r in kept.collect()} >= {1, 3}


def test_lexicon_has_no_cliff(spark):
    def word(i):
        return "".join(chr(97 + i // 26**p % 26) for p in range(4)) + "q"

    long = "abcdefghijklmnopqrstuvwxyzabcd"
    texts = [(" ".join(word(i) for i in range(k, 60_000, 40)) + f" the the {long}",) for k in range(40)]
    counts = url_filter.word_counts(spark.createDataFrame(texts, "text string"), "text")
    assert 49_000 <= len(counts) <= 50_000 and counts["the"] == 80 and counts[long] == 40
    assert len(url_filter.word_counts(spark.createDataFrame(texts, "text string"), "text", 70_000)) == 60_002
