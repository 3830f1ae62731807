"""The corpus pipeline, stage by stage, and the registered queries."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerflow.llm import decontam, langid, minhash, packing, quality

SF = "/root/testdata/sf0.001"


def test_every_stage_does_its_work_on_what_the_stage_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "language_id", "minhash_near_dedup", "benchmark_decontamination", "cost_balanced_packing"]

    good = stages["quality_classifier"](spark, docs, SF)
    assert good.columns == docs.columns
    assert ids(good) == ids(quality.classify(docs, labels).where("keep"))

    spoken = stages["language_id"](spark, good, SF)
    assert spoken.columns == docs.columns and ids(spoken) == ids(langid.identify(good).where("lang_pred <> 'und' and score >= 0.5"))

    single = stages["minhash_near_dedup"](spark, spoken, SF)
    texts = {r.doc_id: r.text.encode().lower().split() for r in spoken.collect()}
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()) for d, w in texts.items()}
    reach = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if reach[b] < reach[a] and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    reach[a], changed = reach[b], True
    assert single.columns == docs.columns and ids(single) == sorted(d for d in sets if reach[d] == d)

    clean = stages["benchmark_decontamination"](spark, single, SF)
    found = {r.doc_id for r in decontam.contaminated(single, bench).collect()}
    items = [" ".join(r.text.split()) for r in bench.collect()]
    exact = {r.doc_id for r in single.collect() if any(i in " ".join(r.text.split()) for i in items)}
    assert exact <= found and clean.columns == docs.columns and ids(clean) == sorted(set(ids(single)) - found)

    packed = stages["cost_balanced_packing"](spark, clean, SF)
    assert sorted({r.doc_id for r in packed.collect()}) == ids(clean)
    assert packed.columns == packing.pack_documents(clean).columns

    run = corpus_pipeline.run(spark, SF)
    tokens = lambda df: sorted(tuple(r) for r in df.select("doc_id", "doc_tokens").distinct().collect())
    assert tokens(run) == tokens(packed)  # the cuts depend on the files' partitions, the documents do not


def test_an_empty_corpus_passes_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_stages_take_null_ids_clashing_names_repeated_and_long_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    text = docs.first().text
    extra = spark.createDataFrame([(None, text), (None, None), (3, ""), (900, text + " more"), (901, " ".join([text] * 300))], "doc_id long, text string")
    odd = docs.unionByName(extra, allowMissingColumns=True).unionByName(docs.limit(5))
    names = [{"text": "Text"}.get(c, c) for c in odd.columns]
    odd = odd.toDF(*names).withColumns({"keep": F.lit("k"), "c0": F.lit(1), "score": F.lit(2)})
    odd = spark.createDataFrame(odd.collect(), odd.schema)
    found = odd
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, found, SF)
        if name != "cost_balanced_packing":
            assert found.columns == odd.columns, name
    assert found.count() > 0


def test_one_query_for_each_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()
    assert minhash.TREES * minhash.LEVELS <= minhash.SKETCH
