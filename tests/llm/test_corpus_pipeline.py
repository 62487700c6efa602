import corpus_pipeline
import __spark_entry__ as E
import test_decontaminate
import test_minhash_dedup

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Each stage on its own input: what the classifier kept, classes, removed bytes, clean documents, tokens."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "minhash near-dedup", "suffix-array dedup", "benchmark decontamination", "sentencepiece"]
    tables = []
    for _, f in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stage(f(spark, docs, SF), "test-pipeline")
        assert docs.columns == columns
        tables.append({r["doc_id"]: r["text"] for r in docs.collect()})
    graded = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = [d for d, q in graded.items() if (d in tables[0]) != (q == 1)]
    assert len(wrong) <= 0.03 * len(graded)
    classes = test_minhash_dedup.brute(tables[0].items())
    assert set(tables[1]) == {d for d, c in classes.items() if c[2]}
    seen, want = set(), {}
    for d in sorted(tables[1]):
        b = tables[1][d].encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i:i + 100] in seen:
                gone[i:i + 100] = b"\x01" * 100
            seen.add(b[i:i + 100])
        want[d] = bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")
    assert tables[2] == {d: t for d, t in want.items() if t or not tables[1][d]}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(tables[3]) == {r[0] for r in test_decontaminate.brute(tables[2].items(), items) if not r[5]}
    out = {r["doc_id"]: r for r in corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()}
    assert set(out) == set(tables[3]) and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in out.values())


def test_run_is_registered_and_gives_the_last_stage(spark):
    assert E.queries()["pipeline"] is corpus_pipeline.run
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "ids", "n_tokens", "round_trip"} <= set(out.columns) and out.count() > 100


def test_an_empty_table_passes_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF)
    assert docs.count() == 0
