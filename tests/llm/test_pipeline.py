"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline as P
from pyspark.sql import functions as F

from tests.llm.test_operators import SHAPE, brute_components, brute_sets, odd  # noqa: F401
from tickloom.llm import secret_scan, toxicity
from tickloom.llm.common import materialize


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert [k for k, _ in P.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]
    kept = materialize(P.drop_toxic(spark, docs, small), "t")
    chain = toxicity.train(docs, spark.read.parquet(f"{small}/labels.parquet"))
    want = {r.doc_id for r in docs.collect() if chain.score(r.text)[-1] < chain.threshold[-1] - 1e-6}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == docs.columns
    single = materialize(P.drop_near_duplicates(spark, kept, small), "d")
    rows = kept.collect()
    parts = brute_components([r.doc_id for r in rows], brute_sets([r.text for r in rows]))
    assert {r.doc_id for r in single.collect()} == {r.doc_id for r, c in zip(rows, parts, strict=True) if r.doc_id == c}
    clean = materialize(P.blank_secrets(spark, single, small), "s")
    before = {r.doc_id: r.text for r in single.collect()}
    for r in clean.collect():
        assert r.text == secret_scan.redact(before[r.doc_id], secret_scan.find_secrets(before[r.doc_id])) and r.n_chars == len(r.text)
    mixed = materialize(P.mix(spark, clean, small), "m")
    assert mixed.columns == docs.columns and 0.5 * clean.count() < mixed.count() < 2 * clean.count()
    packed = P.pack(spark, mixed, small)
    assert packed.where("start = 0").count() == mixed.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 4096


def test_run_equals_the_stages_and_odd_rows_pass(spark, small, odd):  # noqa: F811
    assert P.run(spark, small).count() > 0
    docs = odd
    for name, stage in P.STAGES:
        docs = materialize(stage(spark, docs, small), name)
    assert docs.count() > 0


def test_near_duplicates_keep_rows_with_null_and_repeated_ids(spark):
    words = [f"w{i}" for i in range(150)]
    near = " ".join([*words[:-1], "edited"])
    alone = [" ".join(f"{x}{i}" for i in range(60)) for x in "abc"]
    docs = [(None, alone[0]), (None, None), (1, " ".join(words)), (2, near), (2, alone[1]), (None, alone[2]), (None, alone[2] + " more")]
    got = {tuple(r) for r in P.drop_near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string"), "").collect()}
    assert len(got) == 5 and {docs[0], docs[1], docs[2], docs[4]} <= got and got & {docs[5], docs[6]}
