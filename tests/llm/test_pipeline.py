"""The pipeline: its stages on a small corpus, and what survives."""

import corpus_pipeline
from groundshift.llm import decontaminate, language, near_dedup, pieces, suffix_dedup
from groundshift.llm.queries import oracle_sql, queries


def test_run_equals_the_operators_one_after_another(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    d = docs.cache()
    for f in (language.accepted, near_dedup.one_of_each, suffix_dedup.remove_repeats, lambda x: decontaminate.clean(x, bench)):
        d = spark.createDataFrame(f(d).collect(), docs.schema)
        assert d.columns == docs.columns
    want = {r.doc_id: r.ids_sha256 for r in pieces.digest(d).collect()}
    got = docs
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, got, sf_dir)
    assert {r.doc_id: r.ids_sha256 for r in got.collect()} == want and 0 < len(want) < 120


def test_names_of_the_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())
