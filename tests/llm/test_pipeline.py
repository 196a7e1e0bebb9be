"""Registered queries of the package on a given table, and the pipeline stage by stage."""

from __future__ import annotations

import pytest

import corpus_pipeline
from brooklet.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.llm import brute

check = pytest.importorskip("check")
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    assert not check.differences(LLM_QUERIES[name](spark, SF).toArrow(), check.oracle_rows(SF, LLM_ORACLES[name]))


def test_benchmark_query_agrees_with_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {k: (n, hit, len(named), brute.sha(",".join(sorted(map(str, named)))), hit > 0) for k, n, hit, named in brute.decontaminated(docs, items)}
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in LLM_QUERIES["op6_benchmark_decontamination"](spark, SF).collect()}
    assert got == want


def test_stages_take_effect_and_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        old = {r.doc_id: r.text for r in before.collect()}
        if name == "ngram_jaccard_join":
            sizes = brute.near_components(sorted(old.items()))
            assert docs.count() == len({c for _, n, c in sizes if n}) + sum(n == 0 for _, n, _ in sizes)
        if name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            hit = {k: n for k, _, n, _ in brute.decontaminated(old.items(), items)}
            new = {r.doc_id: r.text for r in docs.collect()}
            assert all(new[k] == old[k] for k, n in hit.items() if not n)
            assert all(k not in new or new[k] != old[k] for k, n in hit.items() if n)
        if name == "secret_scans":
            assert all(not brute.known_secrets(r.text) for r in docs.collect())
        if name == "sentencepiece":
            assert all(r.n_ids == len(r.ids) for r in docs.collect())


def test_stages_run_in_small_arrow_batches(spark, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)

    def noted(session, docs, sf_dir):
        seen.append(session.conf.get(name))
        return docs

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", noted), ("two", noted)])
    corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert seen[0] == "1000" and spark.conf.get(name) == before


def test_workers_forget_the_vocabulary_after_the_job(spark):
    from brooklet.llm.sentence_pieces import encode

    def left(batches):
        import gc

        import pyarrow as pa

        for _ in batches:
            pass
        known = [len(x.known) for x in gc.get_objects() if type(x).__name__ == "Walk"]
        yield pa.RecordBatch.from_arrays([pa.array(known, pa.int64())], names=["n"])

    encode(spark.read.parquet(f"{SF}/documents.parquet").repartition(8)).write.format("noop").mode("overwrite").save()
    assert spark.range(0, 64, 1, 16).mapInArrow(left, "n long").collect() == []


def test_long_texts_are_read_in_small_batches(spark):
    from brooklet.llm.common import SMALL_BATCHES, settings

    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    with settings(spark, **SMALL_BATCHES):
        assert int(spark.conf.get(name)) <= 1000 < int(before)
    assert spark.conf.get(name) == before
