"""The pipeline's stages against the operators' own decisions, and the registered queries."""

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_points
import corpus_pipeline
from skyledger.llm import minhash, mixing, packing, quality, registry, secrets
from skyledger.llm.common import stored, table

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry_points.queries())
    assert set(registry.QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in registry.QUERIES} == set(range(1, 14))
    assert set(registry.SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_twins(spark, name):
    assert differences(registry.QUERIES[name](spark, SF_DIR), connect(SF_DIR), registry.SQL[name]) == []


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, results = docs.columns, {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = results[name] = stored(stage(spark, docs, SF_DIR), f"test-{name}")
        assert name == "packing" or docs.columns == columns
    ids = {name: sorted(r.doc_id for r in frame.select("doc_id").collect()) for name, frame in results.items()}

    scores = quality.score_documents(results["documents"], table(spark, SF_DIR, "labels"))
    assert ids["quality"] == sorted(r.doc_id for r in scores.where("score >= 0.3").collect())
    classes = minhash.near_duplicate_classes(results["quality"])
    assert ids["near_duplicates"] == sorted(r.doc_id for r in classes.where("kept").collect())
    assert ids["secrets"] == ids["near_duplicates"]
    assert secrets.scan(results["secrets"]).where("exists(spans, s -> s.kind <> 'random')").count() == 0
    copies = {r.doc_id: r.copies for r in mixing.mix_table(results["secrets"]).collect()}
    assert ids["mixing"] == sorted(i for i, n in copies.items() for _ in range(n))
    encoder = packing.Encoder(packing.default_tokenizer())
    tokens = sum(len(encoder.encode(r.text or "")) // 4 + 1 for r in results["mixing"].collect())
    assert sum(r.length for r in results["packing"].select("length").collect()) == tokens
    assert corpus_pipeline.run(spark, SF_DIR).count() == results["packing"].count()


def test_packing_follows_the_order_written(spark):
    """Part files of unlike size; each document fills a window of its own at once."""
    written = spark.range(0, 4, 1, 4).selectExpr(
        "explode(sequence(element_at(array(0, 3, 23, 24), int(id) + 1), element_at(array(2, 22, 23, 32), int(id) + 1))) AS doc_id"
    )
    written = written.selectExpr(
        "doc_id", "array_join(transform(sequence(1, 1100), j -> concat('w', doc_id, 'x', j * j % 997)), ' ') AS text"
    )
    docs = stored(written, "test-order")
    assert len(docs.inputFiles()) == 4
    packed = corpus_pipeline.pack_windows(spark, docs, SF_DIR).where("start = 0 AND length = 1024")
    assert [r.doc_id for r in packed.orderBy("sequence_id").collect()] == list(range(33))
    assert [r.doc_id for r in corpus_pipeline.as_written(docs).collect()] == list(range(33))
