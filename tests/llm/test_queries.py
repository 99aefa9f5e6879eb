"""The registered corpus queries: against SQL where there is some, else whole-table invariants."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridcensus.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert difference(spark, connect(SF), name, SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_covers_every_row(spark, name):
    if name == "op12_prefix_trie":
        found = QUERIES[name](spark, SF)
        talks = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
        root = found.where("depth = 0").collect()
        assert [r.n_convs for r in root] == [talks]
        assert root[0].n_leaves == found.where("n_children = 0").count()
        return
    table = "embeddings" if "vectors" in name else "documents"
    key = "vec_id" if "vectors" in name else "doc_id"
    rows = QUERIES[name](spark, SF)
    source = spark.read.parquet(f"{SF}/{table}.parquet")
    assert rows.select(key).distinct().count() == source.count()
    if name not in ("op6_packing", "op13_best_fit"):
        assert rows.count() == source.count()


def test_pipeline_stages_keep_their_contract(spark, tmp_path):
    source = docs = spark.read.parquet(f"{SF}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SF)
        assert out.columns == source.columns, name
        out.write.parquet(str(tmp_path / str(number)))
        kept = spark.read.parquet(str(tmp_path / str(number)))
        assert kept.join(docs, "doc_id", "left_anti").isEmpty() and not kept.isEmpty()
        assert kept.count() == kept.select("doc_id").distinct().count()
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()} == {
        r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_stages_on_odd_documents(spark):
    """Nulls, empty and repeated rows, clashing names, no n_chars, no rows at all."""
    run = "\n".join(f"line {i} of a passage with some twelve more words to fill it up" for i in range(6))
    rows = [(1, run + "\nits own end one"), (2, "other start\n" + run), (3, None), (4, ""), (None, "no id here"),
            (None, None), (5, "same five six seven eight nine"), (5, "same five six seven eight nine"), (6, run)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({
        n: F.lit("x") for n in ("n_removed", "size", "score", "_id", "c0", "key", "removed", "part")})
    for frame in (docs, docs.withColumn("n_chars", F.length("text")), docs.limit(0)):
        kept = frame
        for name, stage in corpus_pipeline.STAGES[1:-1]:
            kept = stage(spark, kept, SF)
            assert kept.dtypes == frame.dtypes, name
            kept = spark.createDataFrame(kept.collect(), kept.schema)
            assert kept.where("size <> 'x' OR n_removed <> 'x'").isEmpty()
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
        assert packed.count() == kept.count()
        if frame.isEmpty():
            continue
        left = [tuple(r) for r in kept.select("doc_id", "text").collect()]
        assert (6, run) not in left and (2, "other start") in left
        assert sum(t is None for _, t in left) == 2 and (4, "") in left and (None, "no id here") in left
    scored = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert scored.columns == docs.columns
