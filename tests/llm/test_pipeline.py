"""The stages on planted cases, one after the other, each on what the one before it kept."""

import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"


def test_order_of_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]


@pytest.fixture(scope="module")
def planted(spark):
    """The given documents with copies, near copies, leaks, odd rows and a further column."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS kept")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    base = " ".join(f"quite{i} plain{i}" for i in range(60))
    rows = [
        (9001, base), (9002, base), (9003, base.replace("quite7 ", "quiet7 ")), (9004, "before it " + item + " after it"),
        (9005, None), (9006, ""), (9007, " \n"), (None, "no id here at all"), (9008, "long " * 20000),
    ]
    extra = spark.createDataFrame([(i, t, "xx", "planted", 0, 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, kept int")
    return docs.unionByName(extra)


def test_stages(spark, planted, tmp_path):
    docs, ids = planted, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if name != "sharding":
            assert after.columns == docs.columns
        ids[name] = [r.doc_id for r in after.select("doc_id").collect()]
        docs = after
    ours = {9001, 9002, 9003, 9004, 9005, 9006, 9007, 9008, None}
    assert set(ids["toxicity"]) & ours == ours
    assert set(ids["near_dedup"]) & ours == ours - {9002, 9003}
    assert set(ids["decontamination"]) & ours == ours - {9002, 9003, 9004}
    assert set(ids["mixing"]) <= set(ids["decontamination"])
    assert sorted(ids["sharding"], key=str) == sorted(ids["mixing"], key=str)
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    gone = {r.doc_id for r in planted.select("doc_id").collect()} - set(ids["toxicity"])
    assert len(gone - toxic) <= 0.02 * planted.count()


def test_empty_table(spark, planted):
    docs = planted.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 100 and rows.filter("shard NOT BETWEEN 0 AND 23").count() == 0
