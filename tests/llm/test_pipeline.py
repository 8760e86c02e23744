import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tillmart.llm.queries import ORACLES, QUERIES


def test_registered():
    names = set(queries())
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in names if q.startswith("op")}
    assert "pipeline" in names and set(QUERIES) <= names and set(ORACLES) <= set(oracle_sql())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_keep_columns_and_decide(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = docs.selectExpr("*", "lang AS Text", "1 AS gone")
    before = extra
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.columns == extra.columns
        path = f"{corpus_pipeline.scratch_path(spark, 'test')}"
        after.toDF(*[f"c{i}" for i in range(len(after.columns))]).write.parquet(path)
        before = spark.read.parquet(path).toDF(*extra.columns)
    assert 0 < before.count() <= docs.count()


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    full = {}
    for r in rows:
        full[r["sequence_id"]] = full.get(r["sequence_id"], 0) + r["length"]
    assert rows and max(full.values()) <= 2048


def test_oracles(spark, sf_dir):
    from compare import compare, connect

    db = connect(sf_dir)
    for name in ORACLES:
        assert compare(spark, db, sf_dir, name) == ""
