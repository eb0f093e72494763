"""The corpus queries against SQL, and the pipeline stage by stage."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tagshelf.llm import queries
from tagshelf.llm.jaccard_join import link_documents

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(columns).collect()), key=repr)
    expected = sorted(duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall(), key=repr)
    assert got == expected and got


def test_there_is_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_plans_of_native_queries_have_no_python(spark):
    for name in ("op4_line_dedup", "op6_quality_rules", "op7_license_scan"):
        plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = docs.withColumn("n_lines", F.lit(1)).withColumn("score", F.lit("x"))
    extra = spark.createDataFrame([(10_000, None), (10_001, ""), (10_002, "123 456")], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if name == "language id":
            assert {r[0] for r in before.select("doc_id").subtract(docs.select("doc_id")).collect()} == {10_000, 10_001, 10_002}
        if name in ("line dedup", "personal data"):
            assert docs.count() == before.count()
        if name == "n-gram Jaccard join":
            linked = link_documents(before)
            assert docs.count() == linked.select("component_id").distinct().count()
            again = link_documents(docs)
            assert again.filter("component_id <> doc_id").count() == 0
    assert docs.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 1024


def test_texts_of_no_learned_language_go(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    strange = [
        "Wczoraj po południu poszliśmy razem do lasu, żeby zbierać grzyby i jagody dla babci. " * 5,
        "Igår eftermiddag gick vi till skogen för att plocka svamp och bär till mormor. " * 5,
        "это совершенно другой язык и его никто не учил " * 5,
        "qzxv jkwp zzgh tqbx vrrk wpfj xkcd mnbq " * 5,
    ]
    clean = ["the and", "la", "und", "de la", "that of the", "el", "un"]
    extra = spark.createDataFrame([(20_000 + i, t) for i, t in enumerate(strange + clean)], "doc_id long, text string")
    out = corpus_pipeline.language_id(spark, docs.unionByName(extra, allowMissingColumns=True), SF_DIR)
    kept = {r[0] for r in out.filter("doc_id >= 20000").select("doc_id").collect()}
    assert kept == {20_000 + len(strange) + i for i in range(len(clean))}
    assert out.filter("doc_id < 20000").count() == docs.count()


def test_an_empty_table_goes_through(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == 0
