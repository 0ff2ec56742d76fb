import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from demandloom.llm import cotrain
from demandloom.llm.oracle import ORACLE
from demandloom.llm.queries import QUERIES, table
from tokenizers import Tokenizer

from .test_host_quality import brute as measured
from .test_jaccard import brute as linked

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returned, each run on its predecessor's rows."""
    docs, out = table(spark, SMALL, "documents"), []
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, function(spark, docs, SMALL).cache()
        out.append((name, before, docs))
    return out


def texts(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()), key=repr)


def test_rules_keep_what_brute_force_keeps(stages):
    name, before, after = stages[0]
    assert name == "quality_rules" and after.columns == before.columns
    assert texts(after) == [(k, t) for k, t in texts(before) if not measured(t)[-1]]


def test_classifier_applies_its_scores(spark, stages):
    _, before, after = stages[1]
    assert after.columns == before.columns
    model = cotrain.fit(before, table(spark, SMALL, "labels"))
    scores = before.select("doc_id", "text", cotrain.scores(model, F.col("text"), F.col("source"), F.col("lang")).alias("s"))
    assert texts(after) == texts(scores.filter(f"s.score >= {cotrain.KEEP}"))


def test_one_of_each_group_stays(stages):
    _, before, after = stages[2]
    assert after.columns == before.columns
    keys = {c for _, _, c in linked(texts(before))}
    assert texts(after) == [(k, t) for k, t in texts(before) if k in keys]


def test_sequences_hold_all_that_was_left(stages):
    _, before, after = stages[3]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = after.toPandas().sort_values(["doc_id", "start"]).groupby("doc_id")["ids"].agg(b"".join)
    made = {k: np.frombuffer(v, "<u4").tolist() for k, v in found.items()}
    assert made == {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for k, t in texts(before)}


def test_run_gives_the_rows_of_its_stages(spark, stages):
    digest = F.sum(F.xxhash64("doc_id", "start", "ids").cast("decimal(38,0)"))
    assert corpus_pipeline.run(spark, SMALL).agg(digest).first() == stages[3][2].agg(digest).first()


def test_stages_take_odd_rows_and_empty_tables(spark, documents):
    odd = documents([(None, None), (1, ""), (1, None), (2, "x " * 5000), (3, "a b"), (3, "a b"), (None, "ok " * 60)]).withColumn(
        "score", F.lit(1))
    for docs in (odd, odd.limit(0)):
        for name, function in corpus_pipeline.STAGES:
            made = function(spark, docs, SMALL)
            assert name == "packing" or made.columns == docs.columns
            made.count()


@pytest.fixture(scope="module")
def duck():
    from check_queries import connect

    connection = connect(SMALL)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    from check_queries import compare

    assert compare(QUERIES[name](spark, SMALL), duck, ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted({k for k in QUERIES if k.split("_")[0] in ("op1", "op3", "op9")}))
def test_native_queries_have_no_python_in_their_plans(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in ("EvalPython", "MapInArrow", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_stages_hand_workers_few_texts_together_and_a_run_leaves_the_session_as_it_was(spark):
    def largest():
        sizes = spark.range(0, 5000, 1, 1).mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"id": [b.num_rows]}) for b in batches), "id long")
        return max(r[0] for r in sizes.collect())

    before = spark.conf.get(corpus_pipeline.BATCH)
    try:
        spark.conf.set(corpus_pipeline.BATCH, 10_000)
        assert largest() == 5000
        corpus_pipeline.STAGES[0][1](spark, table(spark, SMALL, "documents"), SMALL)
        assert largest() <= 1000
        spark.conf.set(corpus_pipeline.BATCH, 77)
        corpus_pipeline.small_batches(spark)
        assert spark.conf.get(corpus_pipeline.BATCH) == "77"
        spark.conf.set(corpus_pipeline.BATCH, 5000)
        corpus_pipeline.run(spark, SMALL)
        assert spark.conf.get(corpus_pipeline.BATCH) == "5000"
    finally:
        spark.conf.set(corpus_pipeline.BATCH, before)
