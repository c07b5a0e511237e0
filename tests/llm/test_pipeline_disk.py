"""What the pipeline's stages put on disk: texts that move, scratch tables that stay."""

import os

import numpy as np
import pytest

from starloom.llm import common, mixing, ngram_join
from starloom.session import scratch_root


def exchanges(plan):
    """The metrics of every shuffle of a plan that ran."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return exchanges(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return exchanges(plan.plan())
    own = [{k: plan.metrics().apply(k).value() for k in ("dataSize", "shuffleRecordsWritten")}] if kind == "ShuffleExchangeExec" else []
    children = plan.children()
    return own + [x for k in range(children.length()) for x in exchanges(children.apply(k))]


def ran(df):
    rows = df.collect()
    return rows, exchanges(df._jdf.queryExecution().executedPlan())


@pytest.fixture
def no_broadcast(spark):
    """Tables as large as on a cluster: none is broadcast for its size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def texts():
    draw = np.random.default_rng(5)
    return [" ".join(f"w{k}" for k in draw.integers(1 << 40, size=300)) for _ in range(400)]


def scratch(spark):
    root = scratch_root(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_documents_like_no_other_are_not_shuffled(spark, texts, no_broadcast):
    rows = list(enumerate(texts)) + [(1000 + k, texts[k] + " end") for k in range(10)] + [(5, texts[5]), (None, texts[0]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = common.written(docs, "docs")
    before = scratch(spark)
    left, shuffled = ran(ngram_join.one_of_each(docs))
    assert sorted(map(tuple, left), key=repr) == sorted([*enumerate(texts), (None, texts[0]), (None, None)], key=repr)
    assert sum(x["shuffleRecordsWritten"] for x in shuffled) <= 100
    assert [x.split("-")[:2] for x in scratch(spark) - before] == [["join", "told"]]


def test_join_keeps_what_its_result_reads(spark, texts):
    before = scratch(spark)
    rows = list(enumerate(texts)) + [(1000 + k, texts[k] + " end") for k in range(10)]
    out = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(x.rpartition("-")[0] for x in scratch(spark) - before) == ["join-classes", "join-digests", "join-parts"]
    got = {r["doc_id"]: r["component_id"] for r in out.collect()}
    assert got == {i: i % 1000 for i, _ in rows}


def test_mixed_texts_move_once(spark, texts, no_broadcast):
    docs = common.written(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string"), "docs")
    out, shuffled = ran(mixing.mixed(docs))
    assert sum(len(r["text"].split()) for r in out) == sum(r["taken"] for r in mixing.taken(docs).collect())
    assert max(x["dataSize"] for x in shuffled) < 1.5 * sum(map(len, texts))


def test_passing_blocks_end_with_what_they_wrote(spark):
    before = scratch(spark)
    with common.passing(spark):
        outer = common.written(spark.range(3), "outer")
        with common.passing(spark):
            common.written(spark.range(3), "inner")
            handed = common.written(spark.range(3), "handed", outlives=True)
        assert sorted(x.split("-")[0] for x in scratch(spark) - before) == ["handed", "outer"]
        kept = common.written(outer.join(handed, "id"), "kept", outlives=True)
    assert [x.split("-")[0] for x in scratch(spark) - before] == ["kept"] and kept.count() == 3
    with pytest.raises(ValueError), common.passing(spark):
        common.written(spark.range(3), "failed")
        raise ValueError
    assert [x.split("-")[0] for x in scratch(spark) - before] == ["kept"]
