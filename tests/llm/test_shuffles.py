"""Rows that meet nothing stay where they are, and results do not depend on which rows those are."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_data import corpus, nothing, prose, scratch  # noqa: F401
from settlebook.llm import near, pii
from settlebook.llm.scratch import Scratch
from settlebook.operators import split

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_chars int"


def shuffled(df):
    """Bytes that the shuffles of ``df`` take in; ``df`` is run for that."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(plan.plan())
        else:
            if name == "ShuffleExchangeExec":
                total += plan.metrics().apply("dataSize").value()
            children = plan.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


class Measured(Scratch):
    total = 0

    def save(self, df, name, codec="zstd"):
        self.total += shuffled(df)
        return super().save(df, name, codec)


@pytest.fixture
def shuffle_joins(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


@pytest.fixture
def long_texts(spark):
    """120 texts of 3000 words that share nothing, a near copy of the first and a row that comes twice."""
    texts = [" ".join(f"w{i}x{k}" for k in range(3000)) for i in range(120)]
    rows = [(i, t, len(t)) for i, t in enumerate(texts)] + [(200, texts[0] + " end", 0), (7, texts[7], 0)]
    return spark.createDataFrame(rows, SCHEMA), sum(len(r[1]) for r in rows)


def test_near_copies_alone_send_their_texts(spark, long_texts, shuffle_joins):
    docs, size = long_texts
    scratch = Measured(spark, "measured")
    got = {r["doc_id"]: r["component_id"] for r in near.link(docs, scratch).collect()}
    assert got == {**{i: i for i in range(120)}, 200: 0}
    assert scratch.total < size / 2, (scratch.total, size)


@pytest.mark.parametrize("stage", ["exact_dedup", "near_dedup"])
def test_kept_rows_stay_where_they_are(spark, long_texts, shuffle_joins, stage):
    docs, size = long_texts
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF)
    assert sorted(r["doc_id"] for r in out.collect()) == [*range(120), *([200] if stage == "exact_dedup" else [])]
    assert out.columns == docs.columns and shuffled(out) < size / 2


def test_texts_without_spans_stay_where_they_are(spark, long_texts, shuffle_joins):
    docs, size = long_texts
    docs = docs.unionByName(spark.createDataFrame([(300, "mail to a@b.example now", 0), (301, None, 0), (302, "mail to a@b.example now", 0)], SCHEMA))
    out = pii.redact(docs, Scratch(spark, "t"))
    assert shuffled(out) < size / 2
    want = {(r["doc_id"], r["text"]) for r in docs.where("doc_id < 300").collect()} | {(300, "mail to [EMAIL] now"), (301, None), (302, "mail to [EMAIL] now")}
    assert {(r["doc_id"], r["text"]) for r in out.collect()} == want and out.count() == docs.count()


@pytest.mark.parametrize("bits", [0, 64])
def test_results_do_not_depend_on_the_bitmap(spark, corpus, scratch, monkeypatch, bits):
    """No bitmap, and one so small that most rows share a bit with a member."""
    def results():
        docs = corpus.select("doc_id", "text").withColumn("n_chars", F.length("text"))
        found = [stage(spark, docs, SF) for name, stage in corpus_pipeline.STAGES if name in ("exact_dedup", "near_dedup", "redaction")]
        return [sorted((str(tuple(r)) for r in df.collect())) for df in (*found, near.link(docs, Scratch(spark, "n")))]

    want = results()
    monkeypatch.setattr(split, "bits_for", lambda *a: bits)
    assert results() == want


def test_split_by_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.col("id").alias("_word"))
    keys = spark.createDataFrame([(5,), (6,), (6,), (None,)], "m long")
    outside, others = split.split_by_keys(df, "k", keys, "m")
    inside = {r["k"] for r in others.collect()}
    assert {5, 6} <= inside and len(inside) < 50 and outside.count() + others.count() == 1000
    assert outside.columns == others.columns == df.columns and {r["_word"] for r in outside.unionByName(others).collect()} == set(range(1000))
    outside, others = split.split_by_keys(df, "k", keys, "m", most_bits=4)
    assert (outside.count(), others.count()) == (0, 1000)
