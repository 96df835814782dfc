"""Models learn from all labelled rows; what is large takes several tasks, what is small few jobs."""

import numpy as np
from pyspark.sql import functions as F

from millstat.llm import decontaminate, quality, shared


def test_quality_learns_from_all_labelled_rows(spark):
    """More rows than any earlier bound: mean, scale and threshold are those of all of them."""
    n = 12_000
    x = np.random.default_rng(4).random((n, quality.N_FEATURES))
    y = (x[:, 0] > 0.9).astype(int)  # a rare class: its rows go to several groups
    rows = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(x)], "doc_id long, x binary").repartition(5)
    marks = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, y int")
    model = quality.learn(rows, marks)
    assert np.allclose(model.mean, x.mean(axis=0), atol=1e-5) and np.allclose(model.scale, x.std(axis=0), atol=1e-4)
    worth = model.worth(x)
    assert (worth < model.shift).sum() == n - y.sum()
    assert ((worth >= model.shift) == (y == 1)).mean() > 0.99
    groups = quality._grouped(rows.join(marks, "doc_id"), n - int(y.sum()), int(y.sum())).select(
        F.size("bad").alias("bad"), F.size("good").alias("good")).toPandas()
    assert groups["bad"].sum() == n - y.sum() and groups["good"].sum() >= y.sum() and groups.min().min() > 0
    again = quality.learn(rows.repartition(2), marks)
    assert np.array_equal(again.weights, model.weights) and again.shift == model.shift


def test_quality_order_statistics(spark):
    values = [0.5, 0.5, -3.0, 1e-9, 2e-9, 7.0, 0.5, 1e6]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert [quality.value_at(rows, "v", i) for i in range(len(values))] == sorted(values)


def test_quality_one_class_or_none(spark):
    sf = "/root/testdata/sf0.001"
    rows = quality.featured(spark.read.parquet(f"{sf}/documents.parquet"))
    one = rows.select("doc_id", F.lit(1).alias("y"))
    for marks in (one, one.limit(0)):
        scores = quality.rated(rows, quality.learn(rows, marks)).toPandas()["score"]
        assert scores.nunique() == 1 and 0.6 < scores[0] < 1


def test_jaccard_small_tables_take_no_exchange(spark):
    """Tables of few rows are one task's: rounds of components do not shuffle them, whatever the number of partitions."""
    edges = spark.range(0, 400, 1, 7).select(F.col("id").alias("a"), (F.col("id") + 1 + F.col("id") % 3).alias("b"))
    found = shared.components(edges)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and found.rdd.getNumPartitions() == 1
    parent = list(range(500))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in edges.collect():
        x, y = sorted((top(r["a"]), top(r["b"])))
        parent[y] = x
    got = {r["node"]: r["component"] for r in found.collect()}
    assert got == {n: top(n) for r in edges.collect() for n in (r["a"], r["b"])}
    back, n = shared.kept(spark.range(0, 250, 1, 5), "some", 100)
    assert n == 250 and back.rdd.getNumPartitions() <= 3 and shared.dealt(spark.range(0, 9, 1, 9), 9).rdd.getNumPartitions() == 1


def test_decontamination_tokens_stay_in_place():
    """Tokens are pointed at, not copied; hashes, kinds and placeholders are those of each token."""
    texts = [None, "", "He saw New York.\nIt cost $3,000.50 or 10% of 5 km", "x_y 3rd İstanbul ² a"]
    flat, where, owner, plain, template, slot = decontaminate.Canonical().tokens(texts)
    assert flat == [t for x in texts for t in decontaminate._TOKEN.findall(x or "")]
    assert [flat[i] for i in where] == [t for t in flat if t not in ".!?:\n"]
    assert [flat[i] for i in where[slot]] == ["New", "York", "$3,000.50", "10%", "5", "km", "3", "İstanbul", "²", "a"]
    assert owner.tolist() == sorted(owner.tolist()) and set(owner.tolist()) == {2, 3}
    assert (template[slot] != plain[slot]).all() and (template[~slot] == plain[~slot]).all()
