import random

from pyspark.sql import functions as F

from corvid.operators import metrics
from corvid.operators.prefix import running_sums


def test_running_sums_match_python(spark):
    rnd = random.Random(5)
    rows = [(float(i) + rnd.random(), rnd.randint(0, 9)) for i in range(2000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k double, v long")
    got = {r.k: r.v_before for r in running_sums(df, "k", ["v"], buckets=16).collect()}
    acc = 0
    for k, v in sorted(rows):
        assert got[k] == acc
        acc += v


def test_auc_exact_vs_pairs(spark):
    rnd = random.Random(9)
    rows = [(float(rnd.random() < 0.3), float(rnd.randint(0, 20))) for _ in range(600)]
    df = spark.createDataFrame(rows, "label double, score double")
    auc = metrics.auc_exact(df, buckets=8).first().auc
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    pairs = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert abs(auc - pairs / (len(pos) * len(neg))) < 1e-12


def test_regression_and_classification_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (0.0, -1.0), (2.0, None)], "label double, prediction double")
    m = metrics.regression_metrics(df).first()
    assert m.n == 3 and abs(m.mse - 2 / 3) < 1e-12 and abs(m.rmse ** 2 - m.mse) < 1e-12 and abs(m.mae - 2 / 3) < 1e-12
    c = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    assert metrics.accuracy(c).first().accuracy == 0.75
    assert abs(metrics.balanced_accuracy(c).first().balanced_accuracy - 0.75) < 1e-12
    # AUC of hard labels equals balanced accuracy
    auc = metrics.auc_exact(c.withColumnRenamed("prediction", "score")).first().auc
    assert abs(auc - 0.75) < 1e-12


def _pairs_auc(rows):
    key = lambda s: (0, 0.0) if s is None else (2, 0.0) if s != s else (1, s)
    pos, neg = [key(s) for y, s in rows if y == 1], [key(s) for y, s in rows if y == 0]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_auc_buckets_do_not_change_it(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.random() < 0.4), rnd.choice([None, float("nan"), rnd.random(), rnd.random(), 0.5])) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, score double")
    for buckets in (None, 16, 300):
        r = metrics.auc_exact(df, buckets=buckets).first()
        assert abs(r.auc - _pairs_auc(rows)) < 1e-12
        assert r.positives + r.negatives == 500


def test_one_class_gives_null(spark):
    df = spark.createDataFrame([(1.0, 0.5), (1.0, 0.7)], "label double, score double")
    assert metrics.auc_exact(df).first().auc is None
    assert metrics.balanced_accuracy(df.withColumn("prediction", F.lit(1.0))).first().balanced_accuracy is None
