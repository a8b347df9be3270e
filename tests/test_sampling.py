from pyspark.sql import functions as F

from corvid.operators import sampling


def _df(spark, n=5000):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))


def test_hash_split_is_partition_independent_and_disjoint(spark):
    df = _df(spark)
    a = sampling.hash_split(df, "k", [0.7, 0.3], seed=7)
    b = sampling.hash_split(df.repartition(13), "k", [0.7, 0.3], seed=7)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    n_train = a.filter("split = 'train'").count()
    assert 3300 < n_train < 3700
    parts = sampling.random_split(df, "k", [0.5, 0.3, 0.2], seed=1)
    ids = [set(r.k for r in p.collect()) for p in parts]
    assert sum(len(s) for s in ids) == 5000 and len(set().union(*ids)) == 5000


def test_stratified_split_exact_counts(spark):
    df = _df(spark)
    out = sampling.stratified_split(df, "k", "y", [0.7, 0.3], seed=3, exact=True)
    got = {(r.y, r.split): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert got == {(0, "train"): 3150, (0, "test"): 1350, (1, "train"): 350, (1, "test"): 150}


def test_stratified_sample_rates(spark):
    out = sampling.stratified_sample(_df(spark, 20000), "k", "y", {0: 0.1, 1: 0.5}, seed=2)
    c = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert 1600 < c[0] < 2000 and 850 < c[1] < 1150


def test_kfold_and_weights(spark):
    df = sampling.kfold(_df(spark), "k", 5, seed=1)
    folds = {r.fold for r in df.select("fold").distinct().collect()}
    assert folds == {0, 1, 2, 3, 4}
    w = {r.y: r.classWeights for r in sampling.class_weights(_df(spark), "y").select("y", "classWeights").distinct().collect()}
    assert abs(w[1] - 5000 / (2 * 500)) < 1e-12 and abs(w[0] - 5000 / (2 * 4500)) < 1e-12
    p = {r.y: r.share for r in sampling.class_proportions(_df(spark), "y").collect()}
    assert p == {0: 0.9, 1: 0.1}


def test_except_distinct_drops_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,)], "x int")
    b = spark.createDataFrame([(3,)], "x int")
    assert sorted(r.x for r in sampling.except_distinct(a, b).collect()) == [1, 2]


def test_exact_split_with_duplicate_keys_uses_tie_quotas(spark):
    # keys repeat, so whole groups of rows share a hash: the cut must take
    # part of a tie group, per class, and still give exact counts
    df = spark.range(1000).select((F.col("id") % 37).alias("k"), (F.col("id") % 2).alias("y"), "id")
    out = sampling.stratified_split(df, "k", "y", [0.7, 0.3], seed=5, exact=True)
    got = {(r.y, r.split): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert got == {(0, "train"): 350, (0, "test"): 150, (1, "train"): 350, (1, "test"): 150}
    assert out.count() == 1000 and out.select("id").distinct().count() == 1000


def test_stratified_split_of_many_classes(spark):
    df = spark.range(40000).select(F.col("id").alias("k"), F.pmod("id", F.lit(5000)).alias("y"), F.lit("x").alias("_n"))
    out = sampling.stratified_split(df, "k", "y", [0.7, 0.3], seed=2, exact=True)
    assert out.columns == ["k", "y", "_n", "split"] and out.count() == 40000
    per = out.groupBy("y").agg(F.sum((F.col("split") == "train").cast("int")).alias("n"))
    assert {r.n for r in per.collect()} == {5} and per.count() == 5000


def test_stratified_split_edges(spark):
    # one key holds most rows, one class is NULL, one class is too small for a first part
    rows = [(1, 0)] * 900 + [(k, 0) for k in range(2, 102)] + [(k, None) for k in range(10)] + [(5, 7)] + [(None, 8)] * 10
    out = sampling.stratified_split(spark.createDataFrame(rows, "k long, y int"), "k", "y", [0.5, 0.5], seed=5, exact=True)
    got = {(r.y, r.split): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert got == {(0, "train"): 500, (0, "test"): 500, (None, "train"): 5, (None, "test"): 5, (7, "test"): 1, (8, "train"): 5, (8, "test"): 5}
    empty = spark.createDataFrame([], "k long, y int")
    assert sampling.stratified_split(empty, "k", "y", [0.5, 0.5], exact=True).count() == 0
